"""Small XML column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stripped(text: Column) -> Column:
    """A text without white space around it, line breaks included."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def well_formed(text: Column) -> Column:
    """Whether a text is XML; the path functions raise on other texts."""
    parsed = F.from_xml(
        text, "_corrupt_record string",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    return F.coalesce(
        text.isNotNull() & parsed.getField("_corrupt_record").isNull()
        & stripped(text).startswith("<"), F.lit(False))
