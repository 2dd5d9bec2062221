"""What is known about a layer besides its rows."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from geolayer.errors import InputValueError, MissingInputError


@dataclass(frozen=True)
class LayerInfo:
    """Names and limits of a layer.

    ``kind`` is a promise that every geometry is of that kind; it lets the spatial join skip
    a scan. ``max_nrecords`` is the batch and page size.
    """

    id_col: str
    geom_col: str = "geom"
    epsg: int = 4326
    kind: str | None = None
    max_nrecords: int = 1000
    aliases: dict[str, str] = field(default_factory=dict)


def resolve_field(df: DataFrame, name: str, info: LayerInfo | None = None) -> str:
    """Column name for a field name or an alias; unknown ones list the valid fields."""
    if name in df.columns:
        return name
    aliases = dict(info.aliases) if info else {}
    for f in df.schema.fields:
        if f.metadata.get("alias"):
            aliases[f.metadata["alias"]] = f.name
    if name in aliases and aliases[name] in df.columns:
        return aliases[name]
    raise InputValueError("field", [*df.columns, *aliases, "*"], name)


def geometry_column(df: DataFrame, info: LayerInfo | None = None) -> str:
    """Declared geometry column, else the first with ``geom`` in its name.

    Required (non-nullable) columns are looked at last, as a service schema may list them apart.
    """
    if info is not None and info.geom_col in df.columns:
        return info.geom_col
    names = [*df.columns, *(f.name for f in df.schema.fields if not f.nullable)]
    for name in names:
        if "geom" in name:
            return name
    raise MissingInputError("no geometry column declared and no column name contains 'geom'")


def sort_column(df: DataFrame | None, sort_attr: str | None) -> str:
    """Sort column of a paged read: the given one, else the first with ``id`` in its name."""
    if df is None:
        if sort_attr is None:
            raise MissingInputError("sort_attr is needed when the schema is unknown")
        return sort_attr
    if sort_attr is None:
        for name in df.columns:
            if "id" in name.lower():
                return name
        raise MissingInputError(
            f"no column with 'id' in its name to sort by; set sort_attr to one of {df.columns}"
        )
    if sort_attr not in df.columns:
        raise InputValueError("sort_attr", df.columns, sort_attr)
    return sort_attr
