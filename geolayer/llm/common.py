"""What the text operators share: reading, word rule, size checks and Arrow plumbing."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from geolayer.session import ship_packages

#: White space between words, and the words, by the rule all operators follow.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
#: A table is broadcast only if it was counted and has at most so many narrow rows.
BROADCAST_ROWS = 200_000
#: Rows and text bytes of the parts that a batch is cut into.
SLICE_ROWS = 4_096
SLICE_BYTES = 4 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``documents`` table."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(name: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def n_words(text: Column) -> Column:
    """Number of words of a text."""
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def remainder(doc_id: str, of: int) -> Column:
    """crc32 of the id as text, modulo ``of``; null ids count as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % of


def bounded(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``rows`` rows, otherwise as it is.

    Give a written table of narrow rows: it is counted, and a larger one joins by shuffle.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def map_batches(
    df: DataFrame, fn: Callable[[pa.RecordBatch], dict[str, Any] | None], schema: str,
) -> DataFrame:
    """Apply ``fn`` to each Arrow batch; it returns columns by name."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, Any] | None]:
        return (fn(batch) for batch in batches if batch.num_rows)

    return map_partitions(df, run, schema)


def map_partitions(
    df: DataFrame,
    fn: Callable[[Iterator[pa.RecordBatch]], Iterator[dict[str, Any] | None]],
    schema: str,
) -> DataFrame:
    """Apply ``fn`` to the Arrow batches of each partition; it yields columns by name."""
    ship_packages(df.sparkSession)
    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in fn(batches):
            if out is not None:
                yield pa.RecordBatch.from_arrays(
                    [v if isinstance(v, pa.Array) else pa.array(v, f.type)
                     for f in target for v in [out[f.name]]], schema=target)

    return df.mapInArrow(run, schema)


def slices(
    batch: pa.RecordBatch, column: int = -1, rows: int = SLICE_ROWS, size: int = SLICE_BYTES,
) -> Iterator[pa.RecordBatch]:
    """A batch in parts of at most ``rows`` rows whose texts or lists in ``column`` have at most
    ``size`` bytes (items of lists count eight); a longer one is a part of its own."""
    values = batch.column(column)
    if pa.types.is_list(values.type):
        lengths = pc.multiply(pc.list_value_length(values), 8)
    else:
        lengths = pc.binary_length(values)
    ends = np.cumsum(pc.fill_null(lengths, 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        upto = max(int(np.searchsorted(ends, before + size, "right")), at + 1)
        upto = min(upto, at + rows, batch.num_rows)
        yield batch.slice(at, upto - at)
        at = upto


def map_slices(
    df: DataFrame, fn: Callable[..., dict[str, Any] | None], schema: str,
    rows: int = SLICE_ROWS, start: Callable[[], Any] | None = None,
) -> DataFrame:
    """``map_batches`` with batches cut by rows and by the bytes of the last column, so that what ``fn``
    needs does not grow with the batch. With ``start``, what it returns at the start of a partition
    is handed to ``fn`` as well, and let go at the end."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, Any] | None]:
        more = () if start is None else (start(),)
        for batch in batches:
            if batch.num_rows:
                for part in slices(batch, rows=rows):
                    yield fn(part, *more)
        # Workers go on to other tasks and stages; they give back what this one took.
        more = part = None
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)

    return map_partitions(df, run, schema)


class Cache(dict):
    """Results by key, in two generations of at most ``limit`` keys: when the young one is full it
    becomes the old one, so that frequent keys stay. Long keys are not kept."""

    def __init__(self, compute: Callable[[Any], Any], limit: int = 300_000, longest: int = 64):
        super().__init__()
        self.compute, self.limit, self.longest = compute, limit, longest
        self.old: dict[Any, Any] = {}

    def __missing__(self, key: Any) -> Any:
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
            if len(key) > self.longest:
                return value
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def list_array(values: Any, lengths: Any, kind: pa.DataType) -> pa.ListArray:
    """A list column from flat values and the length of each row's list; lists of one batch may
    hold 2 ** 31 - 1 values, more is an error."""
    offsets = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    if offsets[-1] > np.iinfo(np.int32).max:
        raise OverflowError(f"{offsets[-1]} values in the lists of one batch")
    offsets = offsets.astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))
