"""Global order at scale: a written, range-partitioned table with every row's position.

Rows are range-partitioned by the sort keys, sorted inside each partition and written with
their partition and position. The file is what later steps read, so a lost executor cannot
change a number that was already given. The running total over partitions is one row each.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geolayer.session import stored_bytes, written, written_at

#: Stored bytes of a part; sorting takes a few times as much memory.
PART_BYTES = 32 << 20
#: Most parts: beyond, parts grow and are sorted with spilling, so that what the driver keeps for each
#: part (a count, the places of its shuffle blocks) stays bounded.
MAX_PARTS = 20_000


def _stored(df: DataFrame) -> tuple[DataFrame, int]:
    """``df`` written once, since sorting reads it twice, and how many parts its bytes make: no
    fewer than there are cores and no more than ``MAX_PARTS``."""
    spark = df.sparkSession
    table, path = written_at(df, "unordered")
    parts = min(stored_bytes(spark, path) // PART_BYTES, MAX_PARTS)
    return table, max(spark.sparkContext.defaultParallelism, parts)


def ordered_table(df: DataFrame, keys: list[str], partitions: int | None = None) -> DataFrame:
    """``df`` written in global order, with ``_part`` and ``_pos`` (0-based in the part).

    Range bounds come from a sample, so give keys that tell rows apart (end with an id): a
    key shared by a third of the rows is then split as well.
    """
    df, n = (df, partitions) if partitions else _stored(df)
    cols = [F.col(k) for k in keys]
    placed = (
        df.repartitionByRange(n, *cols)
        .sortWithinPartitions(*cols)
        .withColumn("_seq", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_seq", 33).cast("int"))
        .withColumn("_pos", F.col("_seq").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("_seq")
    )
    return written(placed, "ordered")


def with_row_number(
    df: DataFrame, keys: list[str], name: str = "rn", partitions: int | None = None,
    rows: tuple[int, int] | None = None,
) -> DataFrame:
    """Add the 1-based global row number in the order of ``keys``.

    Never an un-partitioned window: one number per partition goes through the driver. ``rows``, the first and
    last number wanted, keeps those rows; then only the parts that hold them are read.
    """
    table = ordered_table(df, keys, partitions)
    counts = table.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).orderBy("_part").collect()
    starts = accumulate((r.n for r in counts), initial=0)
    offsets = [(r._part, start) for r, start in zip(counts, starts)]
    if rows:
        ends = [start + r.n for r, (_, start) in zip(counts, offsets)]
        offsets = [o for o, end in zip(offsets, ends) if o[1] < rows[1] and end >= rows[0]]
        # Files hold one part each, so the bounds leave the others out of the scan.
        low, high = (offsets[0][0], offsets[-1][0]) if offsets else (0, -1)
        table = table.where(F.col("_part").between(low, high))
    sent = df.sparkSession.createDataFrame(offsets, "_part int, _start bigint")
    numbered = (
        table.join(F.broadcast(sent), "_part")
        .withColumn(name, F.col("_start") + F.col("_pos") + 1)
        .drop("_part", "_pos", "_start")
    )
    return numbered.where(F.col(name).between(*rows)) if rows else numbered
