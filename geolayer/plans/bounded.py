"""Size checks that decide between a broadcast and a shuffle."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_VERTICES = 2_000_000
SMALL_BYTES_PER_CORE = 8 << 20
SPREAD_PER_CORE = 4
# A geometry covers at most two by two cells of a grid level that fits it.
CELLS_PER_LEVEL = 4


@dataclass(frozen=True)
class Size:
    """Measured size of a geometry table, the grid levels it uses, the rows at each and the most
    vertices of a row."""

    rows: int
    vertices: int
    levels: tuple[int, ...]
    counts: tuple[int, ...] = ()
    most: int = 0

    def fits(self, other_levels: int) -> bool:
        """Whether the table, listed at its own and ``other_levels`` more grid levels, may be
        sent whole to every executor."""
        copies = CELLS_PER_LEVEL * (other_levels + 1)
        return (self.rows * copies <= MAX_BROADCAST_ROWS
                and self.vertices * copies <= MAX_BROADCAST_VERTICES)


def measure(df: DataFrame, n_vertices: str, level: str) -> Size:
    """One pass over ``df``: a few numbers for each grid level, whatever the table's size."""
    rows = df.selectExpr(f"{level} AS l", f"{n_vertices} AS v").groupBy("l").agg(
        F.count(F.lit(1)).alias("n"), F.sum("v").alias("v"), F.max("v").alias("m")).orderBy("l").collect()
    at = [r for r in rows if r.l is not None]
    return Size(sum(r.n for r in rows), sum(r.v or 0 for r in rows), tuple(r.l for r in at),
                tuple(r.n for r in at), max((r.m or 0 for r in rows), default=0))


def estimated_bytes(df: DataFrame) -> int:
    """Size of a table as the optimizer knows it; that of files is exact, others lean high."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def spread_small(df: DataFrame, key: str) -> DataFrame:
    """Give a small table one partition per core.

    A small file is one task, and the exact tests after a broadcast join would all run in it.
    Tables that the optimizer does not know to be small are left as they are: they have many
    partitions already and are not worth a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    small = estimated_bytes(df) <= cores * SMALL_BYTES_PER_CORE
    return df.repartition(cores, key) if small else df


def small_rows(df: DataFrame, limit: int = MAX_BROADCAST_ROWS) -> bool:
    """Whether a table has at most ``limit`` rows; reads no more than it must to know."""
    return df.limit(limit + 1).count() <= limit


def spread(df: DataFrame, key: str) -> DataFrame:
    """Give a table a few partitions per core, for work on its rows that does not follow from the bytes of its files."""
    return df.repartition(SPREAD_PER_CORE * df.sparkSession.sparkContext.defaultParallelism, key)
