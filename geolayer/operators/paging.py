"""Batches of ids and pages of rows, the same on every run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geolayer.errors import InputValueError
from geolayer.layer import LayerInfo, sort_column
from geolayer.operators.select import matched
from geolayer.plans.ordered import with_row_number

# Name of the count key by service version.
COUNT_KEYS = {"2.0.0": "count", "1.1.0": "maxFeatures"}
# Deepest page read by keeping the first rows; deeper ones read the parts that hold their numbers.
MAX_TOP_ROWS = 100_000


def distinct_ids(df: DataFrame, column: str) -> DataFrame:
    """Ids as a set."""
    return df.select(column).where(F.col(column).isNotNull()).distinct()


def partition_ids(
    ids: DataFrame | int, column: str = "id", max_nrecords: int = 1000,
    require_match: bool = False,
) -> DataFrame:
    """Distinct ids in batches of ``max_nrecords``, in order, as text: ``(batch, ids)``."""
    if isinstance(ids, int):
        ids = SparkSession.active().createDataFrame([(ids,)], f"{column} bigint")
    unique = matched(distinct_ids(ids, column), require_match)
    numbered = with_row_number(unique, [column])
    batch = F.floor((F.col("rn") - 1) / max_nrecords)
    return numbered.groupBy(batch.alias("batch")).agg(
        F.transform(F.sort_array(F.collect_list(column)), lambda i: i.cast("string")).alias("ids"))


def page_plan(
    layers: DataFrame, max_nrecords: int = 1000, version: str = "2.0.0", hits: str = "hits"
) -> DataFrame:
    """One row per page of every layer: ``start_index``, ``page_size`` and its key name.

    A layer that fits one page asks for its hits, otherwise each page asks for the limit, the
    last one too. No hits, no pages.
    """
    if version not in COUNT_KEYS:
        raise InputValueError("version", COUNT_KEYS, version)
    n = F.col(hits).cast("bigint")
    step = F.lit(max_nrecords).cast("bigint")
    return (
        layers.where(n > 0)
        .withColumn("start_index", F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1, step)))
        .withColumn("page_size", F.when(n <= max_nrecords, n).otherwise(step))
        .withColumn("count_key", F.lit(COUNT_KEYS[version]))
    )


def _order(df: DataFrame, info: LayerInfo, sort_attr: str | None) -> list[str]:
    column = sort_column(df, sort_attr)
    return [column] if column == info.id_col else [column, info.id_col]


def read_page(
    df: DataFrame, info: LayerInfo, start: int, count: int, sort_attr: str | None = None
) -> DataFrame:
    """Rows ``start`` to ``start + count`` in the order of the sort column, then the id."""
    keys = _order(df, info, sort_attr)
    if start + count <= MAX_TOP_ROWS:
        return df.orderBy(*keys).offset(start).limit(count)
    numbered = with_row_number(df, keys, "_rn", rows=(start + 1, start + count))
    return numbered.orderBy("_rn").drop("_rn")


def all_pages(df: DataFrame, info: LayerInfo, sort_attr: str | None = None) -> DataFrame:
    """All rows with their page number and place in the order."""
    numbered = with_row_number(df, _order(df, info, sort_attr))
    return numbered.withColumn(
        "page", F.floor((F.col("rn") - 1) / info.max_nrecords).cast("bigint"))
