"""Sharding by rendezvous hashing of stable record keys over weighted shards.

Each key draws a number for every shard, and the shard whose weighted draw wins takes the row.
A draw depends on the key and that shard alone, so a further shard only takes rows to itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geolayer.llm.common import text_of
from geolayer.plans.ordered import ordered_table
from geolayer.session import written

ROWS_PER_PART = 1_000_000


def draw(key: Column, shard: int) -> Column:
    """A number in (0, 1) from a key and a shard: the first 52 bits of an md5 digest."""
    bits = F.conv(F.substring(F.md5(F.concat(key, F.lit(f":{shard}")).cast("binary")), 1, 13), 16, 10)
    return (bits.cast("double") + 0.5) / float(1 << 52)


def rendezvous(key: Column, weights: list[float]) -> Column:
    """Winner ``(t, shard)`` of a key: the least ``-ln(draw) / weight``, the first of equals."""
    if not weights or min(weights) <= 0:
        raise ValueError("weights: one positive number per shard")
    races = [
        F.struct((-F.log(draw(key, i)) / F.lit(float(w))).alias("t"), F.lit(i).alias("shard"))
        for i, w in enumerate(weights)
    ]
    return F.array_min(F.array(*races))


def shard_documents(
    docs: DataFrame, weights: list[float], *, text: str = "text", doc_id: str = "doc_id",
    grown_weight: float = 1.0, overhead: int = 16,
) -> DataFrame:
    """One row per document: id, ``size`` in bytes, text checksum, shard, slot, grown shard.

    ``slot`` numbers the rows of a shard from 0 without gaps, in the order of a digest of the
    key. ``grown_shard`` is the shard with one more shard of ``grown_weight``. Null ids share one
    key and so one shard; a null text has no bytes and its checksum is that of the empty text.
    Rows that are equal in all of this get neighbouring slots. Other columns are not read.

    The rows are written without their texts, sorted by range over parts of even size (a key
    held by many rows is cut as well), and numbered by one count per part and shard.
    """
    key = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    body = text_of(text).cast("binary")
    extra = -F.log(draw(key, len(weights))) / F.lit(float(grown_weight))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(text_of(text)) + overhead).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        rendezvous(key, weights).alias("_won"),
        extra.alias("_extra"),
        F.md5(key.cast("binary")).alias("_digest"),
    ).select(
        "doc_id", "size", "text_crc32", F.col("_won.shard").alias("shard"),
        (F.col("_extra") < F.col("_won.t")).alias("_grows"), "_digest")
    rows = written(rows.withColumn("_row", F.monotonically_increasing_id()), "shard-rows")
    parts = max(rows.sparkSession.sparkContext.defaultParallelism, rows.count() // ROWS_PER_PART)
    table = ordered_table(
        rows, ["shard", "_digest", "doc_id", "text_crc32", "size", "_row"], int(parts))
    # First position of each shard in each part, and how many rows of the shard lie in parts before.
    heads = table.groupBy("shard", "_part").agg(
        F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1)
    # At most parts + shards rows, since the parts follow the order of the shards.
    starts = heads.select(
        "shard", "_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return table.join(F.broadcast(starts), ["shard", "_part"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("_start") + F.col("_pos") - F.col("_first")).alias("slot"),
        F.when(F.col("_grows"), F.lit(len(weights))).otherwise(F.col("shard"))
        .cast("int").alias("grown_shard"))

