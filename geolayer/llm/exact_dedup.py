"""Exact dedup by progressive refinement: length, then prefix hash, then full hash.

Texts count as equal when they are the same after deleting white space. Rows alone in their
length and prefix group are unique without a full hash; only rows of the surviving groups have
their content hashed whole and meet in a shuffle. Of equal texts the row with the most code
points, then the smallest id, stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geolayer.llm.common import SPACE, bounded, text_of
from geolayer.session import written

PREFIX_CHARS = 256
#: Groups of copies that hold more than this share of all copies, and at least so many, are joined by
#: broadcast: there are fewer than 1 / share of them.
HOT_SHARE = 1 / 100_000
HOT_ROWS = 256


def normalised(text: Column) -> Column:
    """The text without its white space."""
    return F.regexp_replace(text, SPACE, "")


def exact_dedup(
    docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id",
    columns: list[str] | None = None, prefix_chars: int = PREFIX_CHARS,
) -> DataFrame:
    """``columns`` of every row (all by default) with ``keep_id``, ``group_size`` and ``kept``.

    A null text counts as empty, and empty texts are copies of each other. A null id comes after
    all ids. Of rows that tie in all of that one stays, and ``keep_id`` is its id. An empty table
    gives an empty result. Columns of the input named like an output column or starting with
    ``_x`` are replaced.

    Two passes read the texts: one for lengths and prefix hashes, one that fetches the rows.
    Copies are counted with map-side aggregates. What is known of a large group of copies is sent to
    all tasks, which find its rows where they are; rows of other groups meet it in a shuffle. So no
    task gets a large group, and very long texts are one row's work each.
    """
    names = [c for c in columns or docs.columns if c not in ("keep_id", "group_size", "kept")]
    norm = normalised(text_of(text))
    keyed = docs.select(
        *names,
        norm.alias("_xnorm"),
        F.length(text_of(text)).alias("_xchars"),
        F.col(doc_id).alias("_xid"),
    ).withColumns({
        "_xlen": F.length("_xnorm"),
        "_xpre": F.xxhash64(F.substring("_xnorm", 1, prefix_chars)),
    })
    slim = written(keyed.select("_xlen", "_xpre"), "exact-keys")
    counted = slim.groupBy("_xlen", "_xpre").count()
    several = counted.groupBy("_xlen").agg(F.sum("count").alias("n")).filter("n > 1")
    groups = written(
        counted.join(several, "_xlen", "left_semi").filter("count > 1").select("_xlen", "_xpre"),
        "exact-groups")
    groups = bounded(groups)
    # Rows of groups that survive the prefix hash, with the hash of their whole content.
    copies = written(
        keyed.join(groups, ["_xlen", "_xpre"], "left_semi")
        .withColumn("_xhash", F.sha2(F.col("_xnorm").cast("binary"), 256))
        .select(*names, "_xid", "_xchars", "_xhash")
        .withColumn("_xrow", F.monotonically_increasing_id()),
        "exact-copies")
    stays = written(copies.groupBy("_xhash").agg(
        F.min(F.struct(
            (-F.col("_xchars")).alias("c"), F.col("_xid").isNull().alias("n"),
            F.col("_xid").alias("i"), F.col("_xrow").alias("r"))).alias("_xbest"),
        F.count(F.lit(1)).alias("group_size")), "exact-stays")
    total = stays.agg(F.sum("group_size")).first()[0] or 0
    hot = F.col("group_size") > max(HOT_ROWS, int(total * HOT_SHARE))
    large = F.broadcast(stays.filter(hot))
    grouped = copies.join(large, "_xhash").unionByName(
        copies.join(large.select("_xhash"), "_xhash", "left_anti").join(stays.filter(~hot), "_xhash"))
    grouped = grouped.select(
        *names, F.col("_xbest.i").alias("keep_id"), "group_size",
        (F.col("_xbest.r") == F.col("_xrow")).alias("kept"))
    alone = keyed.join(groups, ["_xlen", "_xpre"], "left_anti").select(
        *names, F.col("_xid").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"))
    return alone.unionByName(grouped)


def unique_documents(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows that stay, with the columns of ``docs``."""
    return exact_dedup(docs, text=text, doc_id=doc_id).filter("kept").select(*docs.columns)
