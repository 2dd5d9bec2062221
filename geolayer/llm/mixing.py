"""Mixing sources to target weights with hash-threshold histograms.

Every document has a fixed hash. A source that is to give a budget of words takes whole copies
of all its documents as often as they fit, and for the rest the documents whose hash lies below
a threshold. The threshold is found from sums per source and hash bucket: only the bucket in
which the budget ends is split into finer buckets, until it holds one hash. Nothing is sorted,
and a smaller budget takes a subset of the documents of a larger one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geolayer.llm.common import bounded, n_words, text_of
from geolayer.plans.ordered import with_row_number
from geolayer.session import written

HASH_BITS = 60
LEVEL_BITS = 12
WEIGHTS = (5, 2, 1)
SHARE_PERCENT = 150
MOST_TIMES = 2


def mix_hash(doc_id: Column, text: Column) -> Column:
    """The first 60 bits of an md5 digest of the id; of the text where there is no id."""
    key = F.coalesce(doc_id.cast("string"), F.concat(F.lit("text:"), F.md5(text.cast("binary"))))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 15), 16, 10).cast("long")


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share_percent: int = SHARE_PERCENT,
    most_times: int = MOST_TIMES,
) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size)``.

    Sources in code-point order, null last, weigh ``weights`` in turn and share
    ``share_percent`` of all words. A target stops at ``most_times`` its source's size; what
    is above goes to the others by weight. Each round raises the level ``target / weight`` of the
    sources below their limit, from one row of sums, until no further source reaches its limit.
    """
    named = sizes.withColumn("_last", F.col("source").isNull())
    ranked = written(
        with_row_number(named, ["_last", "source"], "_rank").select(
            "source", "source_size",
            F.element_at(F.array(*map(F.lit, weights)),
                         ((F.col("_rank") - 1) % len(weights) + 1).cast("int")).alias("_weight"),
            (F.col("source_size") * most_times).alias("_most")),
        "mix-sources")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    wanted = total * share_percent / 100
    level, full = 0.0, -1
    while True:
        above = F.col("_most") < F.col("_weight") * F.lit(level)
        if full < 0:
            above = F.lit(False)
        row = ranked.agg(
            F.sum(F.when(above, F.col("_most")).otherwise(0)).alias("most"),
            F.sum(F.when(above, 0).otherwise(F.col("_weight"))).alias("weight"),
            F.sum(above.cast("long")).alias("full")).first()
        if row.full == full or not row.weight:
            break
        full, level = row.full or 0, (wanted - row.most) / row.weight
    return ranked.select(
        "source", "source_size",
        F.least(F.col("_most").cast("double"), F.col("_weight") * F.lit(level)).alias("target"))


def thresholds(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """``(source, source_size, target, epochs, cut)``: whole copies, and the hash below which a
    document is taken once more.

    ``sized`` is a written table ``(source, size, hash)``. Each level reads the documents of
    the boundary buckets alone. Documents with one hash are taken together or not, whichever
    comes nearer to the budget.
    """
    epochs = F.when(
        F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    state = targets.withColumn("epochs", epochs.cast("long")).withColumn(
        "_left", F.col("target") - F.col("epochs") * F.col("source_size"))
    state = written(state.select(
        "source", "source_size", "target", "epochs", "_left", F.lit(0).cast("long").alias("_low"),
        (F.col("_left") <= 0).alias("_done"), F.lit(0).cast("long").alias("cut")), "mix-state")
    shift = HASH_BITS
    while shift > 0 and state.filter("NOT _done").limit(1).count():
        step = min(LEVEL_BITS, shift)
        state = written(_refine(sized, state, shift, shift - step), "mix-state")
        shift -= step
    return state.select("source", "source_size", "target", "epochs", "cut")


def _refine(sized: DataFrame, state: DataFrame, wide: int, narrow: int) -> DataFrame:
    """One level: from buckets of ``2 ** wide`` hashes to the boundary bucket of ``2 ** narrow``."""
    opened = state.filter("NOT _done")
    inside = sized.alias("d").join(
        bounded(opened.select(F.col("source").alias("_s"), "_low")),
        F.col("source").eqNullSafe(F.col("_s"))
        & (F.shiftright("hash", wide) == F.shiftright("_low", wide)))
    buckets = inside.groupBy("source", F.shiftright("hash", narrow).alias("_bucket")).agg(
        F.sum("size").alias("_size"), F.min("hash").alias("_min"), F.max("hash").alias("_max"))
    before = Window.partitionBy("source").orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    # At most 2 ** LEVEL_BITS rows for each source.
    run = buckets.withColumn("_before", F.coalesce(F.sum("_size").over(before), F.lit(0))).join(
        bounded(opened.select(F.col("source").alias("_s"), "_left")),
        F.col("source").eqNullSafe(F.col("_s")))
    # The last bucket that begins within the budget is the boundary.
    edge = run.filter(F.col("_before") <= F.col("_left")).groupBy("source").agg(
        F.max_by(F.struct("_bucket", "_size", "_min", "_max", "_before"), "_bucket").alias("e"))
    e = F.col("e")
    left = F.col("_left") - e["_before"]
    fits = e["_size"] <= left
    single = e["_min"] == e["_max"]
    nearer = e["_size"] - left < left
    refined = opened.withColumnRenamed("source", "_s").join(
        edge, F.col("_s").eqNullSafe(F.col("source")), "left").select(
        F.col("_s").alias("source"), "source_size", "target", "epochs",
        F.coalesce(left, F.col("_left")).alias("_left"),
        F.coalesce(F.shiftleft(e["_bucket"], narrow), F.col("_low")).alias("_low"),
        (e.isNull() | fits | single).alias("_done"),
        F.when(e.isNull(), F.col("_low"))
        .when(fits | (single & nearer), e["_max"] + 1)
        .when(single, e["_min"]).alias("cut"))
    return refined.unionByName(state.filter("_done"))


def mix_copies(
    docs: DataFrame, *, source: str = "source", text: str = "text", doc_id: str = "doc_id",
    weights: tuple[int, ...] = WEIGHTS, share_percent: int = SHARE_PERCENT,
    most_times: int = MOST_TIMES,
) -> tuple[DataFrame, DataFrame]:
    """``(sized, plan)``: documents without texts, and the thresholds of the sources.

    ``sized`` has ``doc_id, source, size, hash``. A null text has size 0; a null source is a
    source of its own; equal rows share a hash and a fate. Other columns are not read.
    """
    sized = written(docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
        n_words(text_of(text)).alias("size"),
        mix_hash(F.col(doc_id), text_of(text)).alias("hash")), "mix-sizes")
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = thresholds(sized, source_targets(sizes, weights, share_percent, most_times))
    return sized, plan


def times(hash_: Column) -> Column:
    """How often a document is taken, given the columns of its source's plan."""
    return F.col("epochs") + (hash_ < F.col("cut")).cast("long")


def with_plan(df: DataFrame, source: str, plan: DataFrame) -> DataFrame:
    """Join the plan of each row's source; broadcast only while the sources are few."""
    plan = bounded(plan.withColumnRenamed("source", "_msource"))
    return df.join(plan, F.col(source).eqNullSafe(F.col("_msource"))).drop("_msource")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: rows of ``docs``, each as often as it is taken."""
    _, plan = mix_copies(docs, **options)
    source, text = options.get("source", "source"), options.get("text", "text")
    doc_id = options.get("doc_id", "doc_id")
    plan = plan.select("source", F.struct("epochs", "cut").alias("_mplan"))
    rows = with_plan(docs, source, plan)
    count = F.col("_mplan.epochs") + (
        mix_hash(F.col(doc_id), text_of(text)) < F.col("_mplan.cut")).cast("long")
    return (
        rows.withColumn("_mtimes", count.cast("int")).filter("_mtimes > 0")
        .withColumn("_mcopy", F.explode(F.array_repeat(F.lit(1), F.col("_mtimes"))))
        .select(*docs.columns))
