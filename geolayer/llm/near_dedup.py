"""MinHash near-dedup with odd sketches.

A document's set of word shingles gives MinHash samples. Bands of samples propose pairs, an odd
sketch (a bitmap holding the parity of the samples that fall on each bit) tells from the number
of differing bits whether a proposed pair can be similar enough, and the full sets of the pairs that
pass decide. Documents with the same set form one class, so that copies are never paired.

In a bucket of a band every class is first paired with the earliest one. What these links join is
one component. Then the classes of buckets that still hold several components are dealt into small
groups at random and paired with one of their group. Only classes of a bucket that are in different
components even then are compared with each other, in blocks and by larger sketches, and pairs that
these let pass are confirmed. So a large group of near copies costs a few pairs for each member, and
no link between what is not joined is skipped.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geolayer.llm.common import Cache, bounded, list_array, map_slices, text_of
from geolayer.session import written

SHINGLE_WORDS = 2
SIMILAR_PERCENT = 80
BANDS = 32
ROWS = 5
SAMPLES = 512
SKETCH_BITS = 1024
#: The sketch lets a pair pass up to so many standard deviations beyond the bits it should differ in.
SLACK = 5.0
#: Sketches of the classes that are compared with all others of a bucket.
FINE_SAMPLES = 4096
FINE_BITS = 8192
#: Rounds of random groups of about so many classes.
TURNS = 1
GROUP = 16
#: Classes of one bucket that meet in one task, when they are paired with each other.
BLOCK = 2_000
CLASSES_PER_PART = 500_000
LINKS_PER_PART = 1_000_000

_MULTIPLIERS = np.random.default_rng(17).integers(
    1, 1 << 63, FINE_SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Rows worked on at once; a row has a few KB of samples, and hundreds with the larger sketch.
SKETCH_ROWS = 512
FINE_ROWS = 64
#: Hashes of frequent words that a task keeps.
CACHED_WORDS = 60_000


def _mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers, each in a way that can be undone."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes() -> Cache:
    """64-bit hashes of words; one for each task, so that a worker holds none between tasks."""
    return Cache(xxhash.xxh3_64_intdigest, CACHED_WORDS)


def shingles(text: bytes, size: int = SHINGLE_WORDS, ids: Cache | None = None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles.

    A-Z are lower-cased and words lie between ASCII white space. A text with fewer words than a
    shingle has its whole sequence as the only one, and one without words has none.
    """
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    ids = word_hashes() if ids is None else ids
    hashes = np.fromiter(map(ids.__getitem__, words), np.uint64, len(words))
    width = min(size, len(words))
    rows = _mix(hashes[:len(words) - width + 1] + np.uint64(width))
    for k in range(1, width):
        rows = _mix(rows * np.uint64(0x9E3779B97F4A7C15) + hashes[k:len(words) - width + 1 + k])
    return np.unique(rows)


def samples(rows: np.ndarray, count: int = SAMPLES) -> np.ndarray:
    """MinHash samples of a set, in blocks so that memory stays bounded."""
    least = np.full(count, np.iinfo(np.uint64).max, np.uint64)
    width = (1 << 20) // count
    for at in range(0, len(rows), width):
        block = np.multiply.outer(_MULTIPLIERS[:count], rows[at:at + width])
        np.minimum(least, block.min(axis=1), out=least)
    return least


def odd_sketches(least: np.ndarray, size: int) -> np.ndarray:
    """Bitmaps of ``size`` bits: for each bit, whether an odd number of samples falls on it."""
    each = np.arange(least.shape[1], dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)
    bit = (_mix(least + each) % np.uint64(size)).astype(np.int64)
    at = bit + np.arange(len(least))[:, None] * size
    odd = np.bincount(at.ravel(), minlength=len(least) * size).reshape(-1, size) & 1
    return np.packbits(odd.astype(np.uint8), axis=1).view("<i8")


def sketch_rows(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Band keys and odd sketches of sets."""
    least = np.array([samples(s) for s in sets], np.uint64).reshape(-1, SAMPLES)
    parts = least[:, :BANDS * ROWS].reshape(-1, BANDS, ROWS)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for k in range(ROWS):
        keys = _mix(keys * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, k])
    return keys.view(np.int64), odd_sketches(least, SKETCH_BITS)


def most_differing_bits(similar_percent: int, k: int = SAMPLES, n: int = SKETCH_BITS) -> int:
    """Bits in which the sketches of a pair that is similar enough may differ.

    Samples that differ are binomial, and each of the two they leave flips a bit at random.
    """
    s = similar_percent / 100
    apart = 2 * k * (1 - s)
    left = (1 - 2 / n) ** apart
    spread = math.sqrt(left ** 2 * 4 * k * s * (1 - s) + n / 4 * (1 - left ** 2))
    return math.ceil(n / 2 * (1 - left) + SLACK * spread)


def _sketches(docs: DataFrame, text: str, doc_id: str, size: int, carry: list[Column]) -> DataFrame:
    def run(batch: pa.RecordBatch, ids: Cache) -> dict:
        sets = [shingles(t, size, ids) for t in batch.column(batch.num_columns - 1).to_pylist()]
        full = [s for s in sets if len(s)]
        keys, words = sketch_rows(full)
        lengths = [len(s) for s in sets]
        some = np.array(lengths) > 0
        return {n: batch.column(i) for i, n in enumerate(batch.schema.names[:-1])} | {
            "n_shingles": lengths,
            "digest": [_digest(s) if len(s) else None for s in sets],
            "bands": list_array(keys.ravel(), some * BANDS, pa.int64()),
            "odd": list_array(words.ravel(), some * words.shape[1], pa.int64())}

    rows = docs.select(F.col(doc_id).alias("doc_id"), *carry, text_of(text).cast("binary").alias("_text"))
    head = ", ".join(f"`{n}` {k}" for n, k in rows.dtypes[:-1])
    return map_slices(rows, run, head + ", n_shingles long, digest binary, bands array<long>, "
                      "odd array<long>", SKETCH_ROWS, word_hashes)


def _digest(rows: np.ndarray) -> bytes:
    return hashlib.blake2b(rows.tobytes(), digest_size=16).digest()


def near_duplicates(
    docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", size: int = SHINGLE_WORDS,
    similar_percent: int = SIMILAR_PERCENT, carry: list[Column] | None = None,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every document, and the ``carry`` columns.

    Documents are linked if the sets of their ``size``-word shingles share at least
    ``similar_percent`` of what either holds; ``component_id`` is the smallest id that links
    reach and the document with it is kept. A null or empty text is linked with nothing. Repeated
    rows are one document. Null ids come after all ids; where a component has no other, its
    ``component_id`` is null and its rows are kept. Other columns are not read.

    A pair at the limit shares no band with a probability of 3e-6 and is cut by the sketch with less
    than 1e-6; the sets then decide exactly (by 64-bit hashes of shingles).
    """
    sketches = written(_sketches(docs, text, doc_id, size, carry or []), "near-sketches")
    nodes = _classes(sketches)
    shared = _shared_buckets(nodes)
    sets = _sets(shared.select("node").distinct(), nodes, docs, text, doc_id, size)
    star = shared.filter("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b"))
    star = written(_estimated(star.distinct(), nodes, similar_percent), "near-star")
    joined = components(_confirmed(star, sets, similar_percent))
    for turn in range(1, TURNS + 1):
        opened = written(_open_buckets(shared, joined), "near-open")
        drawn = written(
            _estimated(_random_stars(opened, turn), nodes, similar_percent), "near-drawn")
        if not drawn.limit(1).count():
            break
        joined = components(_stars(joined).unionByName(_confirmed(drawn, sets, similar_percent)))
    opened = written(_open_buckets(shared, joined), "near-open")
    across = written(_across(opened, nodes, sets, similar_percent), "near-across")
    if across.limit(1).count():
        joined = components(_stars(joined).unionByName(_confirmed(across, sets, similar_percent)))
    # Nodes are numbered in the order of ids, so the least node of a component has the least id.
    heads = joined.join(nodes.select(F.col("node").alias("comp"), F.col("id").alias("head")), "comp")
    named = nodes.select("node", "digest", "id").join(
        heads.select("node", "head", F.lit(True).alias("in")), "node", "left").select(
        F.col("digest").alias("_digest"),
        F.when(F.col("in"), F.col("head")).otherwise(F.col("id")).alias("component_id"))
    extra = [c for c in sketches.columns[1:] if c not in ("n_shingles", "digest", "bands", "odd")]
    some = sketches.filter("n_shingles > 0").join(named, F.col("digest") == F.col("_digest"))
    none = sketches.filter("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    columns = ["doc_id", *extra, "n_shingles", "component_id"]
    return some.select(*columns).unionByName(none.select(*columns)).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _classes(sketches: DataFrame) -> DataFrame:
    """One written row per distinct set: ``node`` numbers them in the order of their least id."""
    some = sketches.filter("n_shingles > 0")
    # Only ids and digests are put in order and written twice; bands and sketches join them once, by digest.
    classes = written(some.groupBy("digest").agg(F.min("doc_id").alias("id")), "near-classes")
    cores = classes.sparkSession.sparkContext.defaultParallelism
    parts = max(cores, classes.count() // CLASSES_PER_PART)
    order = [F.col("id").asc_nulls_last(), F.col("digest")]
    numbered = written(
        classes.repartitionByRange(parts, *order).sortWithinPartitions(*order)
        .withColumn("node", F.monotonically_increasing_id()),
        "near-numbers")
    return written(
        numbered.join(some.groupBy("digest").agg(
            F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), F.first("odd").alias("odd")), "digest"),
        "near-nodes")


def _shared_buckets(nodes: DataFrame) -> DataFrame:
    """Members of the buckets with two classes or more, and the bucket's earliest."""
    members = nodes.select("node", F.explode("bands").alias("bucket"))
    several = members.groupBy("bucket").agg(
        F.min("node").alias("leader"), F.max("node").alias("last")).filter("leader < last")
    return written(members.join(several.drop("last"), "bucket"), "near-buckets")


def _may_match(n1: Column, n2: Column, odd1: Column, odd2: Column, percent: int) -> Column:
    """Whether sizes and sketches allow the wanted similarity."""
    differing = sum(
        (F.bit_count(odd1[k].bitwiseXOR(odd2[k])) for k in range(SKETCH_BITS // 64)), F.lit(0))
    return (
        (F.least(n1, n2) * 100 >= F.greatest(n1, n2) * percent)
        & (differing <= most_differing_bits(percent)))


def _estimated(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs that their sizes and sketches let pass."""
    left = nodes.select(F.col("node").alias("a"), F.col("n").alias("n1"), F.col("odd").alias("o1"))
    right = nodes.select(F.col("node").alias("b"), F.col("n").alias("n2"), F.col("odd").alias("o2"))
    return pairs.join(left, "a").join(right, "b").filter(
        _may_match(F.col("n1"), F.col("n2"), F.col("o1"), F.col("o2"), percent)).select("a", "b")


def _open_buckets(shared: DataFrame, joined: DataFrame) -> DataFrame:
    """Members of the buckets that hold several components: ``bucket, node, comp, leader, size``."""
    placed = written(
        shared.join(joined, "node", "left").withColumn("comp", F.coalesce("comp", "node")),
        "near-placed")
    several = placed.groupBy("bucket").agg(
        F.min("comp").alias("c1"), F.max("comp").alias("c2"),
        F.count(F.lit(1)).alias("size")).filter("c1 < c2").select("bucket", "size")
    return placed.join(several, "bucket").select("bucket", "node", "comp", "leader", "size")


def _random_stars(opened: DataFrame, turn: int) -> DataFrame:
    """Pairs of classes with one of their group; groups are drawn anew in each turn."""
    drawn = F.xxhash64("node", F.lit(turn))
    rows = opened.withColumn(
        "group", F.pmod(drawn, F.ceil(F.col("size") / GROUP))).withColumn(
        "draw", F.xxhash64("node", F.lit(-turn)))
    first = rows.groupBy("bucket", "group").agg(
        F.min(F.struct("draw", "node", "comp")).alias("f"))
    return rows.join(first, ["bucket", "group"]).filter(F.col("comp") != F.col("f.comp")).select(
        F.least("node", "f.node").alias("a"), F.greatest("node", "f.node").alias("b")).distinct()


def _across(opened: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of a bucket in different components that sizes and sketches let pass.

    The pairs with the leader were tried before. Large buckets are cut into blocks, and each pair of
    blocks is a join key. A pair is listed for the first band it shares. The small sketch is
    compared first, the larger one, made from the sets of these classes alone, where that passes.
    """
    def run(batch: pa.RecordBatch) -> dict:
        least = np.array([
            samples(s.values.to_numpy().view(np.uint64), FINE_SAMPLES) for s in batch.column(1)])
        words = odd_sketches(least, FINE_BITS)
        return {"node": batch.column(0),
                "fine": list_array(words.ravel(), [words.shape[1]] * len(words), pa.int64())}

    members = written(opened.filter("node <> leader").select("node").distinct(), "near-members")
    fine = map_slices(
        sets.join(members, "node", "left_semi").select("node", "set"), run,
        "node long, fine array<long>", FINE_ROWS)
    block = F.ceil(F.col("size") / BLOCK).cast("int")
    rows = opened.filter("node <> leader").select("bucket", "node", "comp", block.alias("blocks")).join(
        nodes.select("node", "n", "odd", "bands"), "node").join(fine, "node").withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = written(rows, "near-blocks")
    sent = ("node", "comp", "n", "odd", "bands", "fine")
    left = rows.withColumn("other", F.explode(F.sequence("block", F.col("blocks") - 1))).select(
        "bucket", F.col("block").alias("i"), F.col("other").alias("j"),
        *(F.col(c).alias(f"{c}1") for c in sent))
    right = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("block")))).select(
        "bucket", F.col("other").alias("i"), F.col("block").alias("j"),
        *(F.col(c).alias(f"{c}2") for c in sent))
    apart = F.aggregate(
        F.zip_with("fine1", "fine2", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0),
        lambda total, x: total + x)
    same = F.zip_with("bands1", "bands2", lambda x, y: F.when(x == y, x))
    return left.join(right, ["bucket", "i", "j"]).filter(
        (F.col("comp1") != F.col("comp2"))
        & ((F.col("i") < F.col("j")) | (F.col("node1") < F.col("node2")))
        & _may_match(F.col("n1"), F.col("n2"), F.col("odd1"), F.col("odd2"), percent)
        & (F.element_at(F.array_compact(same), 1) == F.col("bucket"))
        & (apart <= most_differing_bits(percent, FINE_SAMPLES, FINE_BITS))).select(
        F.least("node1", "node2").alias("a"), F.greatest("node1", "node2").alias("b")).distinct()


def _sets(
    wanted: DataFrame, nodes: DataFrame, docs: DataFrame, text: str, doc_id: str, size: int,
) -> DataFrame:
    """``(node, set)`` of the wanted classes, made anew from the texts of their earliest rows."""
    wanted = written(wanted.join(nodes.select("node", "id", "digest"), "node"), "near-wanted")
    ids = bounded(wanted.select(F.col("id").alias("_wid")).distinct())
    rows = docs.select(F.col(doc_id).alias("_id"), text_of(text).cast("binary").alias("_text")).join(
        ids, F.col("_id").eqNullSafe(F.col("_wid")), "left_semi")

    def run(batch: pa.RecordBatch, ids: Cache) -> dict:
        sets = [shingles(t, size, ids) for t in batch.column(0).to_pylist()]
        return {"digest": [_digest(s) for s in sets],
                "set": list_array(
                    np.concatenate(sets).view(np.int64), [len(s) for s in sets], pa.int64())}

    sets = map_slices(
        rows.select("_text"), run, "digest binary, set array<long>", SKETCH_ROWS, word_hashes)
    return written(
        sets.join(wanted.select("digest", "node"), "digest").select("node", "set")
        .dropDuplicates(["node"]), "near-sets")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("set").alias("s1"))
    right = sets.select(F.col("node").alias("b"), F.col("set").alias("s2"))
    common = F.size(F.array_intersect("s1", "s2"))
    total = F.size("s1") + F.size("s2")
    return written(
        pairs.join(left, "a").join(right, "b")
        .filter(common * 100 >= (total - common) * percent).select("a", "b"), "near-links")


def _stars(joined: DataFrame) -> DataFrame:
    """Components as links to their least node, from which further rounds go on."""
    return joined.select(F.col("comp").alias("a"), F.col("node").alias("b"))


def components(links: DataFrame) -> DataFrame:
    """``(node, comp)`` of every linked node: the least node of its component.

    Large-star and small-star rounds: every node's larger neighbours, then its smaller ones, are
    linked to the least neighbour. Each round is written, and ends when no link changes.
    """
    edges = written(links.select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(),
        "component-edges")
    # Links are few against the documents; a file holds up to a million of them.
    cores = edges.sparkSession.sparkContext.defaultParallelism
    parts = max(cores, edges.count() // LINKS_PER_PART)
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").filter("v > u").select(
            F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large.coalesce(parts), "component-edges")
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(small_least, "u").filter("v <> m").select(
            F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            small_least.select("u", F.col("m").alias("v"))).distinct()
        edges = written(small.coalesce(parts), "component-edges")
        seen = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == state:
            break
        state = seen
    own = edges.select(F.col("v").alias("u"), "v").distinct()
    return edges.unionByName(own).select(F.col("u").alias("node"), F.col("v").alias("comp"))


def distinct_documents(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """One document of each group of near duplicates, with the columns of ``docs``."""
    marks = near_duplicates(
        docs, text=text, doc_id=doc_id, carry=[F.xxhash64(text_of(text)).alias("_text_key")], **options)
    gone = written(marks.filter("NOT kept").select(
        F.col("doc_id").alias("_gid"), F.col("_text_key").alias("_gkey")).distinct(), "near-gone")
    return docs.join(
        bounded(gone),
        F.col(doc_id).eqNullSafe(F.col("_gid")) & (F.xxhash64(text_of(text)) == F.col("_gkey")),
        "left_anti")
