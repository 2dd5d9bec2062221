"""Target-distribution importance resampling over hashed word features, by segment deduplication.

Separator newlines cut texts into lines. Equal lines are grouped over all documents, the features of
each distinct line are counted once and multiplied by how often it occurs; n-grams that reach over a
newline are added separately. The bucket counts of the documents and of the target texts give each
bucket a gain, a document's weight is the sum of the gains of its features, and documents are drawn
by weight and Gumbel noise.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geolayer.llm.common import Cache, bounded, map_partitions, slices, text_of
from geolayer.plans.ordered import with_row_number
from geolayer.session import written

NGRAM = 1
BUCKETS = 10_000
MIN_WORDS = 20
DRAW_PERCENT = 10
SEED = 2024
#: Words: digits, lower-case letters and everything beyond ASCII, here as UTF-8 bytes.
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


class Features:
    """Buckets of the word n-grams of lines."""

    def __init__(self, ngram: int = NGRAM, buckets: int = BUCKETS):
        self.ngram, self.buckets = ngram, buckets
        self.of_word = Cache(lambda w: zlib.crc32(w) % buckets)

    def words(self, line: bytes) -> list[bytes]:
        return _WORD.findall(line.lower())

    def bucket(self, words: list[bytes]) -> int:
        return self.of_word[words[0]] if len(words) == 1 else zlib.crc32(b" ".join(words)) % self.buckets

    def inside(self, words: list[bytes]) -> list[int]:
        """Buckets of the n-grams of one line's words."""
        out = list(map(self.of_word.__getitem__, words))
        for n in range(2, self.ngram + 1):
            out += [self.bucket(words[i:i + n]) for i in range(len(words) - n + 1)]
        return out

    def across(self, lines: list[list[bytes]]) -> list[int]:
        """Buckets of the n-grams of a text that reach over a newline."""
        if self.ngram < 2 or len(lines) < 2:
            return []
        words = [w for line in lines for w in line]
        line_of = np.repeat(np.arange(len(lines)), [len(line) for line in lines])
        out = []
        for n in range(2, self.ngram + 1):
            starts = np.flatnonzero(line_of[n - 1:] != line_of[:len(words) - n + 1])
            out += [self.bucket(words[i:i + n]) for i in starts.tolist()]
        return out


def _emitted(counts: np.ndarray) -> dict:
    some = np.flatnonzero(counts)
    return {"bucket": some, "n": counts[some]}


def bucket_counts(
    texts: DataFrame, *, text: str = "text", ngram: int = NGRAM, buckets: int = BUCKETS,
) -> DataFrame:
    """``bucket, n``: how many features of all texts fall into each bucket.

    Equal lines meet in one row with their number (counted before the shuffle as well, so a line that
    a third of all rows hold is one row a task), and a task sends one count for each bucket.
    """
    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        features, counts = Features(ngram, buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch) if batch.num_rows else ():
                own = [features.inside(features.words(t)) for t in part.column(1).to_pylist()]
                lengths = [len(b) for b in own]
                flat = np.fromiter((b for line in own for b in line), np.int64, sum(lengths))
                np.add.at(counts, flat, np.repeat(part.column(0).to_numpy(), lengths))
        yield _emitted(counts)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        features, counts = Features(ngram, buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch) if batch.num_rows else ():
                for t in part.column(0).to_pylist():
                    lines = [features.words(line) for line in t.split(b"\n")]
                    np.add.at(counts, np.array(features.across([w for w in lines if w]), np.int64), 1)
        yield _emitted(counts)

    lines = texts.select(F.explode(F.split(text_of(text), "\n")).alias("line")).filter(
        F.col("line") != "").groupBy("line").agg(F.count(F.lit(1)).alias("times"))
    found = map_partitions(
        lines.select("times", F.col("line").cast("binary").alias("line")), within,
        "bucket int, n long")
    if ngram > 1:
        found = found.unionByName(map_partitions(
            texts.select(text_of(text).cast("binary").alias("t")), over, "bucket int, n long"))
    return found.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Gain of each bucket; the two tables of counts have at most ``buckets`` rows."""
    s, t = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    for counts, table in ((s, source), (t, target)):
        for r in table.collect():
            counts[r.bucket] = r.n
    s_all, t_all = int(s.sum()), int(t.sum())
    return np.array([
        math.floor(1000 * math.log(
            float((tk + 1) * (s_all + buckets)) / float((sk + 1) * (t_all + buckets))))
        for sk, tk in zip(s.tolist(), t.tolist())], np.int64)


def weights(
    docs: DataFrame, gain: np.ndarray, *, text: str = "text", doc_id: str = "doc_id",
    ngram: int = NGRAM,
) -> DataFrame:
    """``doc_id, n_words, n_features, weight, _key`` of every document; ``_key`` tells texts apart.

    The distinct lines of a batch are looked up once and their sums added to each text holding them.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        features = Features(ngram, len(gain))

        def scored(line: bytes) -> tuple[int, int, int]:
            words = features.words(line)
            found = features.inside(words)
            return len(words), len(found), int(gain[found].sum()) if found else 0

        for batch in batches:
            for part in slices(batch) if batch.num_rows else ():
                known: dict[bytes, tuple[int, int, int]] = {}
                sums = np.zeros((part.num_rows, 3), np.int64)
                for i, t in enumerate(part.column(2).to_pylist()):
                    lines = t.split(b"\n")
                    for line in lines:
                        if line not in known:
                            known[line] = scored(line)
                    sums[i] = np.sum([known[line] for line in lines], axis=0)
                    if ngram > 1:
                        split = [w for line in lines if (w := features.words(line))]
                        more = features.across(split)
                        sums[i, 1:] += len(more), int(gain[more].sum()) if more else 0
                yield {"doc_id": part.column(0), "_key": part.column(1), "n_words": sums[:, 0],
                       "n_features": sums[:, 1], "weight": sums[:, 2]}

    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(text_of(text)).alias("_key"),
        text_of(text).cast("binary").alias("_text"))
    return map_partitions(
        rows, run, f"doc_id {rows.dtypes[0][1]}, _key long, n_words long, n_features long, weight long")


def noise(doc_id: str, seed: int = SEED) -> Column:
    """Gumbel noise of a document in thousandths, drawn from a digest of seed and id."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def _ranked(
    docs: DataFrame, target: DataFrame, *, text: str = "text", doc_id: str = "doc_id",
    target_text: str = "text", ngram: int = NGRAM, buckets: int = BUCKETS,
    min_words: int = MIN_WORDS, percent: int = DRAW_PERCENT, seed: int = SEED,
) -> DataFrame:
    gain = gains(
        bucket_counts(docs, text=text, ngram=ngram, buckets=buckets),
        bucket_counts(target, text=target_text, ngram=ngram, buckets=buckets), buckets)
    rows = weights(docs, gain, text=text, doc_id=doc_id, ngram=ngram).withColumn(
        "score", F.col("weight") + noise("doc_id", seed)).withColumns({
            "_out": F.col("n_words") < min_words, "_down": -F.col("score"),
            "_last": F.col("doc_id").isNull()})
    ranked = with_row_number(rows, ["_out", "_down", "_last", "doc_id", "_key"], "rank")
    total = ranked.filter("NOT _out").count() * percent // 100
    return ranked.withColumn(
        "rank", F.when((F.col("rank") <= total) & ~F.col("_out"), F.col("rank")))


def resample(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every document.

    ``percent`` of the documents with at least ``min_words`` words are drawn, by the highest scores
    (weight and noise); ties go to the smaller id, null ids last. ``rank`` numbers the drawn ones
    from 1, the others have none. Null and empty texts have no features and weight 0, and are drawn
    only if ``min_words`` is 0. A null id draws noise as an empty one; repeated rows have equal
    scores and neighbouring ranks. An empty table gives no rows; an empty target leaves the gains to
    the counts of the documents. Other columns are not read. Long texts are worked off line by line.

    The ranking is one sort of narrow rows by range, numbered by one count for each part. Options:
    ``text, doc_id, target_text, ngram, buckets, min_words, percent, seed``.
    """
    return _ranked(docs, target, **options).select("doc_id", "n_features", "weight", "score", "rank")


def drawn_documents(
    docs: DataFrame, target: DataFrame, *, text: str = "text", doc_id: str = "doc_id", **options,
) -> DataFrame:
    """The rows of ``docs`` that are drawn; of equal rows all are taken if one is."""
    drawn = written(_ranked(docs, target, text=text, doc_id=doc_id, **options).filter(
        "rank IS NOT NULL").select(F.col("doc_id").alias("_did"), F.col("_key").alias("_dkey")).distinct(),
        "drawn")
    return docs.join(
        bounded(drawn),
        F.col(doc_id).eqNullSafe(F.col("_did")) & (F.xxhash64(text_of(text)) == F.col("_dkey")),
        "left_semi")
