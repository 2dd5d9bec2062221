"""A quality classifier: random Fourier features, ridge by normal equations, isotonic calibration.

Statistics of a text are scaled and mapped to random cosines, whose products approximate a Gaussian
kernel. The normal equations of a ridge regression on these features are sums over rows, so each
partition adds up its part; they are whole numbers, so that the sum does not depend on its order.
Scores are then calibrated by the non-decreasing steps that fit the labels best.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geolayer.llm.common import (
    list_array, map_batches, map_partitions, map_slices, remainder, text_of)
from geolayer.session import written

THRESHOLD = 0.3
FEATURES = 256
RIDGE = 1e-4
SEED = 20
#: Features enter the normal equations as whole multiples of 1 / STEPS.
STEPS = 1 << 12
BINS = 1500
CLIP = 4.0

_LOWER = np.arange(ord("a"), ord("z") + 1)
_UPPER = np.arange(ord("A"), ord("Z") + 1)
_DIGIT = np.arange(ord("0"), ord("9") + 1)
_SYMBOL = np.frombuffer(b"#*$%&<>@^~_+=/\\{}[]", np.uint8)
_PAUSE = np.frombuffer(b",;:", np.uint8)
_STOP = np.frombuffer(b".?", np.uint8)
_NAMES = (
    "log_bytes", "log_words", "lower", "upper", "digit", "symbol", "pause", "stop", "shout", "bar",
    "space", "breaks", "high", "entropy", "word_mean", "word_spread", "short_words",
    "long_words", "distinct", "top_word", "twice", "capital_words", "marked_words",
    "shouted_words", "log_line", "distinct_lines", "symbol_words")


def statistics(text: str) -> list[float]:
    """Numbers that describe a whole text; all 0 for an empty one."""
    data = text.encode("utf-8")
    words = data.split()
    if not words:
        return [0.0] * len(_NAMES)
    n, m = len(data), len(words)
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    share = counts / n
    seen = share[share > 0]
    lengths = np.fromiter(map(len, words), np.int64, m)
    own = Counter(words)
    last = Counter(w[-1:] for w in words)
    lines = [x for x in data.split(b"\n") if x.strip()]
    capitals = sum(map(bytes.isupper, words))
    return [
        math.log1p(n), math.log1p(m),
        share[_LOWER].sum(), share[_UPPER].sum(), share[_DIGIT].sum(), share[_SYMBOL].sum(),
        share[_PAUSE].sum(), share[_STOP].sum(), share[ord("!")], share[ord("|")],
        share[ord(" ")], share[ord("\n")], share[128:].sum(), -float((seen * np.log(seen)).sum()),
        lengths.mean(), lengths.std(), (lengths <= 3).mean(), (lengths >= 12).mean(),
        len(own) / m, max(own.values()) / m, sum(map(eq, words, words[1:])) / m, capitals / m,
        sum(v for k, v in last.items() if k in b"#*$%&<>") / m, last[b"!"] / m,
        math.log1p(m / max(1, len(lines))), len(set(lines)) / max(1, len(lines)),
        own[b"|"] / m]


@dataclass(frozen=True)
class Model:
    """Scaling, random directions, ridge weights and calibration steps; fixed in size."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    steps_at: np.ndarray
    steps: np.ndarray

    def raw(self, stats: np.ndarray) -> np.ndarray:
        """Ridge scores before calibration."""
        return _waves(stats, self.mean, self.scale, self.directions, self.phases) @ self.weights / STEPS

    def score(self, stats: np.ndarray) -> np.ndarray:
        """Calibrated scores from 0 to 1."""
        return np.clip(np.interp(self.raw(stats), self.steps_at, self.steps), 0.0, 1.0)


def _waves(stats, mean, scale, directions, phases) -> np.ndarray:
    """Random Fourier features in whole steps, and a constant."""
    z = np.clip((stats - mean) / scale, -CLIP, CLIP)
    waves = np.rint(np.cos(z @ directions + phases) * STEPS)
    return np.hstack([waves, np.full((len(z), 1), float(STEPS))])


def _stats_of(texts: list[str]) -> np.ndarray:
    return np.array([statistics(t) for t in texts], np.float64).reshape(-1, len(_NAMES))


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """The columns of ``docs`` but the text, and ``stats``."""
    names = [c for c in docs.columns if c != text]
    kinds = dict(docs.dtypes)

    def run(batch: pa.RecordBatch) -> dict:
        stats = _stats_of(batch.column(len(names)).to_pylist())
        return {n: batch.column(i) for i, n in enumerate(names)} | {
            "stats": list_array(stats.ravel(), [stats.shape[1]] * len(stats), pa.float64())}

    return map_slices(
        docs.select(*names, text_of(text).alias("_text")), run,
        ", ".join([*(f"`{n}` {kinds[n]}" for n in names), "stats array<double>"]))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, len(_NAMES))


def _equations(rows: DataFrame, mean, scale, directions, phases) -> tuple[np.ndarray, np.ndarray]:
    """Sums of products of the features with each other and with the labels.

    Every partition sends the sums of its rows, whatever their number; cells are added in Spark.
    Only the sums, (FEATURES + 2) squared whole numbers, reach the driver.
    """
    width = len(phases) + 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        total = np.zeros((width, width), np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                z = _waves(_matrix(part.column(0)), mean, scale, directions, phases)
                n = part.column(1).to_numpy(zero_copy_only=False).astype(np.float64)
                good = part.column(2).to_numpy(zero_copy_only=False).astype(np.float64)
                # Whole numbers below 2 ** 53, so the products are exact.
                total[:-1, :-1] += ((z.T * n) @ z).astype(np.int64)
                total[:-1, -1] += (z.T @ (good * STEPS)).astype(np.int64)
        cells = np.flatnonzero(total)
        if len(cells):
            yield {"cell": cells, "value": total.ravel()[cells]}

    parts = map_partitions(rows.select("stats", "n", "good"), run, "cell long, value long")
    out = np.zeros(width * width)
    for r in parts.groupBy("cell").agg(F.sum("value").alias("value")).collect():
        out[r.cell] = r.value
    out = out.reshape(width, width)
    return out[:-1, :-1] / STEPS ** 2, out[:-1, -1] / STEPS ** 2


def _rising(values: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: block values and how many bins each block has."""
    blocks: list[list[float]] = []
    for v, w in zip(values, weights):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v2, w2, k2 = blocks.pop()
            v1, w1, k1 = blocks.pop()
            blocks.append([(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, k1 + k2])
    return np.array([b[0] for b in blocks]), np.array([b[2] for b in blocks])


def fit(rows: DataFrame, features: int = FEATURES, ridge: float = RIDGE, seed: int = SEED) -> Model:
    """A model from a written table ``(stats, n, good)``: how often labelled, how often good.

    With no labelled row, or one kind of label only, every score is the share of good labels
    (1 if there is none).
    """
    rng = np.random.default_rng(seed)
    width = len(_NAMES)
    sums = rows.select(F.posexplode("stats").alias("k", "x"), "n").groupBy("k").agg(
        F.sum("n").alias("n"), F.sum(F.col("x") * F.col("n")).alias("x"),
        F.sum(F.col("x") * F.col("x") * F.col("n")).alias("xx")).collect()
    mean, scale = np.zeros(width), np.ones(width)
    for r in sums:
        mean[r.k] = r.x / r.n
        spread = math.sqrt(max(r.xx / r.n - mean[r.k] ** 2, 0.0))
        scale[r.k] = spread if spread > 1e-9 else 1.0
    # Nine digits, so that the order of the sums does not change the model.
    mean, scale = (np.array([float(f"{v:.9g}") for v in x]) for x in (mean, scale))
    # Kernel width: the square root of half the number of statistics.
    directions = rng.normal(size=(width, features)) / math.sqrt(width / 2)
    phases = rng.uniform(0, 2 * math.pi, features)
    left, right = _equations(rows, mean, scale, directions, phases)
    total = left[-1, -1]
    good = right[-1]
    if total == 0 or good in (0, total):
        flat = np.array([1.0 if total == 0 else good / total])
        return Model(mean, scale, directions, phases, np.zeros(features + 1), np.zeros(1), flat)
    penalty = ridge * total * np.eye(features + 1)
    penalty[-1, -1] = 0
    weights = np.linalg.solve(left + penalty, right)
    model = Model(mean, scale, directions, phases, weights, np.zeros(1), np.zeros(1))

    def run(batch: pa.RecordBatch) -> dict:
        raw = model.raw(_matrix(batch.column(0)))
        bins = np.clip((raw + 0.25) / 1.5 * BINS, 0, BINS - 1).astype(np.int32)
        return {"bin": bins, "n": batch.column(1), "good": batch.column(2)}

    binned = map_batches(rows.select("stats", "n", "good"), run, "bin int, n long, good long")
    table = binned.groupBy("bin").agg(F.sum("n"), F.sum("good")).orderBy("bin").collect()
    at, n, good = (np.array(x, np.float64) for x in zip(*table))
    values, sizes = _rising(good / n, n)
    centres = (at + 0.5) / BINS * 1.5 - 0.25
    ends = np.cumsum(sizes)
    # A block is level from its first to its last bin; scores between blocks rise linearly.
    first, last = centres[ends - sizes], centres[ends - 1]
    return Model(mean, scale, directions, phases, weights,
                 np.column_stack([first, last]).ravel(), np.repeat(values, 2))


def labelled(
    docs: DataFrame, labels: DataFrame, *, text: str = "text", doc_id: str = "doc_id",
    label: str = "quality", folds: int | None = 5,
) -> DataFrame:
    """Statistics of the labelled documents outside the held-out fold: ``(stats, n, good)``.

    Statistics are made where the texts are read; only they meet the labels, so no text is
    shuffled. Labels other than 0 and 1 are left out. Labels are counted by id first, so
    that an id with many labels is one row; a document repeated in ``docs`` counts each time.
    """
    own = labels.filter(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull())
    if folds:
        docs = docs.filter(remainder(doc_id, folds) != 0)
        own = own.filter(remainder(doc_id, folds) != 0)
    counted = own.groupBy(F.col(doc_id).alias("_id")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("long")).alias("good"))
    stats = with_statistics(docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("text")))
    return written(stats.join(counted, "_id").select("stats", "n", "good"), "quality-training")


def scored(
    docs: DataFrame, model: Model, *, text: str = "text", threshold: float = THRESHOLD,
    columns: list[str] | None = None,
) -> DataFrame:
    """``columns`` of every row (all by default) with ``score`` and ``predicted``.

    Scores depend on the text alone; a null text counts as empty and has a score like any other.
    Repeated rows score alike. Input columns named ``score`` or ``predicted`` are replaced.
    """
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(model)
    names = [c for c in columns or docs.columns if c not in ("score", "predicted")]
    kinds = dict(docs.dtypes)

    def run(batch: pa.RecordBatch) -> dict:
        score = sent.value.score(_stats_of(batch.column(len(names)).to_pylist()))
        return {n: batch.column(i) for i, n in enumerate(names)} | {
            "score": score, "predicted": (score >= threshold).astype(np.int32)}

    return map_slices(
        docs.select(*names, text_of(text).alias("_text")), run,
        ", ".join([*(f"`{n}` {kinds[n]}" for n in names), "score double", "predicted int"]))


def good_documents(docs: DataFrame, labels: DataFrame, *, threshold: float = THRESHOLD) -> DataFrame:
    """The rows that the classifier accepts, with the columns of ``docs``."""
    model = fit(labelled(docs, labels))
    return scored(docs.withColumns({f"_keep_{c}": F.col(c) for c in ("score", "predicted")
                                    if c in docs.columns}), model, threshold=threshold).filter(
        "predicted = 1").select(*[
            F.col(f"_keep_{c}").alias(c) if c in ("score", "predicted") else F.col(c)
            for c in docs.columns])
