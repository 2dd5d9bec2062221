"""Language-model scores by online logistic context mixing.

A text is a sequence of words and an end. Frequent words and an escape for all others are coded bit by
bit with a prefix code. Several predictors, each a table of bit counts in slots named by a hash
of its context and the place in the code, guess every bit. Their logits are summed with weights
that a gate picks by how much the predictors have seen, and after each bit the weights in use move
along the error. The bits' probabilities, and for words behind the escape their share of such
words, multiply to the probability of the text.

The tables hold counts of the whole training corpus, added up in Spark in a fixed number of slots.
Words seen once train the escape, so it is as likely as a new word. Weights start anew every
``SEGMENT_BITS`` bits of a text, which lets many segments advance in step and makes a score depend
on the model and its text alone.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geolayer.llm.common import list_array, map_partitions, remainder, text_of
from geolayer.session import written

#: Most words that get a code and a count on every executor; the counts of the rest are joined.
MOST_WORDS = 1 << 19
#: Words up to this rank serve as wide context.
COMMON = 64
INPUTS = 3
#: Slots of each predictor, as powers of two.
SLOT_BITS = (18, 19, 18)
SEGMENT_BITS = 2048
CHUNK_TOKENS = 250_000
#: Tokens whose bits are laid out at a time, so that the arrays stay in the processor's cache.
BLOCK_TOKENS = 32_768
#: Distinct words counted in a task before they are passed on.
FLUSH_WORDS = 500_000
START_WEIGHT = 0.4
BIAS = 0.25
RATE = 0.01
PRIOR = 0.4
LIMIT = 12.0
#: A key of this length is a digest; shorter words are keys themselves.
DIGEST_BYTES = 16
#: The empty key is the end of a text.
END = b""

_OFFSETS = np.cumsum([0, *(1 << b for b in SLOT_BITS)])
_GATES = 3 ** (INPUTS - 1)
_LOGS = math.log(10.0)
#: A row of INPUTS + 1 single-precision numbers, moved as a whole.
_ROW = np.dtype("c16")


def key_of(word: bytes) -> bytes:
    """Bounded key of a word; the empty key is the end of a text."""
    if len(word) < DIGEST_BYTES:
        return word
    return hashlib.blake2b(word, digest_size=DIGEST_BYTES).digest()


def prefix_code(weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and values of a canonical Huffman code; a lone symbol has one bit."""
    n = len(weights)
    lengths = np.ones(n, np.int64)
    if n > 1:
        heap = [(int(w), i) for i, w in enumerate(weights)]
        heapq.heapify(heap)
        parent = [0] * (2 * n - 1)
        node = n
        while len(heap) > 1:
            w1, a = heapq.heappop(heap)
            w2, b = heapq.heappop(heap)
            parent[a] = parent[b] = node
            heapq.heappush(heap, (w1 + w2, node))
            node += 1
        depth = [0] * (2 * n - 1)
        for i in range(2 * n - 3, -1, -1):
            depth[i] = depth[parent[i]] + 1
        lengths = np.array(depth[:n], np.int64)
    codes = np.zeros(n, np.int64)
    code = last = 0
    for i in np.argsort(lengths, kind="stable").tolist():
        code <<= int(lengths[i]) - last
        last = int(lengths[i])
        codes[i] = code
        code += 1
    return lengths, codes


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Coder:
    """Turns texts into bits with contexts. Words are in the order of their counts."""

    def __init__(self, keys: list[bytes], counts: np.ndarray, total: int, distinct: int):
        self.index = {k: i for i, k in enumerate(keys)}
        self.counts, self.total, self.distinct = counts, total, distinct
        if END not in self.index:
            self.index[END] = len(self.index)
            self.counts = np.append(counts, 0)
        rest = total - int(self.counts.sum())
        self.lengths, self.codes = prefix_code(np.append(np.maximum(self.counts, 1), rest + 1))
        self.end = self.index[END]
        #: log10 of what a word behind the escape has for each of its counts plus one.
        self.rare_scale = math.log10(rest + distinct - np.count_nonzero(self.counts) + 1)
        #: log10 of the base model for words in the index, and for a word never seen.
        self.scale = math.log10(total + distinct + 1)
        self.logs = np.log10(self.counts + 1.0) - self.scale

    def tokens(self, texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """All words, each text closed by an end; their indexes (-1: rare); tokens per text."""
        words: list[bytes] = []
        sizes = []
        for text in texts:
            own = text.lower().split()
            words += own
            words.append(END)
            sizes.append(len(own) + 1)
        ids = np.fromiter(map(self.index.get, words, repeat(-1)), np.int64, len(words))
        for i in np.flatnonzero(ids < 0).tolist():
            if len(words[i]) >= DIGEST_BYTES:
                ids[i] = self.index.get(key_of(words[i]), -1)
        return words, ids, np.array(sizes, np.int64)

    def contexts(self, words: list[bytes], ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each token's symbol and the hashes of its contexts: none, the word before it, the last
        two common words before it. The end of a text closes all contexts."""
        n = len(ids)
        named = ids.astype(np.uint64) + np.uint64(1)
        rare = np.flatnonzero(ids < 0)
        named[rare] = np.fromiter(
            (xxhash.xxh3_64_intdigest(words[i]) | 1 << 63 for i in rare.tolist()),
            np.uint64, len(rare))
        end = np.uint64(self.end + 1)
        before = np.concatenate([[end], named[:-1]])
        # The last two common words before each token; the end of a text counts as one.
        common = (ids >= 0) & (ids < COMMON) | (ids == self.end)
        place = np.where(common, np.arange(n), -1)
        last = np.concatenate([[-1], np.maximum.accumulate(place)[:-1]])
        first_common = np.where(last >= 0, named[last], end)
        second = np.where(last >= 0, last[last], -1)
        second_common = np.where((second >= 0) & (first_common != end), named[second], end)
        wide = _mix(first_common * np.uint64(0x9E3779B97F4A7C15) + second_common)
        symbols = np.where(ids >= 0, ids, len(self.lengths) - 1)
        return symbols, _mix(np.array([np.zeros(n, np.uint64), before, wide])
                             * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))

    def bits(
        self, symbols: np.ndarray, contexts: np.ndarray, first: int = 0, last: int = INPUTS,
    ) -> tuple[list[np.ndarray], np.ndarray]:
        """The code bits of some tokens, and for each the slot of the predictors from ``first`` to ``last``."""
        lengths, codes = self.lengths[symbols], self.codes[symbols]
        # The place in the code is told by the bits before it.
        of = np.repeat(np.arange(len(symbols)), lengths)
        depth = np.arange(len(of)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        code, left = codes[of], lengths[of] - depth
        node = ((np.int64(1) << depth) | (code >> left)).astype(np.uint64)
        bit = ((code >> (left - 1)) & 1).astype(np.uint8)
        node *= np.uint64(0xC2B2AE3D27D4EB4F)
        slots = [
            (_mix(contexts[k][of] + node) >> np.uint64(64 - SLOT_BITS[k])).astype(np.int64)
            for k in range(first, last)]
        return slots, bit

    def blocks(
        self, words: list[bytes], ids: np.ndarray, first: int = 0,
    ) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
        """The bits of a chunk of tokens, block by block, for the predictors from ``first``."""
        symbols, contexts = self.contexts(words, ids)
        for at in range(0, len(ids), BLOCK_TOKENS):
            part = slice(at, at + BLOCK_TOKENS)
            yield self.bits(symbols[part], contexts[:, part], first)

    def symbol_blocks(
        self, times: np.ndarray,
    ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For symbols by how often they came: slots of the predictor without context, bits, times."""
        met = np.flatnonzero(times)
        none = _mix(np.uint64(1) + np.zeros((1, BLOCK_TOKENS), np.uint64))
        for at in range(0, len(met), BLOCK_TOKENS):
            symbols = met[at:at + BLOCK_TOKENS]
            lengths = self.lengths[symbols]
            slots, bit = self.bits(symbols, none[:, :len(symbols)], last=1)
            yield slots[0], bit, np.repeat(times[symbols], lengths)

    def bits_of_texts(self, ids: np.ndarray) -> np.ndarray:
        """How many bits each text of a chunk has."""
        lengths = self.lengths[np.where(ids >= 0, ids, len(self.lengths) - 1)]
        return np.add.reduceat(lengths, text_starts(ids, self.end))


def text_starts(ids: np.ndarray, end: int) -> np.ndarray:
    """Where texts begin: at 0 and after every end but the last."""
    return np.concatenate([[0], np.flatnonzero(ids == end)[:-1] + 1])


@dataclass(frozen=True)
class Model:
    """A coder's words and counts and the predictors' tables; bounded in size."""

    keys: list[bytes]
    counts: np.ndarray
    total: int
    distinct: int
    logits: np.ndarray | None = None
    seen: np.ndarray | None = None


def mix(
    coder: Coder, words: list[bytes], ids: np.ndarray, logits: np.ndarray, seen: np.ndarray,
    rate: float = RATE,
) -> np.ndarray:
    """log10 of the probability of each text's code.

    All segments advance by a bit in each step, so every step works on one bit of each. A bit's
    row has the predictors' logits, and its gate and value in one number.
    """
    per_text = coder.bits_of_texts(ids)
    text_end = np.cumsum(per_text)
    rows = np.empty((int(text_end[-1]), INPUTS + 1), np.float32)
    at = 0
    for slots, bit in coder.blocks(words, ids):
        part = rows[at:at + len(bit)]
        gate = np.zeros(len(bit), np.int64)
        for k in range(INPUTS):
            slot = slots[k] + _OFFSETS[k]
            part[:, k] = logits[slot]
            if k:
                gate = gate * 3 + seen[slot]
        part[:, INPUTS] = gate * 2 + bit
        at += len(bit)
    pieces = -(-per_text // SEGMENT_BITS)
    inside = np.arange(int(pieces.sum())) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    starts = np.repeat(text_end - per_text, pieces) + inside * SEGMENT_BITS
    sizes = np.minimum(np.repeat(text_end, pieces) - starts, SEGMENT_BITS)
    order = np.argsort(-sizes, kind="stable")
    begin, sizes = starts[order], sizes[order]
    active = np.searchsorted(-sizes, -np.arange(1, int(sizes[0]) + 1), side="right")
    weights = np.full((len(begin) * _GATES, INPUTS + 1), START_WEIGHT, np.float32)
    weights[:, INPUTS] = 0
    #: Rows of weights as one item each, which is the fast way to put many back.
    whole = weights.view(_ROW).ravel()
    own = np.arange(len(begin)) * _GATES
    cost = np.zeros(len(begin))
    for step, n in enumerate(active.tolist()):
        x = rows.take(begin[:n] + step, 0)
        told = x[:, INPUTS].astype(np.int64)
        x[:, INPUTS] = BIAS
        g = own[:n] + (told >> 1)
        bit = (told & 1).astype(np.float32)
        w = weights.take(g, 0)
        z = np.einsum("ij,ij->i", x, w)
        np.minimum(z, LIMIT, out=z)
        np.maximum(z, -LIMIT, out=z)
        off = np.exp(-z)
        off += 1
        cost[:n] += np.log(off) + (1 - bit) * z
        x *= ((bit - 1 / off) * np.float32(rate))[:, None]
        x += w
        whole[g] = x.view(_ROW).ravel()
    ordered = np.empty(len(cost))
    ordered[order] = cost
    return -np.add.reduceat(ordered, np.cumsum(pieces) - pieces) / _LOGS


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Row ranges with about ``CHUNK_TOKENS`` words, by the size of their texts."""
    for batch in batches:
        at = size = 0
        lengths = pa.compute.binary_length(batch.column("text")).to_pylist()
        for i, n in enumerate(lengths):
            if size and size + n > CHUNK_TOKENS * 6:
                yield batch.slice(at, i - at)
                at, size = i, 0
            size += n
        if at < batch.num_rows:
            yield batch.slice(at)


def word_counts(texts: DataFrame) -> DataFrame:
    """``(key, n)`` of all words and ends; added up in tasks before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        counts: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update(text.lower().split())
                counts[END] += 1
                if len(counts) > FLUSH_WORDS:
                    yield _keyed(counts)
                    counts.clear()
        if counts:
            yield _keyed(counts)

    return map_partitions(texts.select("text"), run, "key binary, n long").groupBy("key").agg(
        F.sum("n").alias("n"))


def _keyed(counts: Counter[bytes]) -> dict:
    return {"key": [key_of(w) for w in counts], "n": list(counts.values())}


def frequent(counts: DataFrame, most: int = MOST_WORDS) -> Model:
    """Words and counts from the least count, 2 or more, that at most ``most`` words reach.

    Counts are binned by an eighth of a power of two; the bins, at most a few hundred, decide.
    """
    level = F.floor(F.log2("n") * 8)
    bins = counts.groupBy(level.alias("level")).agg(
        F.count(F.lit(1)).alias("words"), F.sum("n").alias("n"), F.min("n").alias("least")).collect()
    total, distinct = sum(r.n for r in bins), sum(r.words for r in bins)
    held, least = 0, None
    for r in sorted(bins, key=lambda r: -r.level):
        if held + r.words > most or r.least < 2:
            break
        held, least = held + r.words, r.least
    if least is None:
        return Model([], np.zeros(0, np.int64), total, distinct)
    table = counts.filter(F.col("n") >= least).toArrow()
    rows = sorted(zip(table["n"].to_pylist(), table["key"].to_pylist()), key=lambda r: (-r[0], r[1]))
    return Model([k for _, k in rows], np.array([n for n, _ in rows], np.int64), total, distinct)


_CODERS: dict[str, Coder] = {}


def _coder(model: Model, name: str) -> Coder:
    """The coder of a model, built once in each process."""
    if name not in _CODERS:
        _CODERS.clear()
        _CODERS[name] = Coder(model.keys, model.counts, model.total, model.distinct)
    return _CODERS[name]


def _name(model: Model) -> str:
    digest = hashlib.blake2b(b"\0".join(model.keys), digest_size=16)
    digest.update(model.counts.tobytes())
    digest.update(f"{model.total} {model.distinct}".encode())
    return digest.hexdigest()


def learnt(texts: DataFrame, model: Model) -> Model:
    """The model with tables of bit counts of all ``texts``.

    Tasks send the counts of the slots they met; Spark adds them up. The table has a fixed number of
    slots, and its sums reach the driver.
    """
    sent, name = texts.sparkSession.sparkContext.broadcast(model), _name(model)
    width = int(_OFFSETS[-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        coder = _coder(sent.value, name)
        # Zeros and ones of each slot. The predictor without context is counted by symbol.
        total, times = np.zeros(2 * width, np.int64), np.zeros(len(coder.lengths), np.int64)
        for chunk in _chunks(batches):
            words, ids, _ = coder.tokens(chunk.column(0).to_pylist())
            symbols = np.where(ids >= 0, ids, len(times) - 1)
            times += np.bincount(symbols, minlength=len(times))
            found: list[list[np.ndarray]] = [[] for _ in range(1, INPUTS)]
            for slots, bit in coder.blocks(words, ids, first=1):
                for seen_, slot in zip(found, slots):
                    seen_.append((slot * 2 + bit).astype(np.int32))
            for k, parts in enumerate(found, 1):
                size = 2 << SLOT_BITS[k]
                at = 2 * _OFFSETS[k]
                total[at:at + size] += np.bincount(np.concatenate(parts), minlength=size)
        for slot, bit, often in coder.symbol_blocks(times):
            np.add.at(total, slot * 2 + bit, often)
        zeros, ones = total[::2], total[1::2]
        met = np.flatnonzero(zeros + ones)
        for at in range(0, len(met), 1 << 18):
            part = met[at:at + (1 << 18)]
            yield {"slot": part, "n": zeros[part] + ones[part], "ones": ones[part]}

    rows = map_partitions(texts.select("text"), run, "slot int, n long, ones long")
    table = rows.groupBy("slot").agg(F.sum("n").alias("n"), F.sum("ones").alias("ones")).toArrow()
    slot, n, ones = (table[c].to_numpy() for c in ("slot", "n", "ones"))
    logits, seen = np.zeros(width, np.float32), np.zeros(width, np.uint8)
    logits[slot] = np.log((ones + PRIOR) / (n - ones + PRIOR))
    seen[slot] = np.where(n >= 32, 2, 1)
    return Model(model.keys, model.counts, model.total, model.distinct, logits, seen)


def lm_scores(
    docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", folds: int = 7,
    held_out: int = 2, most_words: int = MOST_WORDS,
) -> DataFrame:
    """Scores of every document, learnt from those outside the held-out fold.

    Returns ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` and
    ``bits_per_byte``. A null text counts as empty: it is one end. Repeated rows score alike
    and each counts in training. With no training text every word is unknown. Other columns are
    not read; an empty table gives an empty result.

    Frequent words have their counts at hand in every task. The others are listed by document,
    and their counts come by a join; such a word is rare, so its key is never a hot one unless no
    training text has it.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), (remainder(doc_id, folds) == held_out).alias("held_out"),
        text_of(text).cast("binary").alias("text"))
    training = rows.filter("NOT held_out").select("text")
    counts = written(word_counts(training), "lm-counts")
    model = learnt(training, frequent(counts, most_words))
    sent, name = docs.sparkSession.sparkContext.broadcast(model), _name(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        coder = _coder(sent.value, name)
        for chunk in _chunks(batches):
            texts = chunk.column("text").to_pylist()
            words, ids, sizes = coder.tokens(texts)
            score = mix(coder, words, ids, sent.value.logits, sent.value.seen)
            known = ids >= 0
            starts = np.cumsum(sizes) - sizes
            logs = np.where(known, coder.logs[np.maximum(ids, 0)], 0.0)
            have = known & (coder.counts[np.maximum(ids, 0)] > 0)
            rare: list[Counter[bytes]] = [Counter() for _ in texts]
            text_of_token = np.repeat(np.arange(len(sizes)), sizes)
            for i in np.flatnonzero(~known).tolist():
                rare[text_of_token[i]][key_of(words[i])] += 1
            lengths = [len(r) for r in rare]
            size = [max(1, len(t)) for t in texts]
            yield {
                "doc_id": chunk.column("doc_id"), "held_out": chunk.column("held_out"),
                "n_tokens": sizes, "n_known": np.add.reduceat(have.astype(np.int64), starts),
                "base_score": np.add.reduceat(logs, starts), "score": score, "n_bytes": size,
                "keys": list_array([k for r in rare for k in r], lengths, pa.binary()),
                "times": list_array([n for r in rare for n in r.values()], lengths, pa.int64())}

    scored = written(
        map_partitions(
            rows, run, f"doc_id {dict(rows.dtypes)['doc_id']}, held_out boolean, n_tokens long, "
            "n_known long, base_score double, score double, n_bytes long, "
            "keys array<binary>, times array<long>")
        .withColumn("row", F.monotonically_increasing_id()), "lm-scored")
    rare = scored.select("row", F.explode(F.arrays_zip("keys", "times")).alias("r")).select(
        "row", F.col("r.keys").alias("key"), F.col("r.times").alias("times"))
    seen = F.coalesce("n", F.lit(0))
    coder = Coder(model.keys, model.counts, model.total, model.distinct)
    logs = F.log10(seen + 1.0)
    more = rare.join(counts, "key", "left").groupBy("row").agg(
        F.sum((logs - coder.scale) * F.col("times")).alias("base_more"),
        F.sum((logs - coder.rare_scale) * F.col("times")).alias("more"),
        F.sum(F.when(seen > 0, F.col("times")).otherwise(0)).alias("known"))
    score = F.round(F.col("score") + F.coalesce("more", F.lit(0.0)), 6)
    return scored.join(more, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("base_more", F.lit(0.0))).alias("base_score"),
        score.alias("score"),
        F.round(-score / math.log10(2) / F.col("n_bytes"), 6).alias("bits_per_byte"))
