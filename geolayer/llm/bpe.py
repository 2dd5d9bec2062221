"""Byte-level BPE: encoding by a queue of merge ranks over a linked list, decoding by table.

A vocabulary file in the JSON form of the tokenizers library is read on the driver and sent to
the executors; it does not grow with the data. Words are encoded once and kept in a bounded
cache.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geolayer.llm.common import Cache, list_array, map_slices, text_of

# Fixed value: the pre-tokenizer's pattern of the vocabulary's family.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Fixed value: the characters with the Unicode property White_Space.
BLANK = "\t-\r \x85\xa0" + "".join(
    map(chr, [0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
MAX_FILE_BYTES = 64 << 20

_PIECES = regex.compile(
    PIECES.replace(r"[^\s", f"[^{BLANK}").replace(r"\s", f"[{BLANK}]").replace(
        r"\S", f"[^{BLANK}]"))
_RUNS = re.compile(f"([{BLANK}]+)")
_RARE_BLANKS = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]


def byte_letters() -> dict[int, str]:
    """Letter that stands for each byte: printable Latin-1 for itself, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}


#: Words whose ids a worker keeps, in two generations.
CACHED_WORDS = 400_000


class Codec:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, data: bytes, cached_words: int = CACHED_WORDS):
        spec = json.loads(data)
        vocab, letters = spec["model"]["vocab"], byte_letters()
        self.byte_ids = [vocab[letters[b]] for b in range(256)]
        #: By rank: left symbol, right symbol, their union. By pair of symbols: the rank, in the
        #: upper half of an integer, as queue entries have it.
        self.merges: list[tuple[int, int, int]] = []
        self.rank: dict[int, int] = {}
        for merge in spec["model"]["merges"]:
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            pair = vocab[left], vocab[right]
            self.rank[pair[0] << 32 | pair[1]] = len(self.merges) << 32
            self.merges.append((*pair, vocab[left + right]))
        back = {c: b for b, c in letters.items()}
        size = max([*vocab.values(), *(t["id"] for t in spec.get("added_tokens", []))]) + 1
        self.strings = [b""] * size
        for token, i in vocab.items():
            self.strings[i] = bytes(back[c] for c in token)
        self.added: dict[str, bytes] = {}
        for token in spec.get("added_tokens", []):
            self.strings[token["id"]] = token["content"].encode()
            self.added[token["content"]] = _packed([token["id"]])
        self._added = re.compile("(" + "|".join(
            map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.first = Cache(self._chunk, limit=cached_words * 3 // 4)
        self.later = Cache(lambda word: self._chunk(" " + word), limit=cached_words)
        self.break_ids = self._chunk("\n")

    def merge(self, word: bytes) -> list[int]:
        """Ids of one pre-token: the pair of least rank, leftmost first, merges until none can."""
        ids = self.byte_ids
        symbols = [ids[b] for b in word]
        n = len(symbols)
        if n < 2:
            return symbols
        rank, merges = self.rank.get, self.merges
        queue = []
        left = symbols[0] << 32
        for i in range(1, n):
            right = symbols[i]
            if (r := rank(left | right)) is not None:
                queue.append(r | i - 1)
            left = right << 32
        if not queue:
            return symbols
        heapq.heapify(queue)
        pop, push = heapq.heappop, heapq.heappush
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while queue:
            entry = pop(queue)
            i = entry & 0xFFFFFFFF
            left, right, union = merges[entry >> 32]
            j = after[i]
            # Stale entries name symbols that have meanwhile merged with others.
            if symbols[i] != left or j >= n or symbols[j] != right:
                continue
            symbols[i], symbols[j] = union, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := rank(union << 32 | symbols[k])) is not None:
                    push(queue, r | i)
            h = before[i]
            if h >= 0 and (r := rank(symbols[h] << 32 | union)) is not None:
                push(queue, r | h)
        return [s for s in symbols if s >= 0]

    def _chunk(self, chunk: str) -> bytes:
        ids: list[int] = []
        for piece in _PIECES.findall(chunk):
            ids += self.merge(piece.encode("utf-8"))
        return _packed(ids)

    def _plain(self, text: str, out: list[bytes]) -> None:
        """Ids of a text without added tokens, cut at white space into words for the cache."""
        if not text:
            return
        if (len(text.split()) == text.count(" ") + text.count("\n") + 1
                and not any(c in text for c in _RARE_BLANKS)):
            # All white space is one blank or line break between two words.
            get = self.later.__getitem__
            for k, line in enumerate(text.split("\n")):
                if k:
                    out.append(self.break_ids)
                words = line.split(" ")
                out.append(self.first[words[0]])
                out += map(get, words[1:])
            return
        parts = _RUNS.split(text)
        words, runs = parts[::2], parts[1::2]
        if words[0]:
            out.append(self.first[words[0]])
        for run, word in zip(runs, words[1:]):
            if not word:
                out.append(self.first[run])
            elif run[-1] == " ":
                if len(run) > 1:
                    out.append(self.first[run[:-1]])
                out.append(self.later[word])
            else:
                if len(run) > 1:
                    out.append(self.first[run[:-1]])
                out += (self.first[run[-1]], self.first[word])

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        if self._added is None or self._added.search(text) is None:
            self._plain(text, out)
        else:
            for k, part in enumerate(self._added.split(text)):
                out.append(self.added[part]) if k % 2 else self._plain(part, out)
        return b"".join(out)

    def decode(self, ids: list[int]) -> str:
        """The text of ids: their strings one after the other, bad bytes replaced."""
        return b"".join(map(self.strings.__getitem__, ids)).decode("utf-8", "replace")


def _packed(ids: list[int]) -> bytes:
    return np.asarray(ids, "<u4").tobytes()


_CODECS: dict[str, Codec] = {}


def codec_of(data: bytes, digest: str, cached_words: int = CACHED_WORDS) -> Codec:
    """The codec of a vocabulary file, built once in each process."""
    key = f"{digest}:{cached_words}"
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(data, cached_words)
    return _CODECS[key]


def read_vocabulary(path: str) -> bytes:
    """A vocabulary file of bounded size."""
    with open(path, "rb") as f:
        data = f.read(MAX_FILE_BYTES + 1)
    if len(data) > MAX_FILE_BYTES:
        raise ValueError(f"vocabulary file over {MAX_FILE_BYTES} bytes: {path}")
    return data


def encode_documents(
    docs: DataFrame, vocabulary: str, *, text: str = "text", columns: list[str] | None = None,
    with_ids: bool = True, cached_words: int = CACHED_WORDS,
) -> DataFrame:
    """``columns`` of every row with ``n_tokens``, ``ids`` (if asked), ``ids_sha256`` and
    ``decoded_sha256``, the digest of the text decoded from the ids.

    A null text counts as empty and has no tokens. Repeated rows are encoded alike; whole texts
    are encoded whatever their length, in time n log n. Input columns named like output columns
    are replaced. An empty table gives no rows. No shuffle: a row is encoded where it is read. A
    worker keeps the ids of up to four times ``cached_words`` words, about 250 bytes each.
    """
    spark = docs.sparkSession
    data = read_vocabulary(vocabulary)
    digest = hashlib.sha256(data).hexdigest()
    sent = spark.sparkContext.broadcast(data)
    made = ("n_tokens", "ids", "ids_sha256", "decoded_sha256")
    names = [c for c in (docs.columns if columns is None else columns) if c not in made]
    kinds = dict(docs.dtypes)

    def run(batch: pa.RecordBatch) -> dict:
        codec = codec_of(sent.value, digest, cached_words)
        counts, blocks, id_digests, texts = [], [], [], []
        for value in batch.column(len(names)).to_pylist():
            packed = codec.encode(value)
            ids = np.frombuffer(packed, "<u4")
            counts.append(len(ids))
            id_digests.append(hashlib.sha256(packed).hexdigest())
            texts.append(hashlib.sha256(codec.decode(ids.tolist()).encode("utf-8")).hexdigest())
            if with_ids:
                blocks.append(ids.astype(np.int32))
        out = {n: batch.column(i) for i, n in enumerate(names)} | {
            "n_tokens": counts, "ids_sha256": id_digests, "decoded_sha256": texts}
        if with_ids:
            out["ids"] = list_array(np.concatenate(blocks), counts, pa.int32())
        return out

    return map_slices(
        docs.select(*names, text_of(text).alias("_text")), run,
        ", ".join([*(f"`{n}` {kinds[n]}" for n in names), "n_tokens long",
                   *["ids array<int>"] * with_ids, "ids_sha256 string", "decoded_sha256 string"]))
