"""Word-piece token counts by a linear longest-match automaton.

The vocabulary is a trie with one root for the start of a word and one for its rest. A node's
failure link leads to where matching goes on after the pieces that are certain by then have been
cut off, and the number of these pieces is kept with the link. So greedy longest-match counts
come from one walk over the characters, without going back and without building pieces.
"""

from __future__ import annotations

import hashlib
import pickle

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geolayer.llm.common import Cache, map_batches, text_of
from geolayer.llm.quality_rules import words_of

#: Starts the pieces that begin a word in vocabularies of the sentencepiece library.
WORD_MARK = "▁"
_UNKNOWN = 1 << 40


class Automaton:
    """Counts the pieces of words, for a vocabulary of first and of further pieces."""

    def __init__(self, first: list[str], further: list[str]):
        self.next: list[dict[str, int]] = [{}, {}]  # node 0 starts a word, node 1 goes on
        ends = set()
        for root, pieces in enumerate((first, further)):
            for piece in pieces:
                if not piece:
                    continue
                node = root
                for c in piece:
                    node = self.next[node].setdefault(c, len(self.next))
                    if node == len(self.next):
                        self.next.append({})
                ends.add(node)
        self.link = [-1] * len(self.next)
        self.cut = [0] * len(self.next)
        level = [0, 1]
        while level:
            deeper = []
            for node in level:
                for c, child in self.next[node].items():
                    deeper.append(child)
                    if child in ends:
                        self.link[child], self.cut[child] = 1, 1
                        continue
                    at, cut = self.link[node], self.cut[node]
                    while at >= 0 and c not in self.next[at]:
                        cut += self.cut[at]
                        at = self.link[at]
                    if at >= 0:
                        self.link[child], self.cut[child] = self.next[at][c], cut
            level = deeper

    def count(self, word: str) -> int:
        """Number of pieces of a word; -1 if it cannot be cut into pieces."""
        moves, link, cut = self.next, self.link, self.cut
        node = total = 0
        for c in word:
            while (to := moves[node].get(c)) is None:
                total += cut[node]
                node = link[node]
                if node < 0:
                    return -1
            node = to
        while node != 1:
            total += cut[node]
            node = link[node]
            if node < 0:
                return -1
        return total


def read_pieces(path: str) -> tuple[list[str], list[str]]:
    """First and further pieces of a sentencepiece model; first ones keep their mark."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())
              if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    return ([p for p in pieces if p.startswith(WORD_MARK)],
            [p for p in pieces if not p.startswith(WORD_MARK)])


_AUTOMATA: dict[str, Cache] = {}


def _counter(data: bytes, digest: str) -> Cache:
    """Counts by word, built once in each process."""
    if digest not in _AUTOMATA:
        _AUTOMATA.clear()
        automaton = Automaton(*pickle.loads(data))

        def count(word: str) -> int:
            n = automaton.count(WORD_MARK + word)
            return n if n >= 0 else _UNKNOWN + 1

        _AUTOMATA[digest] = Cache(count)
    return _AUTOMATA[digest]


def token_counts(
    docs: DataFrame, vocabulary: str, *, text: str = "text", doc_id: str = "doc_id",
) -> DataFrame:
    """``doc_id, n_words, n_tokens, n_unknown`` of every document.

    Words lie between ASCII white space. A word that cannot be cut into pieces is one unknown
    token. A null or empty text has no tokens; repeated rows count alike; other columns are not
    read. Each character is looked at once, however long the text, and there is no shuffle.
    The vocabulary has a fixed size and is sent to the executors.
    """
    data = pickle.dumps(read_pieces(vocabulary))
    digest = hashlib.sha256(data).hexdigest()
    sent = docs.sparkSession.sparkContext.broadcast(data)

    def run(batch: pa.RecordBatch) -> dict:
        get = _counter(sent.value, digest).__getitem__
        words, tokens, unknown = [], [], []
        for text_ in batch.column(1).to_pylist():
            own = words_of(text_)
            total = sum(map(get, own))
            words.append(len(own))
            tokens.append(total & (_UNKNOWN - 1))
            unknown.append(total >> 40)
        return {"doc_id": batch.column(0), "n_words": words, "n_tokens": tokens,
                "n_unknown": unknown}

    return map_batches(
        docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text")), run,
        f"doc_id {dict(docs.dtypes)[doc_id]}, n_words long, n_tokens long, n_unknown long")
