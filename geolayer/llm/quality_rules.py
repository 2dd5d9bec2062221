"""Quality rules, line by line first.

Each line is judged by rules on its shape (marks, shouting, links, words without letters, missing
punctuation) and on whole boilerplate phrases in short lines; short bare lines in a row are a menu.
Failing lines are taken out, and a document that loses too much of its text with them is rejected. Before that, a
document fails at once if it is very short or repeats itself.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geolayer.llm.common import map_batches, text_of

# Characters that count as symbols, ends of sentences, marks between menu entries.
SYMBOLS = "#*$%&|<>"
SENTENCE_ENDS = ".!?…。"
MENU_MARKS = "|»›•·"
# Marks that end a line of prose or verse, unlike a menu entry.
LINE_ENDS = SENTENCE_ENDS + ",;:)]\"'»”’-–—"
# Whole phrases of navigation and boilerplate lines, in lower case.
BOILERPLATE = (
    "accept cookies", "all rights reserved", "back to top", "click here", "cookie policy",
    "enable javascript", "javascript is disabled", "log in to", "lorem ipsum", "privacy policy",
    "read more", "sign in", "sign up", "skip to content", "terms of service", "terms of use", "use cookies",
    "alle rechte vorbehalten", "cookies akzeptieren", "mehr lesen", "nach oben", "nutzungsbedingungen",
    "accepter les cookies", "haut de page", "lire la suite", "mentions légales", "tous droits réservés",
    "aceptar cookies", "aviso legal", "leer más", "política de privacidad", "todos los derechos reservados",
)


@dataclass(frozen=True)
class LineRules:
    """Limits of the rules; shares are in percent so that they compare as whole numbers."""

    min_words: int = 10
    max_repeat_percent: int = 20
    #: A line fails if so many of its words in percent are or end in a symbol or menu mark.
    max_marked_percent: int = 30
    #: A line of at least ``shout_words`` words fails if so many of them shout (``WORD!!``).
    max_shouted_percent: int = 30
    shout_words: int = 3
    #: A line of at least so many words without any sentence mark fails.
    long_unpunctuated: int = 100
    #: Phrases count in lines of at most so many words; in longer ones they are part of a sentence.
    phrase_line_words: int = 12
    #: A line fails if so many of its words in percent are addresses of pages or mail.
    max_linked_percent: int = 40
    #: A line of at least ``blank_words`` words fails if so many of them hold no letter.
    max_unlettered_percent: int = 60
    blank_words: int = 3
    #: So many lines in a row of at most ``menu_words`` words, none with a mark at its end, are a menu.
    menu_lines: int = 4
    menu_words: int = 3
    #: A document is rejected if failing lines hold more than this share of its words.
    max_lost_percent: int = 30
    boilerplate: tuple[str, ...] = field(default=BOILERPLATE)


@lru_cache(8)
def _phrases(phrases: tuple[str, ...]) -> re.Pattern[str]:
    """Any of the phrases between word boundaries, with any white space inside."""
    return re.compile(r"(?<!\w)(?:" + "|".join(
        r"\s+".join(map(re.escape, p.split())) for p in phrases) + r")(?!\w)")


def line_fails(words: list[str], line: str, rules: LineRules) -> bool:
    """Whether a line with these words fails, whatever stands around it."""
    n = len(words)
    marked = shouted = linked = unlettered = 0
    for w in words:
        last = w[-1]
        if last in SYMBOLS or last in MENU_MARKS:
            marked += 1
        elif last == "!" and w.endswith("!!"):
            shouted += 1
        elif last in SENTENCE_ENDS and len(w) > 1 and w[-2] in SYMBOLS:
            marked += 1
        if not w.isalpha():
            if "://" in w or w.startswith("www.") or ("@" in w and "." in w):
                linked += 1
            elif not any(map(str.isalpha, w)):
                unlettered += 1
    if 100 * marked > rules.max_marked_percent * n or 100 * linked > rules.max_linked_percent * n:
        return True
    if n >= rules.shout_words and 100 * shouted > rules.max_shouted_percent * n:
        return True
    if n >= rules.blank_words and 100 * unlettered > rules.max_unlettered_percent * n:
        return True
    if n >= rules.long_unpunctuated and not any(c in line for c in SENTENCE_ENDS):
        return True
    return bool(rules.boilerplate) and n <= rules.phrase_line_words and (
        _phrases(rules.boilerplate).search(line.lower()) is not None)


def failing(lines: list[str], own: list[list[str]], rules: LineRules) -> list[bool]:
    """Which lines fail, by themselves or as part of a menu; lines without words neither fail nor end a
    menu."""
    fails = [bool(w) and line_fails(w, line, rules) for w, line in zip(own, lines)]
    run: list[int] = []
    for i, w in enumerate([*own, None]):
        if w is not None and (not w or (len(w) <= rules.menu_words and w[-1][-1] not in LINE_ENDS)):
            if w:
                run.append(i)
            continue
        if len(run) >= rules.menu_lines:
            for k in run:
                fails[k] = True
        run = []
    return fails


def repeated_words(words: list[str], window: int = 5) -> int:
    """Words that lie in a window found twice or more in the text, the first one included.

    Words become numbers in order of appearance and windows become numbers by pairing twice,
    so that equal numbers mean equal windows.
    """
    n = len(words)
    if n <= window:
        return 0
    number: dict[str, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    if len(number) == n:
        return 0
    bits = max(1, (len(number) - 1).bit_length())
    count = n - window + 1
    if bits * window <= 63:
        key = ids[:count].copy()
        for k in range(1, window):
            key = (key << bits) | ids[k:k + count]
    else:
        key = ids
        for k in range(1, window):
            _, key = np.unique(key[:n - k] * np.int64(len(number)) + ids[k:], return_inverse=True)
    _, inverse, times = np.unique(key, return_inverse=True, return_counts=True)
    twice = np.flatnonzero(times[inverse] > 1)
    if not len(twice):
        return 0
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, twice, 1)
    np.add.at(steps, twice + window, -1)
    return int(np.count_nonzero(np.cumsum(steps[:n])))


_SPACE = " \t\n\r\x0b\f"
_ASCII_SPACE = {ord(c): " " for c in _SPACE}
_SYMBOL_SET = SYMBOLS


def words_of(text: str) -> list[str]:
    """Words between the six ASCII white spaces; other Unicode spaces are part of a word."""
    if text.isascii() and not any(c in text for c in "\x1c\x1d\x1e\x1f"):
        return text.split()
    return [w.decode("utf-8") for w in text.encode("utf-8").split()]


def judge(text: str, rules: LineRules) -> tuple[int, int, int, int, int, bool, bool, int]:
    """Counts and verdicts of one text, and the words in its failing lines."""
    words: list[str] = []
    seen: set[str] = set()
    dup_lines = lost = 0
    lines = text.split("\n")
    split = [words_of(line) for line in lines]
    for line, own, fails in zip(lines, split, failing(lines, split, rules)):
        if not own:
            continue
        if line in seen:
            dup_lines += 1
        seen.add(line)
        if fails:
            lost += len(own)
        words += own
    n = len(words)
    repeat = repeated_words(words)
    base = n < rules.min_words or 100 * repeat > rules.max_repeat_percent * n
    symbols = sum(map(text.count, _SYMBOL_SET))
    kept = not base and 100 * lost <= rules.max_lost_percent * n
    return n, sum(map(len, words)), symbols, dup_lines, repeat, base, kept, lost


def quality_rules(
    docs: DataFrame, rules: LineRules = LineRules(), *, text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """Counts, verdicts and words lost with failing lines for every document.

    A null or empty text has no words and fails. Repeated rows are judged alike. Texts are read
    whole; a text is one task's work, in time that grows with its length. Other columns are
    not read; an empty table gives an empty result.
    """
    def run(batch: pa.RecordBatch) -> dict:
        rows = [judge(t, rules) for t in batch.column(1).to_pylist()]
        found = dict(zip(_COLUMNS, zip(*rows)))
        return {"doc_id": batch.column(0)} | {k: list(v) for k, v in found.items()}

    kind = dict(docs.dtypes)[doc_id]
    return map_batches(
        docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text")), run,
        f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
        "n_repeat_words long, base_failed boolean, kept boolean, n_lost_words long")


_COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
            "kept", "n_lost_words")


def clean_lines(docs: DataFrame, rules: LineRules = LineRules(), *, text: str = "text") -> DataFrame:
    """``docs`` with failing lines taken out of the text; null texts stay null."""
    def clean(value: str) -> str:
        lines = value.split("\n")
        fails = failing(lines, [words_of(line) for line in lines], rules)
        return "\n".join(line for line, bad in zip(lines, fails) if not bad)

    def run(batch: pa.RecordBatch) -> dict:
        out = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        out[text] = [None if t is None else clean(t) for t in out[text].to_pylist()]
        return out

    return map_batches(docs, run, ", ".join(f"`{c}` {k}" for c, k in docs.dtypes))
