"""License scan by ordered signature rules, in DataFrame functions alone.

A text is first tested for the letters that some rule needs. What passes is written as lower-case
words with single blanks; one pass collects the keywords in it, and only the rules of these keywords
run. A rule marks its matches in the words, so that the places of the marks are the intervals of its
detections. A detection that lies in another one's interval is suppressed; of equal intervals the
rule with the smaller rank stays.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geolayer.llm.common import text_of
from geolayer.llm.license_rules import RULES, Rule

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: White space and punctuation of ASCII; all else, beyond ASCII too, is part of a word.
_BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: The phrases that are counted in any case, and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Score of a text with such a phrase and no detection.
PHRASE_SCORE = 0.5
_OPEN, _CLOSE = "\x01", "\x02"
_RULE = "struct<rank:int,label:string,confidence:double,pattern:string>"


def bounded_pattern(pattern: str) -> str:
    """A pattern over words that begins and ends at words."""
    return f"(?<![^ ])(?:{pattern})(?![^ ])"


def by_keyword(rules: list[Rule]) -> Column:
    """The rules as a constant map of keyword to rules."""
    out: dict[str, list[dict]] = {}
    for r in rules:
        for keyword in r.keywords:
            out.setdefault(keyword, []).append({
                "rank": r.rank, "label": r.label, "confidence": r.confidence,
                "pattern": bounded_pattern(r.pattern)})
    return F.from_json(F.lit(json.dumps(out)), f"map<string,array<{_RULE}>>")


def gate(text: Column, stems: list[str]) -> Column:
    """Whether a text holds one of the stems in any case; a stem with another one in it is left out."""
    least = [w for w in stems if not any(o != w and o in w for o in stems)]
    return text.rlike("(?i)" + "|".join(sorted(set(least))))


def _places(words: Column, phrase: str) -> Column:
    """Where a phrase's words stand one after the other; every place counts, also within another."""
    parts = phrase.split(" ")

    def stands(i: Column) -> Column:
        test = F.get(words, i) == parts[0]
        for k, part in enumerate(parts[1:], 1):
            test = test & (F.get(words, i + k) == part)
        return test

    return F.filter(F.sequence(F.lit(0), F.size(words) - 1), stands)


def _marks(words: Column, opening: bool) -> Column:
    def place(w: Column, i: Column) -> Column:
        return F.when(w.startswith(_OPEN) if opening else w.endswith(_CLOSE), i)

    return F.array_compact(F.transform(words, place))


def _detections(norm: Column, rule: Column) -> Column:
    """Intervals of one rule's matches: ``first``, ``-last``, rank, label, confidence."""
    marked = F.split(F.regexp_replace(norm, rule["pattern"], F.lit(f"{_OPEN}$0{_CLOSE}")), " ")
    return F.transform(F.array(marked), lambda words: F.zip_with(
        _marks(words, True), _marks(words, False), lambda first, last: F.struct(
            first.alias("first"), (-last).alias("back"), rule["rank"].alias("rank"),
            rule["label"].alias("label"), rule["confidence"].alias("confidence"))))[0]


def _surviving(detections: Column) -> Column:
    """``labels`` and the best ``confidence`` of detections in the order of their structs.

    The order is by first word, longest first, then by rank: a detection lies in an earlier one's
    interval if the last word reached so far is not before its own. Nothing here grows with the
    number of detections but the set of labels.
    """
    start = F.struct(
        F.lit(-1).alias("reach"), F.array().cast("array<string>").alias("labels"),
        F.lit(0.0).alias("confidence"))

    def step(state: Column, d: Column) -> Column:
        return F.when(-d["back"] <= state["reach"], state).otherwise(F.struct(
            F.greatest(state["reach"], -d["back"]).alias("reach"),
            F.array_union(state["labels"], F.array(d["label"])).alias("labels"),
            F.greatest(state["confidence"], d["confidence"]).alias("confidence")))

    return F.aggregate(F.array_sort(detections), start, step)


def license_scan(
    docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", rules: list[Rule] = RULES,
    phrases: dict[str, str] | None = None,
) -> DataFrame:
    """One row per document: phrase places and the labels of phrases and rules.

    ``n_words`` counts words; ``n_base, first_word, last_word`` the places of ``phrases`` and the
    smallest and largest (null without one); ``base_labels`` and ``labels`` are sorted and joined by
    commas, empty without any; ``score`` is the best confidence of a detection that stays, at least
    0.5 with a phrase, 0 with nothing. ``detections`` counts all matches before suppression.

    A null or empty text has no words and no labels. Rows are independent: repeated rows and null ids
    give rows like any other, an empty table gives none, nothing is shuffled. Other columns are not
    read. The work on a long text grows with its length and the rules of the keywords it holds.
    """
    phrases = PHRASES if phrases is None else phrases
    keywords = {k for r in rules for k in r.keywords}
    needed = [r.stem for r in rules] + [
        "licen" if "licen" in p else p.split(" ")[0] for p in phrases]
    any_keyword = bounded_pattern("|".join(sorted(keywords, key=len, reverse=True)))
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("t")).select(
        "doc_id", F.regexp_count("t", F.lit(_WORD)).cast("long").alias("n_words"),
        F.when(gate(F.col("t"), needed), F.col("t")).alias("t"))
    # Null from here on for texts that no rule can match.
    rows = rows.select("doc_id", "n_words", F.trim(F.regexp_replace(
        F.translate("t", _UPPER, _LOWER), _BREAK, " ")).alias("norm"))
    rows = rows.select(
        "doc_id", "n_words", "norm", F.split("norm", " ").alias("words"),
        F.array_distinct(F.regexp_extract_all("norm", F.lit(any_keyword), F.lit(0))).alias("held"))
    called = F.array_distinct(F.flatten(F.transform(
        "held", lambda k: F.element_at(by_keyword(rules), k))))
    found = F.filter(called, lambda r: F.rlike(F.col("norm"), r["pattern"]))
    places = [F.when(F.contains("norm", F.lit(p)), _places(F.col("words"), p)).alias(f"p{k}")
              for k, p in enumerate(phrases)]
    rows = rows.select("doc_id", "n_words", "norm", *places, found.alias("found"))
    rows = rows.select(
        "doc_id", "n_words", *(f"p{k}" for k in range(len(phrases))),
        F.flatten(F.transform("found", lambda r: _detections(F.col("norm"), r))).alias("detected"))
    rows = rows.select(
        "doc_id", "n_words", *(f"p{k}" for k in range(len(phrases))),
        F.coalesce(F.size("detected"), F.lit(0)).alias("detections"),
        _surviving(F.col("detected")).alias("own"))
    none = F.array().cast("array<int>")
    every = [F.coalesce(f"p{k}", none) for k in range(len(phrases))]
    base = F.array_compact(F.array(*(
        F.when(F.size(p) > 0, F.lit(label)) for p, label in zip(every, phrases.values()))))
    rows = rows.select(
        "doc_id", "n_words", "detections", "own",
        F.array_sort(F.array_distinct(base)).alias("base"), F.flatten(F.array(*every)).alias("at"))
    labels = F.array_sort(F.array_union(
        "base", F.coalesce("own.labels", F.array().cast("array<string>"))))
    return rows.select(
        "doc_id", "n_words", F.size("at").cast("long").alias("n_base"),
        F.array_min("at").cast("long").alias("first_word"),
        F.array_max("at").cast("long").alias("last_word"),
        F.array_join("base", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
        F.greatest(F.coalesce("own.confidence", F.lit(0.0)),
                   F.when(F.size("at") > 0, F.lit(PHRASE_SCORE)).otherwise(F.lit(0.0))).alias("score"),
        F.coalesce("detections", F.lit(0)).cast("long").alias("detections"))
