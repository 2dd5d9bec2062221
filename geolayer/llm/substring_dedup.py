"""Substring dedup by hashing lines, cut further at the ends of sentences.

Units are normalised and hashed, digests are grouped over all documents, and of equal units the
earliest one (by document id, then by place) is kept. The others are repeats. A later repeat of a
whole line is removed whatever its length. A run of neighbouring sentence repeats is extended at
both ends by the words of the next unit that also stand beside the kept copy; with enough words it
is removed as far as it matches, by offsets into the original text.

Digests are counted first; only the units whose digest occurs twice meet again to find the earliest.
Texts are not stored between the steps: the words beside runs come from a second read.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geolayer.llm.common import bounded, list_array, map_batches, map_slices, text_of
from geolayer.session import written

MIN_RUN_WORDS = 25
#: From a character that is no space to the end of the sentence or line.
_UNIT = re.compile(r"\S[^\n.!?]*(?:[.!?]+(?![\s.!?]|\Z)[^\n.!?]*)*[.!?]*")


def units_of(text: str) -> list[tuple[int, int, int, bytes]]:
    """``(start, end, words, digest)`` of each unit; offsets count code points.

    Units are compared in lower case with single blanks, by 128 bits of a digest.
    """
    out = []
    for m in _UNIT.finditer(text):
        words = m.group().lower().split()
        digest = hashlib.blake2b(" ".join(words).encode("utf-8"), digest_size=16).digest()
        out.append((m.start(), m.end(), len(words), digest))
    return out


def lines_of(text: str, units: list[tuple[int, int, int, bytes]]) -> list[tuple[int, int]]:
    """First and last unit of each line."""
    out: list[tuple[int, int]] = []
    for i, u in enumerate(units):
        if i and text.find("\n", units[i - 1][1], u[0]) < 0:
            out[-1] = (out[-1][0], i)
        else:
            out.append((i, i))
    return out


def _entries(text: str) -> list[tuple[int, int, int, int, int, bool, bytes]]:
    """``(no, last, start, end, words, whole, digest)`` of units, and of lines of several units.

    A line of one unit has no entry of its own: its unit is marked as a whole line.
    """
    units = units_of(text)
    lines = lines_of(text, units)
    alone = {i for i, j in lines if i == j}
    out = [(i, i, *u[:3], i in alone, u[3]) for i, u in enumerate(units)]
    for i, j in lines:
        if i < j:
            start, end = units[i][0], units[j][1]
            digest = hashlib.blake2b(
                " ".join(text[start:end].lower().split()).encode("utf-8"), digest_size=16,
                person=b"line").digest()
            out.append((i, j, start, end, sum(u[2] for u in units[i:j + 1]), True, digest))
    return out


_ENTRY = {"no": "int", "last": "int", "start": "int", "end": "int", "words": "int",
          "whole": "boolean", "h1": "long", "h2": "long"}
_ARROW = {"int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_()}


def _text_key(doc_id: str, text: str) -> list[Column]:
    """128 bits that tell a row's id and text from those of other rows."""
    body = text_of(text)
    return [F.xxhash64(F.col(doc_id), body).alias("t1"), F.xxhash64(body, F.col(doc_id)).alias("t2")]


def text_units(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document with a key of its text, and its units and lines as arrays; no text."""
    names = ("doc_id", "t1", "t2")

    def run(batch: pa.RecordBatch) -> dict:
        rows = [_entries(t) for t in batch.column(3).to_pylist()]
        lengths = [len(r) for r in rows]
        flat = [u for r in rows for u in r]
        digests = np.frombuffer(b"".join(u[6] for u in flat), "<i8").reshape(-1, 2)
        column = {n: [u[k] for u in flat] for k, n in enumerate(list(_ENTRY)[:6])}
        column |= {"h1": digests[:, 0], "h2": digests[:, 1]}
        return {n: batch.column(k) for k, n in enumerate(names)} | {
            n: list_array(v, lengths, _ARROW[_ENTRY[n]]) for n, v in column.items()}

    return map_slices(
        docs.select(F.col(doc_id).alias("doc_id"), *_text_key(doc_id, text), text_of(text).alias("_text")),
        run, f"doc_id {dict(docs.dtypes)[doc_id]}, t1 long, t2 long, "
        + ", ".join(f"{n} array<{k}>" for n, k in _ENTRY.items()))


def neighbours(docs: DataFrame, text: str, doc_id: str, ends: DataFrame) -> DataFrame:
    """``t1, t2, no, side, at, near``: the text of the unit before (side -1) or after (side 1) unit
    ``no`` of a text, and where it starts. ``ends`` names ``t1, t2, no, side``; units at the edge have
    none.

    The texts are read a second time and meet the list of their own ends. Rows with equal ids and
    texts have one list, and one answer is kept of each.
    """
    asked = ends.distinct().groupBy(F.col("t1").alias("_a1"), F.col("t2").alias("_a2")).agg(
        F.collect_list("no").alias("nos"), F.collect_list("side").alias("sides"))
    held = docs.select(*_text_key(doc_id, text), text_of(text).alias("_text")).join(
        asked, (F.col("t1") == F.col("_a1")) & (F.col("t2") == F.col("_a2")))

    def run(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {n: [] for n in ("t1", "t2", "no", "side", "at", "near")}
        for t1, t2, nos, sides, text in zip(*(c.to_pylist() for c in batch.columns)):
            places = [m.span() for m in _UNIT.finditer(text)]
            for no, side in zip(nos, sides):
                if 0 <= no + side < len(places):
                    start, end = places[no + side]
                    for name, v in zip(out, (t1, t2, no, side, start, text[start:end])):
                        out[name].append(v)
        return out

    return map_slices(
        held.select("t1", "t2", "nos", "sides", "_text"), run,
        "t1 long, t2 long, no int, side int, at int, near string").dropDuplicates(
            ["t1", "t2", "no", "side"])


def matching(own: str, kept: str, side: int) -> tuple[int, int, int]:
    """How many words of ``own`` match ``kept`` from the end that touches the run (side -1: from
    its last word), the offset in ``own`` up to which they match, and the words of ``own``."""
    mine, theirs = list(re.finditer(r"\S+", own)), kept.lower().split()
    if side < 0:
        mine, theirs = mine[::-1], theirs[::-1]
    n = 0
    while n < min(len(mine), len(theirs)) and mine[n].group().lower() == theirs[n]:
        n += 1
    at = 0 if not n else mine[n - 1].start() if side < 0 else mine[n - 1].end()
    return n, at, len(mine)


def extended(
    table: DataFrame, runs: DataFrame, docs: DataFrame, text: str, doc_id: str,
) -> DataFrame:
    """``row, first, side, more, at, size`` of the run ends with matching words beside them.

    Many runs can end at one kept unit; that join is split by Spark where a key is hot.
    """
    keys = table.select("row", "t1", "t2")
    ends = runs.select("row", "first", F.explode(F.array(
        F.struct(F.lit(-1).alias("side"), F.col("first").alias("no"),
                 F.col("kept.row").alias("krow"), F.col("kept.no").alias("kno")),
        F.struct(F.lit(1).alias("side"), F.col("last").alias("no"),
                 F.col("kept_last.row").alias("krow"), F.col("kept_last.no").alias("kno"))))
        .alias("e")).select("row", "first", "e.*")
    ends = written(
        ends.join(keys, "row").join(
            keys.select(F.col("row").alias("krow"), F.col("t1").alias("k1"), F.col("t2").alias("k2")),
            "krow").drop("krow"), "run-ends")
    near = written(neighbours(docs, text, doc_id, ends.select("t1", "t2", "no", "side").union(
        ends.select("k1", "k2", "kno", "side"))), "neighbours")
    both = ends.join(near, ["t1", "t2", "no", "side"]).join(
        near.select(F.col("t1").alias("k1"), F.col("t2").alias("k2"), F.col("no").alias("kno"),
                    "side", F.col("near").alias("other")), ["k1", "k2", "kno", "side"])

    def run(batch: pa.RecordBatch) -> dict:
        found = [matching(*t) for t in zip(
            *(batch.column(n).to_pylist() for n in ("near", "other", "side")))]
        return {n: batch.column(n) for n in ("row", "first", "side")} | {
            "more": [f[0] for f in found], "size": [f[2] for f in found],
            "at": [a + f[1] for a, f in zip(batch.column("at").to_pylist(), found)]}

    return map_batches(
        both.select("row", "first", "side", "at", "near", "other"), run,
        "row long, first int, side int, more int, at int, size int").filter("more > 0")


def joined_spans(pieces: list[dict], least: int) -> list[tuple[int, int, int, dict, str]]:
    """``(start, end, words, kept, kind)`` of one document's runs and repeated lines.

    Runs with fewer words than ``least`` leave only their repeated lines. Neighbouring lines make one
    span, and so do runs that match the whole unit between them from both sides.
    """
    out: list[tuple[int, int, int, dict, str]] = []
    done, touching, reach = -1, -2, 0
    # A run comes before the lines in it.
    for p in sorted(pieces, key=lambda p: (p["first"], -p["last"], p["line"])):
        if p["last"] <= done:
            continue
        if p["line"]:
            if touching == p["first"] - 1 and not reach:
                start, _, words, kept, kind = out.pop()
                out.append((start, p["end"], words + p["words"], kept, kind))
            else:
                out.append((p["start"], p["end"], p["words"], p["kept"], "line"))
            done, touching, reach = p["last"], p["last"], 0
            continue
        left, right = p["left"] or {"more": 0, "at": p["start"]}, p["right"] or {"more": 0, "at": p["end"]}
        words = p["words"] + left["more"] + right["more"]
        if words < least:
            continue
        between = left["more"] and p["first"] == touching + 2 and left["size"]
        if between and reach and reach + left["more"] >= between:
            start, _, before, kept, _ = out.pop()
            out.append((
                start, right["at"], before - reach - left["more"] + between + words, kept, "run"))
        else:
            out.append((left["at"], right["at"], words, p["kept"], "run"))
        done, touching, reach = p["last"], p["last"], right["more"]
    return out


def repeated_spans(
    docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id",
    min_run_words: int = MIN_RUN_WORDS,
) -> DataFrame:
    """Spans to remove: ``doc_id, start, end, n_words, first_doc_id, first_start, kind``.

    ``first_doc_id`` and ``first_start`` tell where the first unit of the span was kept; words matched
    beside it stand there too. ``kind`` is ``line`` for whole repeated lines, removed whatever their
    length, and ``run`` for runs of sentences. A null or empty text has no units, an empty table no
    spans. A null id ranks after all ids; repeated rows are ranked in the order they are read, so the
    later ones are repeats of the first. Other columns are not read. A very long text is one row with
    arrays of its units.

    Digests are counted with map-side aggregates, so a line that a third of all documents hold is
    one row a task. Only units of digests found twice or more go on; where those are joined by shuffle,
    Spark cuts hot keys. Spans of one document meet in one row.
    """
    table = written(
        text_units(docs, text=text, doc_id=doc_id).withColumn(
            "row", F.monotonically_increasing_id()), "units")
    return _spans(table, docs, text, doc_id, min_run_words).drop("row")


def _spans(
    table: DataFrame, docs: DataFrame, text: str, doc_id: str, min_run_words: int,
) -> DataFrame:
    """``repeated_spans`` of written units, with the ``row`` each span lies in."""
    units = table.select("doc_id", "row", F.explode(F.arrays_zip(*_ENTRY)).alias("u")).select(
        "doc_id", "row", "u.*")
    several = written(
        units.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h1", "h2"),
        "repeated-digests")
    found = written(units.join(bounded(several), ["h1", "h2"]), "repeated-units")
    rank = F.struct(
        F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("doc_id"),
        F.col("row").alias("row"), F.col("no").alias("no"), F.col("start").alias("start"))
    first = written(
        found.groupBy("h1", "h2").agg(
            F.min(rank).alias("kept"), F.min(F.when(F.col("whole"), rank)).alias("kept_line")),
        "kept-units")

    def later(kept: str) -> Column:
        return (F.col("row") != F.col(f"{kept}.row")) | (F.col("no") != F.col(f"{kept}.no"))

    repeats = written(
        found.join(bounded(first), ["h1", "h2"]).filter(later("kept"))
        .withColumn("line", F.col("whole") & later("kept_line")).drop("h1", "h2", "whole"),
        "repeats")
    in_place = Window.partitionBy("row").orderBy("no")
    runs = written(
        repeats.filter(F.col("no") == F.col("last"))
        .withColumn("run", F.col("no") - F.row_number().over(in_place))
        .groupBy("row", "run").agg(
            F.first("doc_id").alias("doc_id"), F.min("no").alias("first"),
            F.max("no").alias("last"), F.min("start").alias("start"), F.max("end").alias("end"),
            F.sum("words").cast("long").alias("words"), F.min_by("kept", "no").alias("kept"),
            F.max_by("kept", "no").alias("kept_last")).drop("run"), "runs")
    more = extended(table, runs, docs, text, doc_id)

    def side(k: int) -> Column:
        return F.max(F.when(F.col("side") == k, F.struct("more", "at", "size")))

    more = more.groupBy("row", "first").agg(side(-1).alias("left"), side(1).alias("right"))
    shape = ["row", "doc_id", "first", "last", "start", "end", "words", "line",
             F.struct("kept.doc_id", "kept.start").alias("kept"), "left", "right"]
    kind = more.schema["left"].dataType
    pieces = runs.join(more, ["row", "first"], "left").withColumn("line", F.lit(False)).select(
        *shape).union(
        repeats.filter("line").withColumn("first", F.col("no")).withColumn(
            "kept", F.col("kept_line")).withColumn("words", F.col("words").cast("long"))
        .withColumn("left", F.lit(None).cast(kind)).withColumn("right", F.lit(None).cast(kind))
        .select(*shape))
    own = pieces.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.collect_list(F.struct(*pieces.columns[2:])).alias("pieces"))
    key = dict(table.dtypes)["doc_id"]

    def run(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {n: [] for n in (
            "row", "doc_id", "start", "end", "n_words", "first_doc_id", "first_start", "kind")}
        for row, i, found in zip(*(batch.column(n).to_pylist() for n in ("row", "doc_id", "pieces"))):
            for start, end, words, kept, kind in joined_spans(found, min_run_words):
                for name, v in zip(
                        out, (row, i, start, end, words, kept["doc_id"], kept["start"], kind)):
                    out[name].append(v)
        return out

    return map_batches(own.select("row", "doc_id", "pieces"), run,
                       f"row long, doc_id {key}, start int, end int, n_words long, first_doc_id {key}, "
                       "first_start int, kind string")


def without_spans(text: str, starts: list[int], ends: list[int]) -> str:
    """A text with spans taken out."""
    out, at = [], 0
    for start, end in sorted(zip(starts, ends)):
        out.append(text[at:start])
        at = max(at, end)
    return "".join([*out, text[at:]])


def _cut(docs: DataFrame, own: DataFrame, on: Column, text: str) -> DataFrame:
    """``docs`` with ``_starts, _ends`` of ``own`` taken out of the texts that fit ``on``."""
    cut = docs.join(own, on, "left").select(*docs.columns, "_starts", "_ends")

    def run(batch: pa.RecordBatch) -> dict:
        out = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        rows = zip(*(out[n].to_pylist() for n in (text, "_starts", "_ends")))
        return out | {text: [t if t is None or not s else without_spans(t, s, e)
                             for t, s, e in rows]}

    return map_batches(cut, run, ", ".join(f"`{c}` {k}" for c, k in docs.dtypes))


def _by(spans: DataFrame, key: str) -> DataFrame:
    return spans.groupBy(F.col(key).alias("_at")).agg(
        F.collect_list("start").alias("_starts"), F.collect_list("end").alias("_ends"))


def remove_spans(
    docs: DataFrame, spans: DataFrame, *, text: str = "text", doc_id: str = "doc_id",
) -> DataFrame:
    """``docs`` with the spans of each id taken out of its text.

    An id with spans must name one row: a repeated or null one is an error, since its spans could be
    cut out of another text (``remove_repeats`` takes any ids). The spans of one document meet in one
    row; there are at most as many as it has units.
    """
    own = _by(spans, "doc_id")
    named = docs.select(F.col(doc_id).alias("_id")).join(
        own.select("_at"), F.col("_id").eqNullSafe(F.col("_at")), "left_semi")
    wrong = named.groupBy("_id").count().filter("count > 1 OR _id IS NULL").limit(1).collect()
    if wrong:
        raise ValueError(f"spans need ids that name one row each; {wrong[0]._id} does not")
    return _cut(docs, own, F.col(doc_id) == F.col("_at"), text)


def remove_repeats(
    docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id",
    min_run_words: int = MIN_RUN_WORDS,
) -> DataFrame:
    """``docs`` without the repeats that ``repeated_spans`` finds, whatever the ids.

    The rows are written with a number of their own, and the spans of a row are cut out of that row.
    """
    rows = written(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    # The number takes the place of the row number of the units.
    table = written(text_units(
        rows.select(F.struct(F.col(doc_id).alias("id"), "_row").alias("_key"), F.col(text).alias("_body")),
        text="_body", doc_id="_key").select(
            F.col("doc_id.id").alias("doc_id"), "t1", "t2", *_ENTRY, F.col("doc_id._row").alias("row")),
        "units")
    keyed = rows.withColumn("_key", F.struct(F.col(doc_id).alias("id"), "_row"))
    own = _by(_spans(table, keyed, text, "_key", min_run_words), "row")
    return _cut(rows, own, F.col("_row") == F.col("_at"), text).drop("_row")
