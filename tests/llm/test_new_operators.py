"""Fill-in-middle, importance resampling and license scan against brute force and on awkward tables."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from geolayer.llm import fill_in_middle as fim
from geolayer.llm import license_rules, queries
from geolayer.llm.common import slices
from geolayer.llm.importance import drawn_documents, resample
from geolayer.llm.license_scan import gate, license_scan

SCHEMA = "doc_id long, text string, n string, weight string, labels string, output string"
LONG = "\n".join(" ".join(f"w{i % 977}x{i % 13}" for i in range(k, k + 40)) for k in range(0, 60_000, 40))
AWKWARD = [
    (1, "One line\nand two.\n"), (2, None), (3, ""), (4, "\n\n\n"), (5, LONG), (6, "same\ntext\nhere"),
    (6, "same\ntext\nhere"), (None, "no id\nat all"), (None, None), (7, "mark <S> inside\nline"),
    (8, "é中文\n𝄞 clef\r\n end"), (9, "<<P<S\n>M>\n<\nP>"), (10, "x" * 300_000 + "\ny"),
    (11, " \t MIT-License, \x00 GNU  general\npublic LICENSE v3; mit license\nmit license")]
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def table(spark, rows):
    """Documents with further columns whose names clash with those of results."""
    return spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def awkward(spark):
    return table(spark, AWKWARD).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return table(spark, [])


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def sorted_rows(rows):
    return sorted(rows, key=repr)


def test_slices_bound_rows_and_bytes():
    batch = pa.RecordBatch.from_arrays(
        [pa.array(["ab", None, "c" * 50, "", "de", "f", "g", "h"])], names=["t"])
    parts = list(slices(batch, rows=3, size=4))
    assert [p.num_rows for p in parts] == [2, 1, 3, 2]
    assert pa.Table.from_batches(parts).to_pydict() == pa.Table.from_batches([batch]).to_pydict()


# Fill in middle

def brute_middle(doc_id, text):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k:8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    prefix, middle, suffix = ("".join(units[i:j]) for i, j in ((0, a), (a, b), (b, len(units))))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")):
        return doc_id, len(units), "plain", None, None, text
    if h4 % 100 < 50:
        out, form = f"<S>{suffix}<P>{prefix}<M>{middle}", "spm"
    else:
        out, form = f"<P>{prefix}<S>{suffix}<M>{middle}", "psm"
    return doc_id, len(units), form, len(prefix), len(middle), out


def test_fill_in_middle_awkward(awkward, empty):
    got = fim.fill_in_middle(awkward)
    assert sorted_rows(tuple(r) for r in got.collect()) == sorted_rows(
        brute_middle(*r) for r in AWKWARD)
    back = fim.restored(got, ["doc_id"]).collect()
    assert sorted_rows((r.doc_id, r.restored) for r in back) == sorted_rows(
        (i, t or "") for i, t in AWKWARD)
    assert fim.fill_in_middle(empty).count() == 0 == fim.restored(fim.fill_in_middle(empty)).count()


def test_fill_in_middle_shares(spark):
    docs = table(spark, [(i, "a\nb\nc\n") for i in range(400)])
    forms = collections.Counter(r.form for r in fim.fill_in_middle(
        docs, middle_percent=50, spm_percent=100).collect())
    assert set(forms) == {"plain", "spm"} and 150 < forms["spm"] < 250


def test_shifts_carry_over_blocks(monkeypatch):
    monkeypatch.setattr(fim, "BLOCK", 7)
    rng = random.Random(4)
    texts = ["".join(rng.choice("ab\n<PSM>é") for _ in range(rng.randrange(0, 30))) for _ in range(300)]
    texts = [t for t in texts if not re.search("<[PSM]>", t)]
    data, starts = fim.buffer_of(pa.array([t.encode() for t in texts], pa.binary()).slice(3))
    texts = texts[3:]
    draws = tuple(np.array([rng.randrange(1 << 32) for _ in texts]) for _ in range(2))
    n, low, high = fim.cuts(data, starts, draws)
    form = np.array([rng.randrange(3) for _ in texts], np.int8)
    out, to = fim.scatter(data, starts, low, high, form)
    back, at = fim.gather(out, to, form)
    assert bytes(back) == "".join(texts).encode() and (at == starts).all()
    assert n.tolist() == [len(re.findall(r"[^\n]*\n|[^\n]+", t)) for t in texts]


def test_lost_marks_are_an_error():
    data, starts = fim.buffer_of(pa.array([b"<P>a<S>b"], pa.binary()))
    with pytest.raises(ValueError):
        fim.gather(data, starts, np.array([fim.PSM]))


# Importance resampling

def brute_resampling(docs, target, ngram, buckets, least, percent):
    def features(text):
        own = words(text)
        return [" ".join(own[i:i + n]) for n in range(1, ngram + 1) for i in range(len(own) - n + 1)]

    def bucket(f):
        return zlib.crc32(f.encode()) % buckets

    s = collections.Counter(bucket(f) for _, t in docs for f in features(t))
    t = collections.Counter(bucket(f) for text in target for f in features(text))
    n, m = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[k] + 1) * (n + buckets) / ((s[k] + 1) * (m + buckets))))
            for k in range(buckets)]
    rows = []
    for i, text in docs:
        own = features(text)
        weight = sum(gain[bucket(f)] for f in own)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32)))
        rows.append((i, len(own), weight, score, len(words(text))))
    pool = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0]))
    ranks = collections.defaultdict(list)
    for k, r in enumerate(pool[:len(pool) * percent // 100], 1):
        ranks[r].append(k)
    return [(*r[:4], ranks[r].pop() if ranks[r] else None) for r in rows]


@pytest.mark.parametrize("ngram,least,percent", [(1, 20, 10), (3, 2, 60)])
def test_resampling(spark, awkward, ngram, least, percent):
    target = ["Same text again and again.", "two\nwords", None, "clef é中文"]
    got = resample(awkward, spark.createDataFrame([(t,) for t in target], "text string"),
                   ngram=ngram, buckets=500, min_words=least, percent=percent)
    assert sorted_rows(tuple(r) for r in got.collect()) == sorted_rows(
        brute_resampling(AWKWARD, target, ngram, 500, least, percent))


def test_resampling_empty(spark, awkward, empty):
    none = spark.createDataFrame([], "text string")
    assert resample(empty, none).count() == 0
    assert resample(awkward, none).count() == len(AWKWARD)


def test_drawn_documents(spark, awkward):
    target = spark.createDataFrame([("same text",)], "text string")
    options = {"min_words": 2, "percent": 50}
    ranked = [r.doc_id for r in resample(awkward, target, **options).filter("rank is not null").collect()]
    drawn = drawn_documents(awkward, target, **options)
    assert drawn.columns == awkward.columns
    assert set(ranked) == {r.doc_id for r in drawn.collect()}


# License scan

def brute_licenses(doc_id, text):
    own = words(text)
    norm = " ".join(own)
    at, base = [], set()
    for phrase, label in (("mit license", "mit"), ("apache license", "apache"),
                          ("general public license", "gpl")):
        parts = phrase.split()
        found = [i for i in range(len(own)) if own[i:i + len(parts)] == parts]
        at += found
        base |= {label} if found else set()
    hits = []
    for r in license_rules.RULES:
        for m in re.finditer(rf"(?<![^ ])(?:{r.pattern})(?![^ ])", norm):
            hits.append((norm.count(" ", 0, m.start()), norm.count(" ", 0, m.end()), r))
    kept = [(a, z, r) for a, z, r in hits if not any(
        a2 <= a and z <= z2 and (a2 < a or z < z2 or r2.rank < r.rank) for a2, z2, r2 in hits)]
    labels = base | {r.label for _, _, r in kept}
    score = max([r.confidence for _, _, r in kept] + [0.5] * bool(at) + [0.0])
    return (doc_id, len(own), len(at), min(at, default=None), max(at, default=None),
            ",".join(sorted(base)), ",".join(sorted(labels)), score, len(hits))


LICENSED = [
    (20, "Released under the MIT License."), (21, "Licensed under CC BY-NC 4.0."),
    (22, "This work is licensed under the GNU General Public License, version 3."),
    (23, "Licensed under the Apache License, Version 2.0."),
    (24, "// SPDX-License-Identifier: GPL-3.0-or-later\n/* Apache-2.0 */ see gnu.org/licenses/lgpl-2.1"),
    (25, "MIT mit license license\nMIT LICENSE"), (26, "Licensing the mitigated apache helicopters."),
    (27, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    (28, "you may use the Mozilla Public License 2.0 or the Eclipse Public License v1.0; all rights reserved"),
    (29, "creative commons attribution share-alike 3.0 licence; CC0 1.0; LGPLv3; wtfpl, 2-Clause BSD License"),
    (30, "mit license " * 3000)]


def test_license_scan(spark, awkward, empty):
    rows = AWKWARD + LICENSED
    got = license_scan(awkward.unionByName(table(spark, LICENSED))).collect()
    assert sorted_rows(tuple(r) for r in got) == sorted_rows(brute_licenses(*r) for r in rows)
    labels = {r.doc_id: r.labels for r in got}
    assert [labels[i] for i in (20, 21, 22, 23, 26)] == [
        "mit", "cc-by-nc-4.0", "gpl,gpl-3", "apache,apache-2.0", ""]
    assert {"gpl-3", "apache-2.0", "lgpl-2.1"} == set(labels[24].split(","))
    assert labels[27] == "mit" and "mpl-2.0" in labels[28] and "epl-1.0" in labels[28]
    assert license_scan(empty).count() == 0


def test_every_rule_passes_its_gates(spark):
    """A text made from a rule's pattern gets through the letters and the keywords, and matches it."""
    def example(pattern):
        while "(?:" in pattern:
            pattern = re.sub(
                r"\(\?:([^()]*)\)(\??)", lambda m: "" if m[2] else m[1].split("|")[0], pattern, count=1)
        return re.sub(r"\[(.)[^]]*\]", r"\1", re.sub(r".\?", "", pattern))

    assert 300 < len(license_rules.RULES) and len({r.pattern for r in license_rules.RULES}) == len(
        license_rules.RULES)
    made = [(r.rank, example(r.pattern)) for r in license_rules.RULES]
    for r, (_, text) in zip(license_rules.RULES, made):
        assert re.fullmatch(r.pattern, text), r
        assert set(text.split()) & set(r.keywords), r
        assert re.search(r.stem, text.replace("cc by", "CC-By"), re.I), r
    docs = table(spark, [(i, t.title().replace(" ", "-")) for i, t in made])
    scanned = {r.doc_id: r for r in license_scan(docs).collect()}
    for r in license_rules.RULES:
        assert r.label in scanned[r.rank].labels.split(",") or scanned[r.rank].detections > 1, r
    assert docs.filter(~gate(F.col("text"), [r.stem for r in license_rules.RULES])).count() == 0


@pytest.mark.parametrize("name", ["op11_fill_in_middle", "op13_license_scan"])
def test_nothing_is_shuffled(spark, sf, name):
    plan = queries.QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    if name == "op13_license_scan":
        assert "Python" not in plan and "MapInArrow" not in plan
