"""The text operators against brute force, and on awkward tables."""

import collections
import hashlib
import itertools
import math
import random
import re
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from geolayer.llm import bpe, near_dedup, queries
from geolayer.llm.common import Cache
from geolayer.llm.exact_dedup import exact_dedup, unique_documents
from geolayer.llm.lm_scoring import lm_scores, prefix_code
from geolayer.llm.mixing import mix_copies, mixed_documents, source_targets, times, with_plan
from geolayer.llm.near_dedup import distinct_documents, near_duplicates
from geolayer.llm.quality_classifier import fit, good_documents, labelled, scored
from geolayer.llm.quality_rules import clean_lines, quality_rules
from geolayer.llm.sharding import shard_documents
from geolayer.llm.substring_dedup import remove_repeats, remove_spans, repeated_spans
from geolayer.llm.token_counts import Automaton, read_pieces, token_counts

SCHEMA = "doc_id long, text string, source string, kept string, score string, size string"
PIECES = public_tokenizers.path("piece_bpe_32k.model")
VOCAB = public_tokenizers.path("byte_bpe_50k.json")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def table(spark, rows):
    """Documents with further columns whose names clash with those of results."""
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)


LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(40_000))
AWKWARD = [
    (1, "The cat sat on the mat. It was warm.", "a"), (2, None, None), (3, "", "a"),
    (4, " \t\n", "b"), (5, LONG, "b"), (6, "The cat sat on the mat. It was warm.", None),
    (6, "The cat sat on the mat. It was warm.", None), (None, "no id at all", "a"),
    (None, None, "a"), (7, "word", "b"), (8, "x" * 30_000, "a"), (9, "a\x00b ünï中文 \x85 end", "b"),
]


@pytest.fixture(scope="module")
def documents(spark, sf):
    return queries.documents(spark, sf)


@pytest.fixture(scope="module")
def rows(documents):
    return {r.doc_id: r.text for r in documents.collect()}


@pytest.fixture(scope="module")
def awkward(spark):
    return table(spark, AWKWARD).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return table(spark, [])


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


# Token counts

def test_automaton_matches_word_pieces():
    from tokenizers.models import WordPiece

    first, further = read_pieces(PIECES)
    vocab = {p: i for i, p in enumerate([*first, *("##" + p for p in further), "[UNK]"])}
    model = WordPiece(vocab, unk_token="[UNK]", max_input_chars_per_word=10**6)
    automaton, rng = Automaton(first, further), random.Random(3)
    some = ["".join(rng.choice("abcdeorstnié.,1X中") for _ in range(rng.randint(1, 14)))
            for _ in range(3000)] + ["a" * 5000]
    for w in some:
        got = [t.value for t in model.tokenize("▁" + w)]
        assert automaton.count("▁" + w) == (-1 if got == ["[UNK]"] else len(got)), w


def test_small_automaton():
    automaton = Automaton(["a", "abcd"], ["b", "bc", "z"])
    assert [automaton.count(w) for w in ("a", "abcd", "abc", "abcz", "az", "abcx", "q")] == [
        1, 1, 2, 3, 2, -1, -1]


def test_token_counts(spark, awkward, empty):
    got = {(r.doc_id, r.n_words) for r in token_counts(awkward, PIECES).collect()}
    assert {(i, len(words(t))) for i, t, _ in AWKWARD} == got
    assert token_counts(empty, PIECES).count() == 0


# Substring dedup

def sentences(line, at):
    """``(start, end)`` of the sentences of one line: up to marks that white space or the end follows."""
    out, i = [], 0
    while i < len(line):
        if line[i].isspace():
            i += 1
            continue
        start, i = i, i + 1
        while i < len(line):
            if line[i] not in ".!?":
                i += 1
                continue
            while i < len(line) and line[i] in ".!?":
                i += 1
            if i == len(line) or line[i].isspace():
                break
        out.append((at + start, at + i))
    return out


def brute_spans(docs, least):
    """Spans by the rule of the operator, straight from texts: no digests and no shared code."""
    lines, units = {}, {}
    for i, text in docs.items():
        at, units[i], lines[i] = 0, [], []
        for line in (text or "").split("\n"):
            own = sentences(line, at)
            if own:
                lines[i].append((len(units[i]), len(units[i]) + len(own) - 1))
                units[i] += own
            at += len(line) + 1

    def said(i, a, b):
        return tuple(docs[i][units[i][a][0]:units[i][b][1]].lower().split())

    first, first_line = {}, {}
    for i in sorted(docs):
        alone = {a for a, b in lines[i] if a == b}
        for k in range(len(units[i])):
            first.setdefault(said(i, k, k), (i, k))
            if k in alone:
                first_line.setdefault(("one", said(i, k, k)), (i, k))
        for a, b in lines[i]:
            if a < b:
                first_line.setdefault(("more", said(i, a, b)), (i, a))

    def side_words(i, k):
        return said(i, k, k) if 0 <= k < len(units[i]) else ()

    def alike(mine, theirs):
        n = 0
        while n < min(len(mine), len(theirs)) and mine[n] == theirs[n]:
            n += 1
        return n

    out = set()
    for i in docs:
        again = [k for k in range(len(units[i])) if first[said(i, k, k)] != (i, k)]
        spans, gone = [], set()
        runs = [(k, max(j for j in range(k, len(units[i])) if set(range(k, j + 1)) <= set(again)))
                for k in again if k - 1 not in again]
        for a, b in runs:
            n = sum(len(said(i, k, k)) for k in range(a, b + 1))
            before, after = side_words(i, a - 1), side_words(i, b + 1)
            fi, fk = first[said(i, a, a)]
            li, lk = first[said(i, b, b)]
            left = alike(before[::-1], side_words(fi, fk - 1)[::-1])
            right = alike(after, side_words(li, lk + 1))
            if n + left + right >= least:
                spans.append((a, b, left, right, n, len(before)))
                gone |= set(range(a, b + 1))
        cut = []
        for a, b, left, right, n, between in spans:
            start = units[i][a][0] if not left else [
                m.start() for m in re.finditer(r"\S+", docs[i][:units[i][a - 1][1]])][-left]
            end = units[i][b][1] if not right else units[i][b + 1][0] + [
                m.end() for m in re.finditer(r"\S+", docs[i][slice(*units[i][b + 1])])][right - 1]
            cut.append((a, b, start, end, n + left + right, "run", left, right, between))
        for a, b in lines[i]:
            key = ("one" if a == b else "more", said(i, a, b))
            if first_line[key] != (i, a) and b not in gone and not set(range(a, b + 1)) <= gone:
                cut.append((a, b, units[i][a][0], units[i][b][1], len(said(i, a, b)), "line", 0, 0, 0))
        # What lies in a span further left is part of it already.
        merged = []
        for p in sorted(cut, key=lambda p: (p[0], -p[1], p[5] == "line")):
            if merged and p[1] <= merged[-1]["last"]:
                continue
            prior = merged[-1] if merged else None
            if p[5] == "line" and prior and prior["last"] == p[0] - 1 and not prior["reach"]:
                prior.update(last=p[1], end=p[3], n=prior["n"] + p[4])
            elif (p[5] == "run" and prior and p[6] and prior["reach"] and prior["last"] == p[0] - 2
                  and prior["reach"] + p[6] >= p[8]):
                prior.update(last=p[1], end=p[3], n=prior["n"] - prior["reach"] - p[6] + p[8] + p[4],
                             reach=p[7], kind="run")
            else:
                merged.append({"last": p[1], "start": p[2], "end": p[3], "n": p[4], "kind": p[5],
                               "reach": p[7]})
        out |= {(i, m["start"], m["end"], m["n"], m["kind"]) for m in merged}
    return out


def test_repeated_spans(spark, documents, rows, empty):
    got = {(r.doc_id, r.start, r.end, r.n_words, r.kind)
           for r in queries.op2_substring_dedup(spark, "/root/testdata/sf0.001").collect()}
    assert got == brute_spans(rows, 25) and {g[4] for g in got} == {"line", "run"}
    assert repeated_spans(empty).count() == 0


def test_repeats_are_cut_out_of_their_own_rows(spark, empty):
    line = "A line of words that all of these texts hold."
    docs = table(spark, [
        (6, line, "a"), (6, line, "a"), (6, f"{line}\nOther words here.", "a"), (None, line, "b"),
        (None, f"Not the same.\n{line}", "b"), (7, "Clean text.", "b"), (8, None, "b")])
    left = remove_repeats(docs)
    assert left.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=repr) == sorted([
        (6, line), (6, ""), (6, "\nOther words here."), (None, ""), (None, "Not the same.\n"),
        (7, "Clean text."), (8, None)], key=repr)
    with pytest.raises(ValueError, match="one row"):
        remove_spans(docs, repeated_spans(docs))
    assert remove_repeats(empty).count() == 0


def test_spans_are_cut_and_first_stays(spark, awkward):
    passage = " ".join(f"Sentence {i} of it is long." for i in range(12))
    docs = table(spark, [(1, f"Intro here. {passage} Tail one.", "a"), (2, f"{passage}\nOther.", "a"),
                         (3, f"More words. {passage.upper()}", "a"), (4, None, "a"), (5, "Clean.", "a")])
    spans = repeated_spans(docs)
    assert {(r.doc_id, r.first_doc_id, r.first_start) for r in spans.collect()} == {(2, 1, 12), (3, 1, 12)}
    left = by_id(remove_spans(docs, spans))
    assert left[1].text.endswith("Tail one.") and left[2].text == "\nOther." and left[4].text is None
    assert left[3].text == "More words. " and left[5].text == "Clean."
    assert {r.doc_id for r in repeated_spans(awkward, min_run_words=5).collect()} == {6}


def test_repeats_are_whole(spark):
    rng = random.Random(7)

    def fresh(n):
        return " ".join(f"{rng.choice('bcdfghkl')}{rng.randrange(10**9):x}" for _ in range(n))

    sentence, other, one, two = fresh(12), fresh(12), fresh(14), fresh(14)
    a, b, c = fresh(6), fresh(6), fresh(6)
    passage = f"{fresh(15)}. {sentence}. {fresh(14)}"
    docs = table(spark, [
        (1, f"{fresh(9)} {passage} {fresh(8)}.\nShort line. Two parts.\n{fresh(6)}. {other}. {fresh(6)}.", "a"),
        # Starts and ends inside sentences; twelve words of it are a whole unit.
        (2, f"{fresh(5)} {passage.upper()} {fresh(7)}.", "a"),
        # A whole line of four words, and one that is no repeat of a line.
        (3, f"{fresh(5)}\n short LINE.  Two parts. \nTwo parts.", "a"),
        # The same sentence among other words is too short.
        (4, f"{fresh(6)}. {other}. {fresh(6)}.", "a"),
        # The unit between two repeats matches from both ends, beside different copies: one span.
        (5, f"{one}. {a} {b} {fresh(6)}.\n{fresh(6)} {b} {c}. {two}.", "a"),
        (6, f"{one}. {a} {b} {c}. {two}.", "a")])
    spans = repeated_spans(docs)
    left = by_id(remove_spans(docs, spans))
    before = by_id(docs)
    assert {(r.doc_id, r.n_words, r.first_doc_id) for r in spans.collect()} == {
        (2, 41, 1), (3, 4, 1), (6, 46, 5)}
    assert len(words(left[2].text)) == 12 and passage.upper().split()[0] not in left[2].text
    assert words(left[3].text)[5:] == ["Two", "parts."] and not words(left[6].text)
    for i in (1, 4, 5):
        assert left[i].text == before[i].text


def test_repeated_windows_are_removed(spark, documents, rows):
    """Word windows know nothing of units: 50 words seen in an earlier document lose some word."""
    spans = collections.defaultdict(list)
    for r in repeated_spans(documents).collect():
        spans[r.doc_id].append((r.start, r.end))
        removed = words(rows[r.doc_id][r.start:r.end])
        assert len(removed) == r.n_words
    seen, lost, runs = set(), 0, 0
    for i, text in sorted(rows.items()):
        found = [(m.start(), m.end()) for m in re.finditer(r"\S+", text or "")]
        own = [text[a:b].lower() for a, b in found]
        at = [tuple(own[k:k + 50]) for k in range(len(own) - 49)]
        cover = [False] * len(own)
        for k, w in enumerate(at):
            if w in seen:
                cover[k:k + 50] = [True] * 50
        gone = [any(s <= a and b <= e for s, e in spans[i]) for a, b in found]
        for held, part in itertools.groupby(range(len(own)), cover.__getitem__):
            if held:
                runs, lost = runs + 1, lost + (not any(gone[k] for k in part))
        seen.update(at)
    assert runs > 30 and lost == 0


# Mixing

def test_targets_share_the_excess(spark):
    sizes = spark.createDataFrame([("a", 1000), ("b", 10), ("c", 500), (None, 100)],
                                  "source string, source_size long")
    got = {r.source: r.target for r in source_targets(sizes).collect()}
    assert got["b"] == 20 and got[None] == 200
    assert sum(got.values()) == pytest.approx(1.5 * 1610)
    assert got["a"] / 5 == pytest.approx(got["c"] / 1)


def test_mix_comes_near_its_targets(spark, documents):
    got = queries.op3_mixing(spark, "/root/testdata/sf0.001").collect()
    source = {r.doc_id: r.source for r in documents.collect()}
    taken, target, most = collections.Counter(), {}, collections.Counter()
    for r in got:
        assert 0 <= r.taken <= 2 * r.size
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
        most[source[r.doc_id]] = max(most[source[r.doc_id]], r.size)
    assert all(abs(taken[s] - target[s]) <= most[s] / 2 + 1 for s in target)


def test_mixing_awkward(spark, awkward, empty):
    sized, plan = mix_copies(awkward)
    rows = with_plan(sized, "source", plan).withColumn("t", times(F.col("hash"))).collect()
    assert len(rows) == len(AWKWARD) and all(0 <= r.t <= 2 for r in rows)
    assert len({r.t for r in rows if r.doc_id == 6}) == 1
    mix = mixed_documents(awkward)
    assert mix.columns == awkward.columns
    assert mix.count() == sum(r.t for r in rows)
    assert mixed_documents(empty).count() == 0


# BPE

@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(VOCAB)


def test_encoding_matches(tokenizer, rows):
    codec, rng = bpe.Codec(bpe.read_vocabulary(VOCAB)), random.Random(5)
    parts = [" ", "\n", "\t", "  ", "a", "bé", "1.", "'s", " ", "\xa0", "中文", "'ll", "\x85",
             "<|endoftext|>", "\r\n", "don't", "!!", "\x1c", "́", "🙂", "\x00"]
    fuzz = ["".join(rng.choice(parts) for _ in range(rng.randrange(14))) for _ in range(5000)]
    for text in [*rows.values(), *fuzz, "ab" * 20_000, " " * 3000, "", "é" * 5000]:
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        got = np.frombuffer(codec.encode(text), "<u4").tolist()
        assert got == ids, text[:80]
        assert codec.decode(got) == tokenizer.decode(ids, skip_special_tokens=False) == text


def test_encode_documents(awkward, empty, tokenizer):
    got = bpe.encode_documents(awkward, VOCAB).collect()
    want = collections.Counter()
    for i, text, _ in AWKWARD:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        want[i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
             hashlib.sha256((text or "").encode()).hexdigest()] += 1
    assert want == collections.Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got)
    assert all(len(r.ids) == r.n_tokens for r in got)
    assert bpe.encode_documents(empty, VOCAB).count() == 0


def test_cache_keeps_results_right():
    cache = Cache(len, limit=5, longest=6)
    for k in [str(i) * (i % 9 + 1) for i in range(60)] * 2:
        assert cache[k] == len(k)
    assert len(cache) <= 5 and len(cache.old) <= 5


# Near dedup

def brute_components(texts, size=2):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for t in texts:
        w = words((t or "").translate(low))
        k = min(size, len(w))
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set())
    head = list(range(len(texts)))

    def top(x):
        while head[x] != x:
            x = head[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            if sets[a] and sets[b] and 5 * min(len(sets[a]), len(sets[b])) >= 4 * max(len(sets[a]), len(sets[b])):
                n = len(sets[a] & sets[b])
                if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
                    x, y = sorted((top(a), top(b)))
                    head[y] = x
    return sets, [top(i) for i in range(len(texts))]


def test_near_duplicates(spark, rows):
    ids = sorted(rows)
    sets, heads = brute_components([rows[i] for i in ids])
    got = by_id(queries.op5_near_dedup(spark, "/root/testdata/sf0.001"))
    for k, i in enumerate(ids):
        assert (got[i].n_shingles, got[i].component_id, got[i].kept) == (
            len(sets[k]), ids[heads[k]], heads[k] == k)


def test_group_of_near_copies_in_many_components(spark, monkeypatch):
    """A crowd in which most pairs are below the limit: blocks and sketches must lose no link."""
    monkeypatch.setattr(near_dedup, "BLOCK", 20)
    rng = random.Random(11)
    base = [f"b{i}" for i in range(120)]
    texts = []
    for _ in range(150):
        own = list(base)
        for k in rng.sample(range(120), rng.randint(2, 9)):
            own[k] = f"n{rng.random()}"
        texts.append(" ".join(own))
    _, heads = brute_components(texts)
    got = by_id(near_duplicates(table(spark, [(i, t, "a") for i, t in enumerate(texts)])))
    assert [got[i].component_id for i in range(len(texts))] == heads and len(set(heads)) > 3


def test_near_awkward(spark, awkward, empty):
    got = near_duplicates(awkward).collect()
    assert len(got) == len(AWKWARD)
    of = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in got}
    assert of[6, 8] == (1, False) and of[1, 8] == (1, True) and of[2, 0] == (2, True)
    assert of[4, 0] == (4, True) and of[None, 3] == (None, True) and of[7, 1] == (7, True)
    kept = distinct_documents(awkward)
    assert kept.columns == awkward.columns and kept.count() == len(AWKWARD) - 2
    assert near_duplicates(empty).count() == 0


# Language model

def test_base_scores_and_held_out_gain(spark, rows):
    counts = collections.Counter()
    for i, t in rows.items():
        if zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update(t.encode().lower().split() + [None])
    total, distinct = sum(counts.values()), len(counts)
    better = []
    for most in (1 << 19, 300):
        got = by_id(lm_scores(queries.documents(spark, "/root/testdata/sf0.001"), most_words=most))
        for i, t in rows.items():
            own = t.encode().lower().split() + [None]
            base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in own)
            r = got[i]
            assert (r.held_out, r.n_tokens, r.train_tokens) == (zlib.crc32(str(i).encode()) % 7 == 2, len(own), total)
            assert r.n_known == sum(counts[w] > 0 for w in own)
            assert r.base_score == pytest.approx(base, rel=1e-9) and r.score < 0
        held = [r for r in got.values() if r.held_out]
        better.append(sum(r.score for r in held) > sum(r.base_score for r in held))
    assert better[0]


def test_prefix_code_is_complete():
    lengths, codes = prefix_code(np.array([50, 20, 10, 5, 5, 1]))
    assert sum(2.0 ** -lengths) == 1
    texts = {format(c, f"0{n}b") for n, c in zip(lengths.tolist(), codes.tolist())}
    assert not any(a != b and b.startswith(a) for a in texts for b in texts)


def test_lm_awkward(awkward, empty):
    got = lm_scores(awkward).collect()
    assert len(got) == len(AWKWARD) and all(r.score <= 0 and r.base_score <= 0 for r in got)
    assert {r.n_tokens for r in got if r.doc_id in (2, 3, 4)} == {1}
    assert lm_scores(empty).count() == 0


def test_lm_without_training_texts(spark):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    r = lm_scores(table(spark, [(held, "new words", "a")])).first()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (3, 0, 0, 0.0)


# Quality rules

def test_quality_rules(spark, rows):
    got = by_id(queries.op7_quality_rules(spark, "/root/testdata/sf0.001"))
    for i, t in rows.items():
        w = words(t)
        seen, repeated = collections.Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4)), set()
        for k in range(len(w) - 4):
            if seen[tuple(w[k:k + 5])] > 1:
                repeated |= set(range(k, k + 5))
        lines, before = 0, set()
        for line in t.split("\n"):
            lines += bool(words(line)) and line in before
            before.add(line)
        base = len(w) < 10 or 100 * len(repeated) > 20 * len(w)
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (
            len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), lines, len(repeated), base)
        assert not (base and r.kept)


def test_lines_decide(spark, awkward, empty):
    good = " ".join(f"Plain{i} words{i} number{i} go{i} here{i}." for i in range(6))
    menu = "Home | About | News | Shop | Contact | Help | Jobs | Press | More | Last"
    docs = table(spark, [(1, good, "a"), (2, menu, "a"), (3, f"{good}\n{menu}\n{menu} x", "a"),
                         (4, f"{good}\nAll rights reserved by us", "a"),
                         (5, "LOUD!! WORDS!! " * 2 + "ALL!! OVER!! HERE!! NOW!! YES!! NO!! SO!!", "a")])
    got = by_id(quality_rules(docs))
    assert {i: r.kept for i, r in got.items()} == {1: True, 2: False, 3: False, 4: True, 5: False}
    assert by_id(clean_lines(docs))[4].text == good
    assert len(quality_rules(awkward).collect()) == len(AWKWARD)
    assert quality_rules(empty).count() == 0 and clean_lines(empty).count() == 0


def test_line_rules_by_shape(spark):
    prose = " ".join(f"Plain{i} words{i} number{i} go{i} here{i}." for i in range(6))
    house = "The new design in this house is very good for all of us here."
    menu = "\n".join(["Home", "About us", "", "News", "Shop", "Contact"])
    verse = "\n".join(["Roses are red,", "violets blue,", "sugar is sweet,", "and so on."] * 1)
    cases = {
        1: (house, True), 2: (menu + "\nJobs\nPress here\nHelp\nMore", False), 3: (verse, True),
        4: (f"{prose}\n{menu}", True), 5: ("see https://a.example/x and www.b.example or me@c.example "
                                           "http://d.example/1 http://e.example/2 now", False),
        6: ("12 34 56 78 90 11 22 33 44 words", False), 7: ("Please SIGN  IN to see all ten words of it", False),
        8: ("Spread more of the jam on ten slices of bread today.", True),
        9: ("Alle Rechte vorbehalten, das sind die zehn Wörter in Zeile eins.", False),
        10: ("Home\nAbout\nNews\n" + prose, True)}
    docs = table(spark, [(k, t, "a") for k, (t, _) in cases.items()])
    got = by_id(quality_rules(docs))
    assert {k: got[k].kept for k in cases} == {k: kept for k, (_, kept) in cases.items()}
    cleaned = by_id(clean_lines(docs))
    assert cleaned[4].text == f"{prose}\n" and cleaned[10].text == cases[10][0] and cleaned[1].text == house


# Quality classifier

def test_classifier_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    marks = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = queries.op8_quality_classifier(spark, sf).collect()
    held = [r for r in got if r.held_out and r.doc_id in marks]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    good = [r.score for r in held if marks[r.doc_id] == 1]
    bad = [r.score for r in held if marks[r.doc_id] == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.9
    assert np.mean([g >= 0.3 for g in good]) > 0.97


def test_classifier_awkward(spark, awkward, empty):
    labels = spark.createDataFrame(
        [(1, 1), (1, 1), (5, 0), (5, 0), (8, 0), (7, None), (None, 1), (4, 3), (99, 1)],
        "doc_id long, quality int")
    training = labelled(awkward, labels, folds=None)
    assert sorted((r.n, r.good) for r in training.collect()) == [(1, 0), (2, 0), (2, 2)]
    got = scored(awkward, fit(training)).collect()
    assert len(got) == len(AWKWARD) and all(0 <= r.score <= 1 for r in got)
    assert good_documents(awkward, labels).columns == awkward.columns
    none = fit(labelled(empty, labels))
    assert {r.score for r in scored(awkward, none).collect()} == {1.0}
    assert scored(empty, none).count() == 0


# Exact dedup

def test_exact_dedup(spark, awkward, empty):
    docs = table(spark, [
        (5, "a b c", "s"), (3, "abc", "s"), (4, "a bc ", "s"), (2, "abd", "s"), (1, None, "s"),
        (None, "", "s"), (9, " ", "s"), (7, "p" * 300 + "q", "s"), (8, "p" * 300 + "r", "s"),
        (6, "z", "s"), (6, "z", "s")])
    got = exact_dedup(docs).collect()
    assert sorted((r.doc_id or 0, r.keep_id, r.group_size) for r in got) == [
        (0, 9, 3), (1, 9, 3), (2, 2, 1), (3, 4, 3), (4, 4, 3), (5, 4, 3), (6, 6, 2), (6, 6, 2), (7, 7, 1),
        (8, 8, 1), (9, 9, 3)]
    assert sorted(r.doc_id for r in got if r.kept) == [2, 4, 6, 7, 8, 9]
    kept = unique_documents(docs)
    assert kept.columns == docs.columns and kept.count() == 6
    assert exact_dedup(awkward).count() == len(AWKWARD) and exact_dedup(empty).count() == 0


def test_exact_dedup_of_large_groups(spark):
    """Groups joined by broadcast beside groups joined by shuffle."""
    rows = [(i, " " * (i % 5) + ("hot text" if i % 3 else f"group {i % 60}"), "s") for i in range(3000)]
    got = by_id(exact_dedup(table(spark, rows)))
    groups = collections.defaultdict(list)
    for i, t, _ in rows:
        groups["".join(words(t))].append((-len(t), i))
    assert max(map(len, groups.values())) == 2000 and len(groups) == 21
    for members in groups.values():
        for _, i in members:
            assert (got[i].keep_id, got[i].group_size, got[i].kept) == (
                min(members)[1], len(members), i == min(members)[1])


# Sharding

def test_sharding(spark, rows, awkward, empty):
    got = by_id(queries.op10_sharding(spark, "/root/testdata/sf0.001"))
    slots = collections.defaultdict(list)
    for i, r in got.items():
        data = rows[i].encode()
        assert (r.size, r.text_crc32, r.law) == (len(data) + 16, zlib.crc32(data), "key")
        assert r.grown_shard in (r.shard, 40) and 0 <= r.shard < 40
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    grown = by_id(shard_documents(queries.documents(spark, "/root/testdata/sf0.001"), [1.0] * 41))
    assert {i: r.shard for i, r in grown.items()} == {i: r.grown_shard for i, r in got.items()}
    odd = shard_documents(awkward, [1.0, 3.0]).collect()
    assert len(odd) == len(AWKWARD) and len({r.shard for r in odd if r.doc_id is None}) == 1
    assert sorted((r.shard, r.slot) for r in odd) == sorted(
        (s, k) for s, n in collections.Counter(r.shard for r in odd).items() for k in range(n))
    assert shard_documents(empty, [1.0] * 3).count() == 0


def test_weights_share_the_keys(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    n = collections.Counter(r.shard for r in shard_documents(docs, [1.0, 3.0]).collect())
    assert 0.7 < n[1] / 4000 < 0.8
