"""The text operators as queries on whole tables, with the DuckDB SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geolayer.llm.bpe import encode_documents
from geolayer.llm.common import documents, remainder, text_of
from geolayer.llm.exact_dedup import exact_dedup, normalised
from geolayer.llm.fill_in_middle import fill_in_middle, restored
from geolayer.llm.importance import resample
from geolayer.llm.license_rules import RULES
from geolayer.llm.license_scan import license_scan
from geolayer.llm.lm_scoring import lm_scores
from geolayer.llm.mixing import mix_copies, times, with_plan
from geolayer.llm.near_dedup import near_duplicates
from geolayer.llm.quality_classifier import fit, labelled, scored
from geolayer.llm.quality_rules import quality_rules
from geolayer.llm.sharding import shard_documents
from geolayer.llm.substring_dedup import repeated_spans
from geolayer.llm.token_counts import token_counts

Query = Callable[[SparkSession, str], DataFrame]
SHARDS = 40


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word-piece counts of every document."""
    return token_counts(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated passages to remove, and where each was kept."""
    return repeated_spans(documents(spark, sf_dir))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    sized, plan = mix_copies(documents(spark, sf_dir))
    return with_plan(sized, "source", plan.select(
        "source", "source_size", "target", "epochs", "cut")).select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * times(F.col("hash"))).cast("long").alias("taken"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded texts."""
    return encode_documents(
        documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"),
        columns=["doc_id"], with_ids=False)


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near duplicates."""
    return near_duplicates(documents(spark, sf_dir))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model and base scores."""
    return lm_scores(documents(spark, sf_dir))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdicts of the quality rules."""
    return quality_rules(documents(spark, sf_dir))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores, learnt outside the held-out fold."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = fit(labelled(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return scored(
        docs.withColumn("held_out", remainder("doc_id", 5) == 0), model,
        columns=["doc_id", "held_out"])


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row that stays for every document."""
    docs = documents(spark, sf_dir).select("doc_id", "text").withColumn(
        "text_sha256", F.sha2(normalised(text_of()).cast("binary"), 256))
    return exact_dedup(docs, columns=["doc_id", "text_sha256"])


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document, over 40 equal shards."""
    return shard_documents(documents(spark, sf_dir), [1.0] * SHARDS)


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forms, lengths and digests of the fill-in-middle outputs and of the texts rebuilt from them."""
    columns = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256"]
    outputs = fill_in_middle(documents(spark, sf_dir)).withColumn(
        "output_sha256", F.sha2(F.col("output").cast("binary"), 256))
    return restored(outputs, columns).select(
        *columns, F.sha2(F.col("restored").cast("binary"), 256).alias("restored_sha256"))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights, scores and ranks of the documents drawn towards the benchmark texts."""
    return resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and labels of every document."""
    return license_scan(documents(spark, sf_dir))


QUERIES: dict[str, Query] = {
    f.__name__: f for f in (
        op1_token_counts, op2_substring_dedup, op3_mixing, op4_bpe, op5_near_dedup,
        op6_lm_scoring, op7_quality_rules, op8_quality_classifier, op9_exact_dedup, op10_sharding,
        op11_fill_in_middle, op12_resampling, op13_license_scan)}

_MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'text:' || md5(coalesce(text, '')))), 1, 15))
      ::BIGINT AS h
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w
  FROM d GROUP BY source),
c AS (
  SELECT *, 2 * source_size AS most, 2.0::DOUBLE * source_size / w AS r,
    sum(2 * source_size) OVER o AS most_to, sum(w) OVER o AS w_to,
    sum(source_size) OVER () AS total, sum(w) OVER () AS w_all
  FROM s WINDOW o AS (ORDER BY 2.0::DOUBLE * source_size / w, source ROWS UNBOUNDED PRECEDING)),
l AS (
  SELECT r, (total::DOUBLE * 150 / 100 - (most_to - most)::DOUBLE) / (w_all - (w_to - w))::DOUBLE
    AS level FROM c),
t AS (
  SELECT source, source_size,
    least(most::DOUBLE, w * (SELECT min_by(level, r) FROM l WHERE level <= r)) AS target FROM c),
e AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs
  FROM t),
g AS (SELECT source, h, sum(size)::BIGINT AS size FROM d GROUP BY source, h),
k AS (
  SELECT source, h, size,
    (sum(size) OVER (PARTITION BY source ORDER BY h ROWS UNBOUNDED PRECEDING))::BIGINT AS upto
  FROM g)
SELECT d.doc_id, d.size, e.source_size, e.target,
  d.size * (e.epochs + CASE
    WHEN k.upto <= e.target - e.epochs * e.source_size THEN 1
    WHEN k.upto - k.size < e.target - e.epochs * e.source_size
      AND k.upto - (e.target - e.epochs * e.source_size)
        < e.target - e.epochs * e.source_size - (k.upto - k.size) THEN 1
    ELSE 0 END)::BIGINT AS taken
FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source
JOIN k ON k.source IS NOT DISTINCT FROM d.source AND k.h = d.h
"""

_NEAR_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
sh AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(ws) < 2 THEN ws
      ELSE list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) END) AS s
    FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
e AS (
  SELECT x, y FROM p JOIN n n1 ON n1.doc_id = x JOIN n n2 ON n2.doc_id = y
  WHERE 100 * c >= 80 * (n1.n + n2.n - c)),
b AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
r AS (
  SELECT doc_id, doc_id AS c FROM documents
  UNION SELECT r.doc_id, b.y FROM r JOIN b ON r.c = b.x),
m AS (SELECT doc_id, min(c) AS component_id FROM r GROUP BY doc_id)
SELECT m.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, m.doc_id = component_id AS kept
FROM m LEFT JOIN n ON n.doc_id = m.doc_id
"""

_EXACT_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
    regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS n FROM documents)
SELECT doc_id, sha256(n) AS text_sha256, first_value(doc_id) OVER o AS keep_id,
  count(*) OVER (PARTITION BY n) AS group_size, row_number() OVER o = 1 AS kept
FROM d WINDOW o AS (PARTITION BY n ORDER BY length(t) DESC, doc_id)
"""

_SHARD_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, coalesce(doc_id::VARCHAR, '') AS k FROM documents),
tab AS (
  SELECT list(list_reduce([i] || range(8),
    lambda c, s: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS tab
  FROM range(256) r(i)),
c AS (
  SELECT *, octet_length(encode(t)) + 16 AS size,
    xor(list_reduce([4294967295::BIGINT] || list_transform(regexp_extract_all(hex(encode(t)), '..'),
      lambda b: ('0x' || b)::BIGINT),
      lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1])), 4294967295) AS crc,
    list_transform(range(0, 41), lambda i: -ln((('0x' || substr(md5(k || ':' || i), 1, 13))::BIGINT
      + 0.5::DOUBLE) / 4503599627370496::DOUBLE)) AS races
  FROM d, tab),
w AS (SELECT *, list_min(races[1:40]) AS best, list_position(races, list_min(races[1:40])) - 1 AS shard FROM c)
SELECT doc_id, size::BIGINT AS size, crc::BIGINT AS text_crc32, 'key' AS law, shard::INT AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY md5(k), doc_id) - 1 AS slot,
  CASE WHEN races[41] < best THEN 40 ELSE shard END::INT AS grown_shard
FROM w
"""

_MIDDLE_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents),
l AS (
  SELECT *, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS u, ('0x' || substr(h, 1, 8))::BIGINT AS h1,
    ('0x' || substr(h, 9, 8))::BIGINT AS h2, ('0x' || substr(h, 17, 8))::BIGINT AS h3,
    ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM d),
c AS (
  SELECT *, least(h1 % (len(u) + 1), h2 % (len(u) + 1))::INT AS a,
    greatest(h1 % (len(u) + 1), h2 % (len(u) + 1))::INT AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
      OR h3 % 100 >= 100 THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM l),
p AS (
  SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle,
    array_to_string(u[b + 1:], '') AS suffix FROM c)
SELECT doc_id, len(u)::BIGINT AS n, form,
  CASE WHEN form <> 'plain' THEN length(prefix)::BIGINT END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle)::BIGINT END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p
"""

# The checksum is worked out byte by byte, for each distinct word once.
_RESAMPLING_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws, row_number() OVER () AS k
  FROM documents),
f AS (SELECT k, unnest(ws) AS w FROM w),
g AS (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
tab AS (
  SELECT list(list_reduce([i] || range(8),
    lambda c, s: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS tab
  FROM range(256) r(i)),
v AS (
  SELECT w, list_transform(range(0, octet_length(encode(w))),
    lambda i: ('0x' || substr(hex(encode(w)), 2 * i::INT + 1, 2))::BIGINT) AS bytes
  FROM (SELECT w FROM f UNION SELECT w FROM g)),
h AS (
  SELECT w, xor(list_reduce([4294967295::BIGINT] || bytes,
    lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS bucket FROM v, tab),
s AS (SELECT bucket, count(*) AS s FROM f JOIN h USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM g JOIN h USING (w) GROUP BY bucket),
gain AS (
  SELECT bucket, floor(1000 * ln(((coalesce(t, 0) + 1) * ((SELECT count(*) FROM f) + 10000))::DOUBLE
    / ((coalesce(s, 0) + 1) * ((SELECT count(*) FROM g) + 10000))::DOUBLE))::BIGINT AS gain
  FROM s FULL JOIN t USING (bucket)),
m AS (SELECT k, sum(gain)::BIGINT AS weight FROM f JOIN h USING (w) JOIN gain USING (bucket) GROUP BY k),
c AS (
  SELECT doc_id, len(ws)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT
      + 0.5::DOUBLE) / 4294967296::DOUBLE))))::BIGINT AS score
  FROM w LEFT JOIN m USING (k)),
r AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS rank,
    floor(10 * count(*) OVER (PARTITION BY n_features >= 20) / 100) AS drawn FROM c)
SELECT doc_id, n_features, weight, score,
  CASE WHEN n_features >= 20 AND rank <= drawn THEN rank END AS rank FROM r
"""


def _license_sql() -> str:
    """Rules as a list of values. Words stand apart by two blanks, so that matches side by side, each
    with a blank at both ends, share none."""
    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    values = ",\n  ".join(
        f"({r.rank}, {quoted(r.label)}, {r.confidence}::DOUBLE, "
        f"{quoted(' (' + r.pattern.replace(' ', '  ') + ') ')})"
        for r in RULES)
    return r"""
WITH rules(rank, label, confidence, pattern) AS (VALUES
  """ + values + r"""),
d AS (
  SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (
  SELECT k, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, list_sort(list(DISTINCT label)) AS base
  FROM (
    SELECT k, i, CASE
      WHEN ws[i + 1] = 'mit' AND ws[i + 2] = 'license' THEN 'mit'
      WHEN ws[i + 1] = 'apache' AND ws[i + 2] = 'license' THEN 'apache'
      WHEN ws[i + 1] = 'general' AND ws[i + 2] = 'public' AND ws[i + 3] = 'license' THEN 'gpl' END AS label
    FROM (SELECT k, ws, unnest(range(0, len(ws))) AS i FROM d))
  WHERE label IS NOT NULL GROUP BY k),
n AS (
  SELECT k, ' ' || array_to_string(ws, '  ') || ' ' AS t FROM d
  WHERE len(list_filter(ws, lambda w: regexp_matches(
    w, 'licen|spdx|gpl|gfdl|wtfpl|cc|odbl|eupl|cddl|sspl|apache|creative|hereby|redistribution|domain|reserved'))) > 0),
m AS (
  SELECT k, rank, label, confidence, string_split(regexp_replace(t, pattern, ' <\1> ', 'g'), '  ') AS marked
  FROM n JOIN rules ON regexp_matches(t, pattern)),
e AS (
  SELECT k, rank, label, confidence,
    unnest(list_filter(range(len(marked)), lambda i: contains(marked[i + 1], '<'))) AS a,
    unnest(list_filter(range(len(marked)), lambda i: contains(marked[i + 1], '>'))) AS z FROM m),
x AS (
  SELECT k, count(*) AS detections, max(confidence) FILTER (kept) AS confidence,
    list(DISTINCT label) FILTER (kept) AS labels
  FROM (
    SELECT *, NOT EXISTS (
      SELECT 1 FROM e o WHERE o.k = e.k AND o.a <= e.a AND o.z >= e.z
        AND (o.a < e.a OR o.z > e.z OR o.rank < e.rank)) AS kept FROM e)
  GROUP BY k)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base,
  first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(array_to_string(base, ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(coalesce(base, []) || coalesce(labels, []))), ','), '') AS labels,
  greatest(coalesce(confidence, 0), CASE WHEN n_base > 0 THEN 0.5 ELSE 0 END)::DOUBLE AS score,
  coalesce(detections, 0)::BIGINT AS detections
FROM d LEFT JOIN b USING (k) LEFT JOIN x USING (k)
"""


#: The others have no SQL of their kind (automaton, merge queue, learnt models), or one that does
#: not end on whole tables; they are tested against brute force.
ORACLES: dict[str, str] = {
    "op3_mixing": _MIX_SQL, "op5_near_dedup": _NEAR_SQL, "op9_exact_dedup": _EXACT_SQL,
    "op10_sharding": _SHARD_SQL, "op11_fill_in_middle": _MIDDLE_SQL, "op12_resampling": _RESAMPLING_SQL,
    "op13_license_scan": _license_sql()}
