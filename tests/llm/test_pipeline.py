"""The pipeline against its stages, and the queries with SQL against it."""

import duckdb
import pytest

import corpus_pipeline
from compare import cell
from geolayer.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_against_sql(spark, sf, name):
    db = duckdb.connect()
    for t in ("documents", "benchmark"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    df = queries.QUERIES[name](spark, sf)
    cur = db.execute(queries.ORACLES[name])
    at = [[d[0] for d in cur.description].index(c) for c in sorted(df.columns)]
    want = sorted(repr([cell(r[i]) for i in at]) for r in cur.fetchall())
    assert sorted(repr([cell(r[c]) for c in sorted(df.columns)]) for r in df.collect()) == want


def test_stages_take_effect(spark, sf):
    docs = queries.documents(spark, sf)
    names = docs.columns
    sizes = [docs.count()]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = corpus_pipeline.written(stage(spark, docs, sf), "t")
        sizes.append(docs.count())
        assert (docs.columns == names) == (k < len(corpus_pipeline.STAGES) - 1)
    assert sizes[0] > sizes[1] > sizes[2] >= sizes[3] and sizes[4] == sizes[5] > 0
    whole = corpus_pipeline.run(spark, sf)
    assert sorted(r.ids_sha256 for r in whole.collect()) == sorted(r.ids_sha256 for r in docs.collect())


def test_awkward_tables_go_through(spark, sf, tmp_path):
    """Null, empty and repeated rows, and no rows at all; further columns with clashing names."""
    shape = "doc_id long, text string, lang string, source string, n_chars long, score double, kept string"
    prose = "The house by the river was built of stone, and its garden holds old trees and a small well."
    rows = [(1, prose, "en", "a"), (1, prose, "en", "a"), (2, prose, "en", "b"), (3, None, None, None),
            (4, "", "en", "a"), (None, prose + " More of it.", "en", "a"), (5, "x" * 200_000, "en", "b"),
            (6, " ".join(f"word{i}" for i in range(30_000)), "en", "a")]
    for kept in (rows, []):
        docs = spark.createDataFrame([(*r, 0, 0.5, "k") for r in kept], shape)
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            docs = corpus_pipeline.written(stage(spark, docs, sf), "awkward")
            assert k == len(corpus_pipeline.STAGES) - 1 or docs.columns == [
                c.split()[0] for c in shape.split(", ")], name
        ids = [r.doc_id for r in docs.collect()]
        assert set(ids) <= {r[0] for r in kept}
