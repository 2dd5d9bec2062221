"""Replies out of stored tables, retry rounds, and deep pages."""

import pytest
from pyspark.sql import functions as F

from geolayer.errors import InputTypeError
from geolayer.layer import LayerInfo
from geolayer.operators import paging, retrieve
from geolayer.plans.ordered import with_row_number
from geolayer.sources import fetch, pages as pg


def test_stored_pages(spark):
    wanted = spark.createDataFrame([(0, "a"), (1, "b"), (2, "a"), (3, None), (4, "c")], "request_id bigint, url string")
    stored = spark.createDataFrame([("a", "2"), ("a", "1"), ("c", None), (None, "x")], "url string, payload string")
    got = {r.request_id: (r.status, r.payload, r.error) for r in fetch.stored_pages(wanted, stored).collect()}
    assert got == {
        0: ("ok", "1", None), 2: ("ok", "1", None), 1: ("failed", None, "no reply stored for b"),
        3: ("failed", None, "no reply stored for null"), 4: ("failed", None, "no reply stored for c")}
    assert fetch.stored_pages(wanted, stored.limit(0)).where("status = 'ok'").count() == 0
    assert fetch.stored_pages(wanted.limit(0), stored).count() == 0


def test_stored_features_with_retry(spark):
    ids = spark.range(60).select(F.concat(F.lit("s"), "id").alias("id"))
    stored = ids.where("id NOT IN ('s7', 's8')").select(
        "id", F.to_json(F.struct(F.struct(F.col("id").alias("k")).alias("attributes"))).alias("feature"),
        F.when(F.col("id") == "s30", 'quote " in it').alias("error"))
    good, missing = retrieve.fetch_features(
        ids, max_nrecords=10, id_type="string", id_path=["features", "attributes", "k"],
        replies=fetch.stored_features(stored, error="error"))
    got = sorted(r.k for r in pg.features_from_pages(good, "k:string").select("k").collect())
    assert sorted(r.id for r in missing.collect()) == ["s30", "s7", "s8"]
    assert got == sorted({f"s{i}" for i in range(60)} - {"s30", "s7", "s8"})
    with pytest.raises(InputTypeError):
        retrieve.fetch_features(ids)


def test_retry_plan_by_one_order(spark):
    failed = spark.range(40).unionByName(spark.range(5))
    got = {(r.round, r.batch_size, r.batch): list(r.ids) for r in retrieve.retry_plan(failed, 20).collect()}
    want = {}
    for i, size in enumerate(retrieve.retry_sizes(20), 1):
        for b in range(0, 40, size):
            want[i, size, b // size] = [str(v) for v in range(b, min(b + size, 40))]
    assert got == want


def test_numbered_rows_from_the_parts_that_hold_them(spark, monkeypatch):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("id"), F.lit("x").alias("v"))
    for rows in ((1, 1), (1, 1000), (333, 420), (995, 2000), (1001, 1100)):
        got = sorted((r.id, r.rn) for r in with_row_number(df, ["id"], partitions=8, rows=rows).collect())
        assert got == [(i - 1, i) for i in range(rows[0], min(rows[1], 1000) + 1)]
    part = with_row_number(df, ["id"], partitions=8, rows=(333, 340))
    assert "GreaterThanOrEqual(_part" in part._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(paging, "MAX_TOP_ROWS", 10)
    page = paging.read_page(df, LayerInfo("id"), 500, 20)
    assert [r.id for r in page.collect()] == list(range(500, 520))
