"""Cases in which rows were lost, merged or invented."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from geolayer.functions.geometry import on_grid
from geolayer.functions.urls import normalize_url
from geolayer.operators.requests import cache_lookup, error_report
from geolayer.operators.retrieve import failed_ids, split_responses
from geolayer.operators.select import where_in
from geolayer.plans import ordered
from geolayer.plans.ordered import with_row_number


def test_reply_cut_off_in_transit_failed(spark):
    rows = spark.createDataFrame(
        [(1, '{"features": []}'), (2, '{"features": [{"id"'), (3, None), (4, '{"error": null}')],
        "request_id long, payload string")
    got = {r.request_id: r.failed for r in split_responses(rows).collect()}
    assert got == {1: False, 2: True, 3: True, 4: True}


def test_text_ids_of_failed_requests(spark):
    split = spark.createDataFrame([(1, True)], "request_id long, failed boolean")
    requests = spark.createDataFrame([(1, "a-1,b-2")], "request_id long, object_ids string")
    assert {r.id for r in failed_ids(split, requests, "string").collect()} == {"a-1", "b-2"}


def test_parameters_do_not_run_together(spark):
    rows = spark.createDataFrame(
        [("http://h/p", {"b": "c&q=a"}), ("http://h/p", {"b": "c", "q": "a"})],
        "url string, params map<string,string>")
    got = [r.u for r in rows.select(normalize_url(F.col("url"), F.col("params")).alias("u")).collect()]
    assert got == ["http://h/p?b=c%26q%3Da", "http://h/p?b=c&q=a"]


def test_messages_without_white_space_around(spark):
    rows = spark.createDataFrame(
        [(1, "<e><m>\n  Bad id\n</m></e>"), (2, "\n <e><m>Bad id</m></e>"), (3, "Bad id\n")],
        "request_id long, reply string")
    got = error_report(rows).collect()
    assert [(r.message, r.n_replies) for r in got] == [("Bad id", 3)]


@pytest.mark.parametrize("disabled", [False, True])
def test_cache_without_keys_or_times(spark, disabled):
    at = dt.datetime(2024, 1, 1)
    requests = spark.createDataFrame(
        [(1, None, at), (2, "k", at), (3, "m", at)], "request_id long, key string, ts timestamp")
    cache = spark.createDataFrame(
        [(7, None, at), (8, "k", None), (9, "m", at)], "cache_id long, key string, ts timestamp")
    got = cache_lookup(requests, cache, ["key"], ttl=-1, disabled=disabled)
    assert got.columns == ["request_id", "key", "ts", "cache_id", "cache_ts", "status"]
    want = {1: "miss", 2: "miss", 3: "miss" if disabled else "hit"}
    assert {r.request_id: r.status for r in got.collect()} == want


def test_not_a_number_is_not_snapped(spark):
    row = spark.sql(f"SELECT {on_grid('double(\"NaN\")', 2)} AS a, {on_grid('1.005D', 1)} AS b").first()
    assert row.a != row.a and row.b == 1.0


@pytest.mark.parametrize("more", [0, 1500])
def test_ids_that_are_no_numbers_select_nothing(spark, more):
    df = spark.range(10)
    assert where_in(df, "id", ["1", "abc", *map(str, range(100, 100 + more))]).count() == 1


def test_parts_follow_the_bytes(spark, monkeypatch):
    monkeypatch.setattr(ordered, "PART_BYTES", 2000)
    df = spark.range(20_000).withColumn("k", F.md5(F.col("id").cast("string")))
    assert ordered.ordered_table(df, ["k"]).select("_part").distinct().count() > 50
    assert with_row_number(df, ["k"]).agg(F.countDistinct("rn")).first()[0] == 20_000
