import json

import pytest
from pyspark.sql import functions as F

from geolayer.errors import InputValueError, MissingInputError, ServiceError, ZeroMatchedError
from geolayer.functions import geometry as g
from geolayer.layer import LayerInfo, geometry_column, sort_column
from geolayer.operators import paging, retrieve
from geolayer.plans.ordered import with_row_number
from geolayer.sources import fetch, layers as src, pages as pg

INFO = LayerInfo("id")


def bad_every_97(request):
    ids = [int(i) for i in request["object_ids"].split(",")]
    if any(i % 97 == 13 for i in ids):
        return json.dumps({"error": {"message": "bad"}})
    return json.dumps({"features": [{"attributes": {"id": i}} for i in ids]})


def raising(request):
    if request["request_id"] % 2:
        raise ValueError("odd")
    return b"\x00\x01"


def test_retry_sizes():
    assert retrieve.retry_sizes(1000) == [500, 333, 167, 1]
    assert retrieve.retry_sizes(5) == [2, 2, 1, 1]
    assert retrieve.retry_sizes(1) == [1, 1, 1, 1]


def test_fetch_returns_each_good_id_once(spark):
    ids = spark.range(400).unionByName(spark.range(100))
    good, left = retrieve.fetch_features(ids, bad_every_97, 50)
    rows = [r.id for r in pg.features_from_pages(good, "id:bigint").select("id").collect()]
    bad = [i for i in range(400) if i % 97 == 13]
    assert sorted(rows) == [i for i in range(400) if i not in bad]
    assert sorted(r.id for r in left.collect()) == bad
    once, failed = retrieve.fetch_features(ids, bad_every_97, 50, retry=False)
    assert once.count() == 8 - len({i // 50 for i in bad})
    assert failed.count() == 50 * len({i // 50 for i in bad})


def leaves_out(request):
    """Six of thirty ids never come, one batch has no features; ids are text."""
    ids = [i for i in request["object_ids"].split(",") if int(i[1:]) % 5 != 4]
    if "s0" in ids and len(ids) > 1:
        return json.dumps({"message": "nothing here"})
    return json.dumps({"features": [{"attributes": {"id": i}} for i in ids]})


def test_ids_left_out_of_replies_are_missing(spark):
    ids = spark.range(30).select(F.concat(F.lit("s"), "id").alias("id"))
    good, left = retrieve.fetch_features(
        ids, leaves_out, 10, id_type="string", id_path=["features", "attributes", "id"])
    rows = [r.id for r in pg.features_from_pages(good, "id:string").select("id").collect()]
    assert sorted(r.id for r in left.collect()) == sorted(f"s{i}" for i in range(4, 30, 5))
    assert sorted(rows) == sorted(f"s{i}" for i in range(30) if i % 5 != 4)


def test_failures_are_rows(spark):
    got = fetch.fetch_pages(spark.range(6).withColumnRenamed("id", "request_id"), raising, 2, binary=True)
    rows = {r.request_id: r for r in got.collect()}
    assert len(rows) == 6 and bytes(rows[2].payload) == b"\x00\x01"
    assert rows[3].status == "failed" and rows[3].error == "ValueError: odd" and rows[3].payload is None


def test_null_error_is_a_failure(spark):
    rows = spark.createDataFrame(
        [(0, '{"error":null}'), (1, '{"features":[]}'), (2, None), (3, '{"error":{"message":"m"}}')],
        "request_id bigint, payload string")
    split = retrieve.split_responses(rows)
    assert [r.failed for r in split.orderBy("request_id").collect()] == [True, False, True, True]
    assert retrieve.first_error(split.where("request_id > 2")).first().message == "m"
    with pytest.raises(ServiceError, match="m"):
        retrieve.ok_responses(split.where("request_id = 3"), retry=False)


def test_partition_ids(spark):
    ids = spark.createDataFrame([(i % 23,) for i in range(100)], "id bigint")
    rows = paging.partition_ids(ids, "id", 5).orderBy("batch").collect()
    assert [len(r.ids) for r in rows] == [5, 5, 5, 5, 3]
    assert [i for r in rows for i in r.ids] == [str(i) for i in range(23)]
    assert paging.partition_ids(7).collect()[0].ids == ["7"]
    assert paging.partition_ids(ids.where("id < 0")).count() == 0
    with pytest.raises(ZeroMatchedError):
        paging.partition_ids(ids.where("id < 0"), require_match=True)


def test_row_numbers_with_a_hot_key(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 50).alias("k"), "id")
    got = with_row_number(rows, ["k", "id"], partitions=6)
    assert got.select("rn").distinct().count() == 3000
    listed = [(r.k, r.id) for r in got.orderBy("rn").collect()]
    assert listed == sorted(listed)
    spread = got.groupBy(F.spark_partition_id()).count().count()
    assert spread >= 1


def test_pages_cover_everything(spark):
    rows = spark.range(23).select((F.col("id") % 4).alias("group"), "id")
    info = LayerInfo("id", max_nrecords=5)
    pages = paging.all_pages(rows, info, "group")
    assert [r["count"] for r in pages.groupBy("page").count().orderBy("page").collect()] == [5, 5, 5, 5, 3]
    whole = [tuple(r) for r in rows.orderBy("group", "id").collect()]
    parts = [tuple(r) for start in range(0, 23, 5)
             for r in paging.read_page(rows, info, start, 5, "group").collect()]
    assert parts == whole


def test_deep_page_equals_top_page(spark, monkeypatch):
    rows = spark.range(500).select((F.col("id") % 7).alias("group"), "id")
    near = paging.read_page(rows, INFO, 100, 20, "group").collect()
    monkeypatch.setattr(paging, "MAX_TOP_ROWS", 0)
    deep = paging.read_page(rows, INFO, 100, 20, "group").orderBy("group", "id").collect()
    assert [tuple(r) for r in near] == [tuple(r) for r in deep]


def test_deep_page_is_in_order(spark, monkeypatch):
    rows = spark.range(5000).select((F.col("id") % 7).alias("group"), "id")
    near = paging.read_page(rows, INFO, 100, 4500, "group").collect()
    monkeypatch.setattr(paging, "MAX_TOP_ROWS", 0)
    assert paging.read_page(rows, INFO, 100, 4500, "group").collect() == near


def test_page_plan_asks_for_the_limit_on_the_last_page(spark):
    layers = spark.createDataFrame([("a", 12), ("b", 5), ("c", 0), ("d", 3)], "layer string, hits bigint")
    rows = paging.page_plan(layers, 5, "1.1.0").collect()
    got = {(r.layer, r.start_index): r.page_size for r in rows}
    assert got == {("a", 0): 5, ("a", 5): 5, ("a", 10): 5, ("b", 0): 5, ("d", 0): 3}
    assert rows[0].count_key == "maxFeatures"
    with pytest.raises(InputValueError):
        paging.page_plan(layers, 5, "1.0.0")


def test_sort_column(spark):
    rows = spark.createDataFrame([], "name string, StaID string, other_id int")
    assert sort_column(rows, None) == "StaID" and sort_column(rows, "name") == "name"
    with pytest.raises(MissingInputError):
        sort_column(spark.createDataFrame([], "name string"), None)
    with pytest.raises(MissingInputError):
        sort_column(None, None)
    with pytest.raises(InputValueError):
        sort_column(rows, "nope")
    with pytest.raises(MissingInputError):
        geometry_column(rows)
    assert geometry_column(spark.createDataFrame([], "a int, the_geom string")) == "the_geom"


def test_get_features_options(spark):
    rows = spark.createDataFrame(
        [(1, "a", g.as_geometry({"kind": "line", "parts": [[(0, 0, 1), (1, 1, 2)]]}))],
        f"id bigint, name string, geom {g.GEOMETRY}")
    plain = retrieve.get_features(rows, INFO, [1, 1, 9], ["name"]).collect()
    assert len(plain) == 1 and plain[0].geom.parts[0][0].m is None
    assert retrieve.get_features(rows, INFO, [1], return_m=True).first().geom.parts[0][1].m == 2.0
    assert retrieve.get_features(rows, INFO, 1, return_geom=False).columns == ["id", "name"]
    moved = retrieve.get_features(rows, INFO, 1, out_crs=3857).first().geom.parts[0][1]
    assert moved.x == pytest.approx(111319.4908, abs=1e-3)
    with pytest.raises(ZeroMatchedError):
        retrieve.get_features(rows, INFO, [5], require_match=True)
    with pytest.raises(InputValueError, match="name"):
        retrieve.get_features(rows, INFO, [1], ["nope"])


def test_pages_of_both_dialects(spark):
    esri = {"features": [
        {"attributes": {"id": 1}, "geometry": {"x": 1, "y": 2}},
        {"attributes": {"id": 2}, "geometry": {"points": [[1, 2], [3, 4]]}},
        {"attributes": {"id": 3}, "geometry": {"paths": [[[0, 0, 5], [1, 1, 6]]]}},
        {"attributes": {"id": 4}, "geometry": {"rings": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}}]}
    geo = {"features": [
        {"properties": {"id": 5}, "geometry": {"type": "Point", "coordinates": [1, 2]}},
        {"properties": {"id": 6}, "geometry": {"type": "MultiPolygon", "coordinates": [
            [[[0, 0], [1, 0], [1, 1], [0, 0]]], [[[5, 5], [6, 5], [6, 6], [5, 5]]]]}},
        {"properties": {"id": 7}, "geometry": None}]}
    rows = spark.createDataFrame(
        [(json.dumps(esri),), (json.dumps(geo),), ('{"error":{}}',), ("not json",)], "payload string")
    got = {r.id: r.geom for r in pg.features_from_pages(rows, "id:bigint").collect()}
    assert sorted(got) == [1, 2, 3, 4, 5, 6, 7] and got[7] is None
    assert got[1].kind == "point" and got[2].kind == "multipoint" and len(got[2].parts) == 2
    assert got[3].parts[0][1].m == 6.0 and got[4].kind == "polygon"
    assert got[6].kind == "multipolygon" and len(got[6].parts) == 2


def test_csv_pages(spark):
    rows = spark.createDataFrame([("staid,v\r\n010,1.5\r\n",), ("staid,v\n020,2\n\n",)], "payload string")
    got = sorted(tuple(r) for r in pg.rows_from_csv_pages(rows, "staid string, v double").collect())
    assert got == [("010", 1.5), ("020", 2.0)]
    raw = rows.select(F.col("payload").cast("binary").alias("payload"))
    assert pg.rows_from_csv_pages(raw, "staid string, v double").count() == 2


def test_write_replaces_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "layer")
    rows = spark.range(10).select("id", (F.col("id") % 2).alias("part"))
    src.write_layer(rows, path, "part")
    src.write_layer(rows.where("part = 1 AND id > 4"), path, "part")
    assert src.read_layer(spark, path).count() == 8


def test_extent_skips_nan(spark):
    rows = spark.createDataFrame(
        [(1, float("nan"), 1.0, 2.0, 3.0), (2, 0.0, 0.5, 4.0, 3.5)],
        "id int, xmin double, ymin double, xmax double, ymax double")
    assert tuple(src.layer_extent(rows, INFO).first()) == (0.0, 0.5, 4.0, 3.5)
    none = rows.where("id > 5")
    assert tuple(src.layer_extent(none, INFO).first()) == (None,) * 4
    assert tuple(src.layer_extent(none, INFO, (1, 2, 3, 4)).first()) == (1.0, 2.0, 3.0, 4.0)


def test_readers_prune_columns(spark, sf):
    got = src.read_layer(spark, f"{sf}/customer.parquet", outfields=["c_name"])
    assert "ReadSchema: struct<c_name:string>" in got._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(InputValueError):
        src.read_layer(spark, f"{sf}/customer.parquet", fmt="xls")
