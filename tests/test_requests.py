import datetime as dt
import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from geolayer.errors import InputTypeError, InputValueError
from geolayer.functions.nested import traverse_json
from geolayer.operators import requests as req
from geolayer.sources import catalog


def walk(spark, doc, path):
    text = doc if isinstance(doc, str) else json.dumps(doc)
    df = spark.createDataFrame([(text,)], "j string")
    return df.select(traverse_json(F.col("j"), path).alias("v")).first().v


GAUGES = [
    {"readings": [{"stage": 2.5, "unit": "m"}, {"stage": 3, "unit": "m"}]},
    {"river": {"title": "Lower fork", "basin": "north"}},
]


def test_traverse_json(spark):
    assert walk(spark, GAUGES, ["readings", "stage"]) == [["2.5", "3"], [None]]
    assert walk(spark, {"a": {"b": 3}}, ["a", "b"]) == [["3"]]
    assert walk(spark, {"a": {"b": [1, 2]}}, ["a", "b"]) == [["[1,2]"]]
    assert walk(spark, {"a": []}, ["a", "b"]) == [[None]]
    assert walk(spark, {"a": 5}, ["a", "b"]) == [[None]]
    assert walk(spark, {"a": None}, ["a", "b"]) == [[None]]
    assert walk(spark, {"a": [[{"b": 1}], [{"b": 2}, {}]]}, ["a", "b"]) == [["1", "2", None]]
    assert walk(spark, "{broken", ["a"]) is None
    deep = {"b": 1}
    for _ in range(9):
        deep = [deep, [[]]]
    assert walk(spark, {"a": deep}, ["a", "b"]) == [["1", *[None] * 9]]


def test_request_key(spark):
    rows = spark.createDataFrame([
        (0, "get", "HTTP://Example.org:80/p?b=2&a=1#frag", {"c": "3"}, None),
        (1, "GET", "http://example.org/p?a=1&b=2&c=3", None, None),
        (2, "POST", "https://example.org", None, {"z": "1", "a": "2"})],
        "request_id bigint, method string, url string, params map<string,string>, data map<string,string>")
    got = {r.request_id: r for r in req.with_request_key(rows).collect()}
    assert got[0].norm_url == "http://example.org/p?a=1&b=2&c=3" and got[0].key == got[1].key
    assert got[2].key == hashlib.sha256(b"POSThttps://example.org/a=2&z=1").hexdigest()
    swapped = rows.withColumnRenamed("data", "json")
    assert {r.request_id: r.key for r in req.with_request_key(swapped).collect()}[2] == got[2].key


def test_output_names(spark):
    rows = spark.createDataFrame([(0, "http://a"), (1, "http://b")], "request_id bigint, url string")
    got = req.with_output_name(rows, "x_", "ti.ff").first().file_name
    assert got.startswith("x_") and got.endswith(".tiff") and len(got) == 2 + 64 + 5
    assert "." not in req.with_output_name(rows).first().file_name
    named = req.with_output_name(rows, names=["p", "q"]).orderBy("request_id").collect()
    assert [r.file_name for r in named] == ["p", "q"]
    with pytest.raises(InputTypeError):
        req.with_output_name(rows, names=["p"])


def test_dedupe_keeps_the_first(spark):
    rows = spark.createDataFrame(
        [(5, "http://a"), (3, "http://A"), (9, "http://b")], "request_id bigint, url string")
    got = sorted((r.request_id, r.n_requests) for r in req.dedupe_requests(rows).collect())
    assert got == [(3, 2), (9, 1)]


@pytest.mark.parametrize("partitions", [1, 7])
def test_cache_lookup_against_brute_force(spark, partitions):
    rng = random.Random(3)
    start = dt.datetime(2024, 1, 1)
    cache, asked = [], []
    for i in range(400):
        key = "hot" if rng.random() < 0.5 else f"k{rng.randrange(20)}"
        ts = start + dt.timedelta(minutes=rng.randrange(2000))
        (cache if rng.random() < 0.3 else asked).append((i, key, ts))
    got = req.cache_lookup(
        spark.createDataFrame(asked, "request_id bigint, key string, ts timestamp"),
        spark.createDataFrame(cache, "cache_id bigint, key string, ts timestamp"),
        ["key"], ttl=3600 * 3, partitions=partitions).collect()
    assert len(got) == len(asked)
    found = {r.request_id: (r.cache_id, r.status) for r in got}
    for i, key, ts in asked:
        older = [(t, c) for c, k, t in cache if k == key and t <= ts]
        if not older:
            want = (None, "miss")
        else:
            t, c = max(older)
            want = (c, "hit" if (ts - t).total_seconds() <= 3600 * 3 else "expired")
        assert found[i] == want


def test_cache_settings(spark, monkeypatch):
    rows = spark.createDataFrame([(1, "k", dt.datetime(2024, 1, 2))], "request_id bigint, key string, ts timestamp")
    cache = spark.createDataFrame([(7, "k", dt.datetime(2020, 1, 1))], "cache_id bigint, key string, ts timestamp")
    assert req.cache_lookup(rows, cache, ["key"]).first().status == "expired"
    assert req.cache_lookup(rows, cache, ["key"], ttl=-1).first().status == "hit"
    assert req.cache_lookup(rows, cache, ["key"], disabled=True).first().status == "miss"
    monkeypatch.setenv("GEOLAYER_CACHE_DISABLE", "true")
    assert req.cache_lookup(rows, cache, ["key"]).first().status == "miss"
    monkeypatch.setenv("GEOLAYER_CACHE_EXPIRE", "5")
    assert req.age_limit() == 5 and req.age_limit(9) == 9


def test_error_text(spark):
    replies = ["plain text", "<R><a>x</a><b><c> msg </c><d>n</d></b></R>", "<R><a/><b>msg</b></R>", "<R> msg </R>",
               "<a><b>", "<R><b><c>one<x/>two</c></b></R>"]
    rows = spark.createDataFrame(list(enumerate(replies)), "request_id bigint, reply string")
    got = [r.m for r in rows.select("request_id", req.error_text(F.col("reply")).alias("m")).orderBy("request_id").collect()]
    assert got == ["plain text", "msg", "msg", "msg", "<a><b>", "one"]


def test_parse_hits(spark):
    rows = spark.createDataFrame(
        [("a", '<x numberMatched="12" numberReturned="0"/>'), ("b", "<err/>"), ("c", 'numberMatched="unknown" ')],
        "layer string, reply string")
    got = {r.layer: (r.hits, r.error) for r in req.parse_hits(rows).collect()}
    assert got["a"] == (12, None) and got["b"] == (None, "<err/>") and got["c"][0] is None
    old = spark.createDataFrame([("a", '<x numberOfFeatures="3" y="1"/>')], "layer string, reply string")
    assert req.parse_hits(old, "1.1.0").first().hits == 3
    with pytest.raises(InputValueError):
        req.parse_hits(old, "1.0.0")


def test_layers_of_urls(spark):
    rows = spark.createDataFrame(
        [("http://h/MapServer/3/", None), ("http://h/MapServer", 2), ("http://h/MapServer", None),
         ("http://h/MapServer/3", 1)], "url string, layer int")
    got = [(r.service, r.layer_no, r.missing_layer) for r in req.with_layer(rows, layer="layer").collect()]
    assert got == [("http://h/MapServer", 3, False), ("http://h/MapServer", 2, False),
                   ("http://h/MapServer", None, True), ("http://h/MapServer/3", 1, False)]


def test_manifest_without_expected_size_is_always_rewritten(spark):
    wanted = spark.createDataFrame([("a", 5), ("b", None), ("c", 7), ("d", 1)], "name string, size bigint")
    held = spark.createDataFrame([("a", 5), ("b", 9), ("c", 6)], "name string, size bigint")
    got = {r.name: r.reason for r in req.manifest_todo(wanted, held).collect()}
    assert got == {"b": "size", "c": "size", "d": "absent"}


WMS = """<WMS_Capabilities xmlns="http://www.opengis.net/wms"><Capability><Request><GetMap><Format>image/PNG</Format>
</GetMap></Request><Layer><Title>t</Title><CRS>EPSG:4326</CRS><Layer><Name>a</Name><Title>A</Title><CRS>EPSG:3857</CRS>
</Layer><Layer><Name>b</Name><Title>B</Title></Layer></Layer></Capability></WMS_Capabilities>"""
WFS = """<WFS_Capabilities><OperationsMetadata><Operation name="GetFeature"><Parameter name="outputFormat"><AllowedValues>
<Value>JSON</Value><Value>text/XML</Value></AllowedValues></Parameter></Operation></OperationsMetadata><FeatureTypeList>
<FeatureType><Name>g</Name><Title>G</Title><DefaultCRS>urn:ogc:def:crs:EPSG::4269</DefaultCRS></FeatureType>
</FeatureTypeList></WFS_Capabilities>"""


def test_catalogs(spark):
    docs = spark.createDataFrame([(1, WMS), (2, "no xml")], "doc int, xml string")
    rows = sorted(catalog.catalog_from_xml(docs).collect(), key=lambda r: (r.doc, r.layer or ""))
    assert [(r.layer, r.crs, r.formats) for r in rows[:2]] == [
        ("a", ["epsg:3857", "epsg:4326"], ["image/png"]), ("b", ["epsg:4326"], ["image/png"])]
    assert len(rows) == 3 and rows[2].layer is None
    row = catalog.catalog_from_xml(spark.createDataFrame([(WFS,)], "xml string"), "wfs").first()
    assert (row.layer, row.crs, row.formats) == ("g", ["epsg:4269"], ["json", "text/xml"])
    asked = spark.createDataFrame(
        [("a", "image/PNG", "EPSG:3857"), ("b", "image/png", "epsg:3857"), ("a", "gif", "epsg:3857"),
         ("z", "image/png", "epsg:4326")], "layer string, outformat string, crs string")
    got = [r.reason for r in catalog.check_options(asked, catalog.catalog_from_xml(docs)).collect()]
    assert sorted(map(str, got)) == ["None", "crs", "layer", "outformat"]


def test_nested_catalogs(spark):
    deep = "<Layer><Name>d5</Name><CRS>EPSG:5</CRS></Layer>"
    for k in (4, 3):
        deep = f"<Layer><Title>t{k}</Title><!-- </Layer> --><CRS>EPSG:{k}</CRS>{deep}<Layer/></Layer>"
    docs = spark.createDataFrame([
        (1, "<W><Capability><Layer><Name>root &amp; all</Name><CRS>EPSG:1</CRS><Layer><Name>group</Name>"
            f"<CRS>EPSG:2</CRS>{deep}</Layer><Layer queryable='1'><Name>flat</Name></Layer></Layer>"
            "</Capability></W>"),
        (2, "<W><Capability><Layer><Name>one</Name></Layer><Layer><Name>two</Name></Layer></Capability></W>"),
        (3, "<W><Capability/></W>"), (4, "down <Layer>")], "doc int, xml string")
    got = {(r.doc, r.layer): r.crs for r in catalog.catalog_from_xml(docs).collect()}
    assert got == {
        (1, "root & all"): ["epsg:1"], (1, "group"): ["epsg:2", "epsg:1"], (1, "flat"): ["epsg:1"],
        (1, "d5"): ["epsg:5", "epsg:4", "epsg:3", "epsg:2", "epsg:1"],
        (2, "one"): [], (2, "two"): [], (3, None): None, (4, None): None}


def test_long_and_deep_json(spark):
    import time
    rows = ",".join(f'{{"a": {{"b": "[x]\\\\ {i}"}}}}' for i in range(50_000))
    df = spark.createDataFrame([('{"rows": [' + rows + "]}",)], "j string")
    start = time.perf_counter()
    found = df.select(traverse_json(F.col("j"), ["rows", "a", "b"]).alias("v")).first().v
    # A walk whose work grows with the square of the items takes hours.
    assert time.perf_counter() - start < 60
    assert len(found[0]) == 50_000 and found[0][7] == "[x]\\ 7"
    deep = json.loads("[" * 12 + '{"b": 1}, {"b": 2}' + "]" * 12)
    assert walk(spark, {"a": deep}, ["a", "b"]) == [["1", "2"]]
