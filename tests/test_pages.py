"""Forms of reply pages: heights and measures, rings, pages that cannot be read, CSV with quotes."""

import csv
import io
import json

import pytest
from pyspark.sql import functions as F

from geolayer.functions import geometry as g
from geolayer.operators import coordinates as co
from geolayer.sources import pages as pg


def square(a, b):
    return [[a, a], [b, a], [b, b], [a, b], [a, a]]


def read(spark, *pages):
    rows = spark.createDataFrame([(json.dumps(p),) for p in pages], "payload string")
    return {r.id: r.geom for r in pg.features_from_pages(rows, "id:bigint").collect()}


def test_heights_are_no_measures(spark):
    def page(first, path, **flags):
        return {**flags, "features": [
            {"attributes": {"id": first}, "geometry": {"paths": [path]}},
            {"attributes": {"id": first + 1}, "geometry": {"paths": [path], "hasM": False}}]}

    got = read(
        spark, page(10, [[0, 0, 7], [1, 1, 8]], hasZ=True), page(20, [[0, 0, 7], [1, 1, 8]], hasM=True),
        page(30, [[0, 0, 5, 7], [1, 1, 6, 8]], hasZ=True, hasM=True), page(40, [[0, 0, 5, 7], [1, 1, 6, 8]]),
        page(50, [[0, 0], [1, 1]], hasM=True),
        {"features": [{"attributes": {"id": 60}, "geometry": {"x": 1, "y": 2, "z": 3, "m": 4}},
                      {"properties": {"id": 61}, "geometry": {"type": "Point", "coordinates": [1, 2, 3]}}]})
    measures = {k: [v.m for part in shape.parts for v in part] for k, shape in got.items()}
    assert measures == {
        10: [None, None], 20: [7, 8], 30: [7, 8], 40: [7, 8], 50: [None, None], 60: [4], 61: [None],
        11: [None, None], 21: [None, None], 31: [None, None], 41: [None, None], 51: [None, None]}


def test_rings_there_and_back(spark):
    """A shell with a hole, an island in the hole and a second shell, holes listed first."""
    parts = [square(2, 8), square(0, 10), square(20, 30), square(4, 6)]
    got = read(spark, {"features": [
        {"attributes": {"id": 1}, "geometry": {"rings": parts}},
        {"attributes": {"id": 2}, "geometry": {"rings": parts[:2]}}]})
    assert got[1].kind == "multipolygon" and got[2].kind == "polygon"
    df = spark.createDataFrame(list(got.items()), f"id bigint, geom {g.GEOMETRY}")
    out = {r.id: json.loads(r.geometry)["rings"] for r in co.geometry_payloads(df).collect()}
    assert out[1] == [square(0, 10)[::-1], square(2, 8), square(20, 30)[::-1], square(4, 6)[::-1]]
    again = read(spark, *[{"features": [{"attributes": {"id": k}, "geometry": {"rings": v}}]}
                          for k, v in out.items()])
    back = spark.createDataFrame(list(again.items()), f"id bigint, geom {g.GEOMETRY}")
    text = {r.id: r.wkt for r in co.with_wkt(back, always_xy=True).collect()}

    def rings(*squares):
        return "(" + ", ".join("(" + ", ".join(
            f"{x:.1f} {y:.1f}" for x, y in r) + ")" for r in squares) + ")"

    assert text[1] == "MULTIPOLYGON (" + ", ".join([
        rings(square(0, 10)[::-1], square(2, 8)), rings(square(20, 30)[::-1]),
        rings(square(4, 6)[::-1])]) + ")"
    assert text[2] == "POLYGON " + rings(square(0, 10)[::-1], square(2, 8))


@pytest.mark.parametrize("parts, shape", [
    # A hole that touches its shell with every vertex, and two shells that touch in one.
    ([square(0, 10), [[0, 5], [5, 0], [10, 5], [5, 10], [0, 5]]], [2]),
    ([square(0, 10), square(10, 20)], [1, 1]),
    # Beside the shell but within its envelope.
    ([[[0, 0], [10, 0], [0, 10], [0, 0]], square(7, 9)], [1, 1]),
    # Four deep, from the inside out.
    ([square(3, 7), square(2, 8), square(1, 9), square(0, 10)], [2, 2]),
    ([square(0, 1)], [1]),
])
def test_nesting(spark, parts, shape):
    from geolayer.functions.rings import polygons

    df = spark.createDataFrame(
        [(g.as_geometry({"kind": "polygon", "parts": parts}),)], f"geom {g.GEOMETRY}")
    got = df.select(F.expr(polygons("geom.parts")).alias("p")).first().p
    assert sorted(map(len, got), reverse=True) == shape


def test_no_negative_zero(spark):
    df = spark.createDataFrame([(g.as_geometry([(-0.0, -1e-13), (-0.25, -10.0)]),)], f"geom {g.GEOMETRY}")
    assert co.with_wkt(df, always_xy=True).first().wkt == "MULTIPOINT ((0.0 0.0), (-0.25 -10.0))"


def test_page_report(spark):
    pages = [('{"features":[{"attributes":{"id":1}},{"attributes":{"id":2}}]}', 2, None),
             ('{"features":[{"attributes":{"id":1}},{"attri', 0, "not JSON"), (None, 0, "empty"),
             (" ", 0, "empty"), ('{"error":{"code":400}}', 0, "error reply"), ('{"error":null}', 0, "error reply"),
             ("[1]", 0, "no features"), ('{"features":"x"}', 0, "no features"), ('{"features":[]}', 0, "no rows")]
    rows = spark.createDataFrame([(i, p[0]) for i, p in enumerate(pages)], "k int, payload string")
    got = [(r.n_features, r.reason) for r in pg.page_report(rows).orderBy("k").collect()]
    assert got == [p[1:] for p in pages]
    assert pg.page_report(rows.limit(0)).count() == 0


def test_csv_by_header_and_quotes(spark):
    table = [["1", 'a "quoted", word', "line one\nline two", "2.5"], ["2", "", "\x1c\x1e\x1f1", "oops"],
             ["3", "plain", 'ends with "', ""], ["4", '","\r\n', "x", "-1e3"]]
    text = io.StringIO()
    csv.writer(text, quoting=csv.QUOTE_NONNUMERIC).writerows([["ID", "Name", "note", "v"], *table])
    moved = io.StringIO()
    csv.writer(moved, lineterminator="\n").writerows(
        [["v", "note", "extra", "id"], *[[r[3], r[2], "e", r[0] + "0"] for r in table]])
    rows = spark.createDataFrame([(1, text.getvalue()), (2, moved.getvalue()), (3, ""), (4, None),
                                  (5, "id,name\n"), (6, "﻿id,name\r7,b\r")], "page int, payload string")
    got = {r.id: tuple(r)[2:] for r in pg.rows_from_csv_pages(
        rows, "id int, name string, note string, v double").collect()}
    value = {"oops": None, "": None}
    for k, name, note, v in table:
        number = value[v] if v in value else float(v)
        assert got[int(k)] == (name, note, number)
        assert got[int(k) * 10] == (None, note, number)
    assert got[7] == ("b", None, None) and len(got) == 9


def test_csv_without_paired_quotes(spark):
    rows = spark.createDataFrame([('id,name\n1,5" pipe\n2,b\n',)], "payload string")
    got = sorted(tuple(r) for r in pg.rows_from_csv_pages(rows, "id int, name string").collect())
    assert got == [(1, '5" pipe'), (2, "b")]
