import math

import pytest
from pyspark.sql import functions as F

from geolayer.errors import InputTypeError, InputValueError
from geolayer.functions import crs
from geolayer.functions import geometry as g
from geolayer.functions import projections as pj
from geolayer.functions.sql import num
from geolayer.operators import coordinates as co
from geolayer.operators import tiles as tl

URBAN = (-118.72, 34.118, -118.31, 34.518)


def boxes(spark, *rows):
    return spark.createDataFrame(
        [(i, *map(float, b)) for i, b in enumerate(rows)],
        "box_id bigint, west double, south double, east double, north double")


def test_mercator_to_degrees(spark):
    assert crs.match_crs((-7766049.665, 5691929.739), 3857, 4326) == [
        pytest.approx((-69.7636111130079, 45.44549114818127), abs=1e-12)]
    box = crs.match_crs((-7766049.665, 5691929.739, -7763049.665, 5696929.739), 3857, "epsg:4326")
    assert box == pytest.approx(
        (-69.7636111130079, 45.44549114818127, -69.73666165448431, 45.47699468552394), abs=1e-12)
    assert crs.match_crs([(-7766049.665, 5691929.739)], "EPSG:3857", 4326)[0][0] == pytest.approx(
        -69.7636111130079, abs=1e-12)


def test_far_from_the_central_meridian(spark):
    box = crs.match_crs(URBAN, 4326, 2149)
    assert box[0] == pytest.approx(-3_654_030, abs=10)
    spot = crs.match_crs(((URBAN[0] + URBAN[2]) / 2, (URBAN[1] + URBAN[3]) / 2), 4326, 2149)
    assert spot[0][0] == pytest.approx(-3_620_990, abs=10)


@pytest.mark.parametrize("code", [3857, 2149, 26918, 32618, 32718])
def test_there_and_back(spark, code):
    lat = -33.5 if code == 32718 else 41.25
    spots = [(-76.5, lat), (-75.0, lat / 2), (-73.1, lat + 5)]
    back = crs.match_crs(crs.match_crs(spots, 4326, code), code, 4326)
    for a, b in zip(spots, back):
        assert b == pytest.approx(a, abs=1e-9)


def test_known_utm_position(spark):
    assert crs.match_crs((9.0, 45.0), 4326, 32632)[0] == pytest.approx((500000.0, 4982950.4002), abs=1e-3)


def test_crs_names():
    assert crs.validate_crs("EPSG:4326") == crs.validate_crs(4326) == "epsg:4326"
    for bad in ("epsg:0", 102003, "nowhere", True, 26924):
        with pytest.raises(InputTypeError, match="crs"):
            crs.validate_crs(bad)


def metres(spark, *ends):
    text = crs.geodesic(*[num(v) for v in ends])
    return spark.range(1).selectExpr(f"{text} AS d").first().d


def test_geodesic_length(spark):
    assert metres(spark, 0, 0, 1, 0) == pytest.approx(111319.4908, abs=1e-3)
    assert metres(spark, 0, 0, 0, 1) == pytest.approx(110574.3886, abs=1e-3)
    assert metres(spark, 5, 5, 5, 5) == 0.0
    assert metres(spark, -118.72, 34.118, -118.31, 34.118) == pytest.approx(37827, abs=5)
    assert metres(spark, 0, 0, 179.7, 0.2) is None


def test_snap_drops_repeats_and_collapsed_parts(spark):
    shapes = [{"kind": "polygon", "parts": [[(0, 0), (1, 0), (1.0000001, 0), (1, 1)],
                                            [(5, 5), (5.0000001, 5), (5, 5.0000001)]]},
              {"kind": "line", "parts": [[(2, 2), (2.0000002, 2)]]}]
    df = spark.createDataFrame(
        [(i, g.as_geometry(s)) for i, s in enumerate(shapes)], f"id int, geom {g.GEOMETRY}")
    a, b = co.snap(df).orderBy("id").collect()
    assert a.collapsed == 1 and [len(p) for p in a.geom.parts] == [4]
    assert b.collapsed == 1 and b.geom.parts == []


def test_wkt_and_axis_order(spark):
    shapes = [(1.5, 2.0), [(0.0, 1.0), (2.0, 3.0)], {"kind": "line", "parts": [[(0, 0), (1, 2)]]},
              RING := {"kind": "polygon", "parts": [[(0, 0), (3, 0), (3, 3)], [(1, 1), (2, 1), (2, 2)]]}]
    df = spark.createDataFrame(
        [(i, g.as_geometry(s)) for i, s in enumerate(shapes)], f"id int, geom {g.GEOMETRY}")
    xy = [r.wkt for r in co.with_wkt(df, always_xy=True).orderBy("id").collect()]
    assert xy == ["POINT (1.5 2.0)", "MULTIPOINT ((0.0 1.0), (2.0 3.0))", "LINESTRING (0.0 0.0, 1.0 2.0)",
                  "POLYGON ((0.0 0.0, 3.0 0.0, 3.0 3.0, 0.0 0.0), (1.0 1.0, 2.0 1.0, 2.0 2.0, 1.0 1.0))"]
    assert co.with_wkt(df).orderBy("id").first().wkt == "POINT (2.0 1.5)"
    assert RING["kind"] == "polygon"
    assert co.yx_order(4326) and not co.yx_order(4326, tile_version="1.1.1")
    assert not co.yx_order(3857) and not co.yx_order(4326, always_xy=True)


def test_payload_types(spark):
    shapes = [(1.0, 2.0), [(0.0, 1.0), (2.0, 3.0)], {"kind": "line", "parts": [[(0, 0), (1, 2)]]},
              (0.0, 0.0, 1.0, 1.0)]
    df = spark.createDataFrame(
        [(i, g.as_geometry(s)) for i, s in enumerate(shapes)], f"id int, geom {g.GEOMETRY}")
    rows = co.geometry_payloads(df).orderBy("id").collect()
    assert [r.geometry_type for r in rows] == [
        "esriGeometryPoint", "esriGeometryMultipoint", "esriGeometryPolyline", "esriGeometryPolygon"]
    assert rows[0].geometry == '{"x":1.0,"y":2.0,"spatialReference":{"wkid":"4326"}}'
    assert rows[1].geometry.startswith('{"points":[[0.0,1.0],[2.0,3.0]]')


def test_decompose_known_box(spark):
    tiles = tl.decompose(boxes(spark, URBAN), 10.0).orderBy("tile_no").collect()
    assert len(tiles) == 4 and {(t.sub_width, t.sub_height) for t in tiles} == {(1892, 2219)}
    last = tiles[-1]
    assert (last.west, last.south, last.east, last.north) == pytest.approx(
        (-118.515, 34.318, -118.31, 34.518), abs=1e-9)
    nature = tl.decompose(boxes(spark, (-69.77, 45.07, -69.31, 45.45)), 20.0, max_px=3_000_000).collect()
    assert len(nature) == 2 and (nature[0].sub_width, nature[0].sub_height) == (906, 2112)


def test_tiles_cover_the_box_without_overlap(spark):
    rows = tl.decompose(boxes(spark, URBAN, (0, 0, 3, 1)), 50.0, max_px=40_000).collect()
    for box in {r.box_id for r in rows}:
        mine = [r for r in rows if r.box_id == box]
        nx, ny = max(r.ix for r in mine) + 1, max(r.iy for r in mine) + 1
        assert len(mine) == nx * ny
        at = {(r.ix, r.iy): r for r in mine}
        for (i, j), r in at.items():
            if i + 1 < nx:
                assert at[i + 1, j].west == pytest.approx(r.east, abs=1e-12)
            if j + 1 < ny:
                assert at[i, j + 1].south == pytest.approx(r.north, abs=1e-12)


def test_small_box_is_one_tile(spark):
    row = tl.decompose(boxes(spark, (0, 0, 0.01, 0.02)), 30.0).collect()
    assert len(row) == 1 and (row[0].west, row[0].north) == (0.0, 0.02)


def test_tile_request_parameters(spark):
    asked = tl.tile_requests(boxes(spark, URBAN), ["a", "b"], 10.0, extra={"width": "1", "styles": "s"})
    rows = asked.orderBy("layer", "tile_no").collect()
    assert [r.key for r in rows[:5]] == ["a_dd_0", "a_dd_1", "a_dd_2", "a_dd_3", "b_dd_0"]
    p = rows[3].params
    assert p["bbox"] == "34.318,-118.515,34.518,-118.31" and p["width"] == "1892"
    assert p["crs"] == "epsg:4326" and p["styles"] == "s" and p["layers"] == "a"
    old = tl.tile_requests(boxes(spark, URBAN), "a", 10.0, version="1.1.1").orderBy("tile_no").collect()
    assert old[3].params["bbox"] == "-118.515,34.318,-118.31,34.518" and "srs" in old[0].params
    metre = tl.tile_requests(boxes(spark, URBAN), "a", 10.0, epsg=3857).first()
    assert len(metre.params["bbox"].split(",")[0].split(".")[1]) <= 2
    assert "E" not in metre.params["bbox"]
    with pytest.raises(InputTypeError):
        tl.tile_requests(boxes(spark, URBAN), "a", 10.0, extra="x")
    with pytest.raises(InputValueError):
        tl.tile_requests(boxes(spark, URBAN), "a", 10.0, version="1.0")


def test_points_on_tile_edges_belong_to_one_tile(spark):
    from geolayer.layer import LayerInfo
    frame = boxes(spark, (0, 0, 1, 1))
    spots = [(0, 0.0, 0.0), (1, 1.0, 1.0), (2, 0.5, 0.5), (3, 1.0, 0.0), (4, 0.25, 0.75), (5, 1.5, 0.5)]
    df = spark.createDataFrame(spots, "id int, x double, y double").withColumn(
        "geom", g.point(F.col("x"), F.col("y")))
    got = tl.points_to_tiles(df, LayerInfo("id", kind="point"), frame, 1000.0, 4000)
    rows = {r.feature_id: r for r in got.collect()}
    assert sorted(rows) == [0, 1, 2, 3, 4]
    plan = tl.tile_plan(frame, 1000.0, max_px=4000).first()
    assert rows[0].tile_no == 0 and rows[0].px == 0 and rows[0].py == plan.sub_height - 1
    assert rows[1].tile_no == plan.nx * plan.ny - 1 and rows[1].py == 0
    assert all(0 <= r.px < plan.sub_width and 0 <= r.py < plan.sub_height for r in rows.values())
    assert math.isclose(sum(r.n for r in tl.rasterize(got).collect()), 5)


def test_box_report(spark):
    rows = spark.createDataFrame(
        [("1", "2", "3", "4"), ("a", "2", "3", "4"), (None, "2", "3", "4"), ("1", "5", "3", "4"),
         ("170", "2", "-170", "4"), ("NaN", "1", "2", "3")],
        "west string, south string, east string, north string")
    got = [r.reason for r in tl.box_report(rows).collect()]
    assert got[0] is None and got[1] == got[2] == got[5] == "not four numbers"
    assert got[3] == "south above north" and got[4].startswith("west beyond east")


# Worked examples published with the formulas (Clarke 1866 ellipsoid), in metres.
CLARKE = (6378206.4, 294.978698214)
EXAMPLES = [
    (pj.Projection("albers", CLARKE, -96.0, 23.0, (29.5, 45.5)), 1885472.7, 1535925.0),
    (pj.Projection("lambert", CLARKE, -96.0, 23.0, (33.0, 45.0)), 1894410.9, 1564649.5),
    (pj.Projection("mercator", CLARKE, -180.0), 11688673.7, 4139145.6),
]


@pytest.mark.parametrize("projection, x, y", EXAMPLES)
def test_published_examples(spark, projection, x, y):
    v = spark.range(1).select(F.expr(pj.forward(num(-75.0), num(35.0), projection)).alias("v")).first().v
    assert tuple(v) == pytest.approx((x, y), abs=0.1)


def test_equal_area_position(spark):
    # Published example of EPSG:3035.
    assert crs.match_crs((5.0, 50.0), 4326, 3035)[0] == pytest.approx((3962799.45, 2999718.85), abs=0.01)


@pytest.mark.parametrize("code, spots", [
    (5070, [(-120.0, 25.0), (-96.0, 23.0), (-66.5, 49.4)]), (3034, [(-10.0, 35.0), (10.0, 52.0), (31.5, 71.0)]),
    (3035, [(10.0, 52.0), (-10.0, 35.0), (31.5, 71.0)]), (3395, [(-179.5, -60.0), (0.0, 0.0), (100.0, 80.0)])])
def test_families_there_and_back(spark, code, spots):
    back = crs.match_crs(crs.match_crs(spots, 4326, code), code, 4326)
    for a, b in zip(spots, back):
        assert b == pytest.approx(a, abs=1e-9)


def test_codes_by_row(spark):
    names = ["EPSG:3857", "4326", "epsg:32733", "26918", "2149", "3035", "3395", "9999", "nowhere", None, "32661", "4269"]
    spot = {"EPSG:3857": (1e6, 5e6), "3395": (1e6, 5e6), "3035": (4e6, 3e6)}
    rows = [(i, n, g.as_geometry(spot.get(n, (1e0, 2e0) if n in ("4326", "4269") else (5e5, 4e6))))
            for i, n in enumerate(names)] + [(99, "4326", None)]
    df = spark.createDataFrame(rows, f"id int, code string, geom {g.GEOMETRY}")
    for target in (4326, 3857, 32618):
        got = {r.id: r for r in co.reproject(df, target, F.col("code"), valid="ok").collect()}
        for i, name, shape in rows[:-1]:
            known = name not in ("9999", "nowhere", None, "32661")
            assert got[i].ok is known and (got[i].geom is not None) is known
            if known:
                want = crs.match_crs(tuple(shape[1][0][0][:2]), name, target)[0]
                v = got[i].geom.parts[0][0]
                assert (v.x, v.y) == pytest.approx(want, abs=1e-6)
        assert got[99].ok is True and got[99].geom is None
    numbers = df.withColumn("code", F.lit(4326).cast("bigint"))
    assert co.reproject(numbers, 4269, F.col("code")).where("geom IS NOT NULL").count() == len(names)
