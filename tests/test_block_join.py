"""Long query tables: pairs found block by block are those of the row-wise test."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from geolayer.functions import geometry as g
from geolayer.functions import pair_tests
from geolayer.layer import LayerInfo
from geolayer.operators import select as sel
from geolayer.plans import block_join, spatial_join

AREAS = LayerInfo("id", kind="polygon")
MIXED = LayerInfo("id")


def _ring(x, y, *steps):
    at = [(x / 8 + dx / 8, y / 8 + dy / 8) for dx, dy in steps]
    return [[*at, at[0]]]


def _shapes():
    """Shapes on a grid of eighths, so that many share corners, stretches of edges, or all of them."""
    out = []
    for i in range(60):
        x, y = (i * 7) % 13, (i * 5) % 11
        out += [
            ("polygon", _ring(x, y, (0, 0), (4, 0), (4, 4), (0, 4))),
            ("polygon", _ring(x, y, (0, 0), (6, 0), (6, 6), (3, 2 + i % 3), (0, 6))),
            ("polygon", _ring(x, y, (0, 0), (8, 0), (8, 8), (0, 8)) + _ring(x, y, (2, 2), (6, 2), (6, 6), (2, 6))),
            ("line", [[(x / 8, y / 8), (x / 8 + 0.5, y / 8 + 0.25 * (i % 3)), (x / 8 + 1, y / 8)]]),
            ("multiline", [[(x / 8, y / 8), (x / 8 + 0.5, y / 8)], [(x / 8, y / 8 + 0.3), (x / 8 + 0.7, y / 8 - 0.1)]]),
            ("point", [[(x / 8 + i % 2 / 16, y / 8)]]),
            ("multipoint", [[(x / 8, y / 8)], [(x / 8 + 1, y / 8 + 0.03)]]),
        ]
    # Two shells with an edge in common: no boundary goes there by the even-odd rule, yet positions on it count as edge.
    out.append(("multipolygon", _ring(0, 0, (0, 0), (4, 0), (4, 4), (0, 4)) + _ring(0, 0, (4, 0), (8, 0), (8, 4), (4, 4))))
    return [(i, (kind, [[(float(a), float(b), None) for a, b in part] for part in parts]))
            for i, (kind, parts) in enumerate(out)]


@pytest.fixture(scope="module")
def shapes(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("shapes") / "t")
    spark.createDataFrame(_shapes(), f"id bigint, geom {g.GEOMETRY}").write.parquet(path)
    return spark.read.parquet(path)


def _both(monkeypatch, find):
    """Rows of the row-wise test and of the blocks."""
    monkeypatch.setattr(sel, "MAX_ROWWISE_QUERIES", 10 ** 9)
    want = sorted(map(tuple, find().collect()))
    monkeypatch.setattr(sel, "MAX_ROWWISE_QUERIES", 0)
    df = find()
    assert "FlatMapGroupsInArrow" in df._jdf.queryExecution().toString()
    return want, sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("name", ["Intersects", "Contains", "Within", "Crosses", "Overlaps", "Touches", "Relation"])
def test_blocks_find_the_pairs_of_the_row_wise_test(shapes, monkeypatch, name):
    queries = shapes.where("id % 2 = 0").select(F.col("id").alias("query_id"), "geom")
    want, got = _both(monkeypatch, lambda: sel.ids_by_geom(
        shapes, MIXED, queries, relation="esriSpatialRel" + name,
        pattern="0FFFFF212" if name == "Relation" else None))
    assert got == want and (want or name == "Relation")


def test_equal_shapes_and_carried_fields_in_blocks(shapes, monkeypatch):
    layer = shapes.withColumn("kind", F.col("geom.kind"))
    queries = shapes.select(F.col("id").alias("query_id"), "geom")
    want, got = _both(monkeypatch, lambda: sel.features_by_geom(
        layer, MIXED, queries, predicate="EQUALS", outfields=["kind"]))
    assert got == want and len(want) > 400


def test_small_blocks_lose_and_repeat_no_pair(shapes, monkeypatch):
    monkeypatch.setattr(block_join, "BLOCK_VERTICES", 40)
    monkeypatch.setattr(spatial_join, "BLOCK_ROWS", 9)
    queries = shapes.select(F.col("id").alias("query_id"), "geom")
    want, got = _both(monkeypatch, lambda: sel.ids_by_geom(shapes, MIXED, queries))
    assert got == want


def test_distances_of_points_in_blocks(spark, monkeypatch):
    spots = spark.range(400).select(
        "id", (F.col("id") * 37 % 101 / 10 + 175).alias("x"), (F.col("id") * 53 % 97 / 10).alias("y")).select(
        "id", g.point(F.when(F.col("x") > 180, F.col("x") - 360).otherwise(F.col("x")), F.col("y")).alias("geom"))
    info = LayerInfo("id", kind="point")
    queries = spots.select(F.col("id").alias("query_id"), "geom")
    want, got = _both(monkeypatch, lambda: sel.within_distance(spots, info, queries, 60_000))
    assert got == want and len(want) > 800


@pytest.mark.parametrize("name", ["Intersects", "Contains", "Touches"])
@pytest.mark.parametrize("kinds", [("point",), ("line", "multiline"), ("polygon", "multipolygon")])
def test_queries_tested_one_by_one_find_the_same(shapes, monkeypatch, name, kinds):
    monkeypatch.setattr(block_join, "CROWD", -1)
    layer = shapes.where(F.col("geom.kind").isin(*kinds))
    queries = shapes.select(F.col("id").alias("query_id"), "geom")
    want, got = _both(monkeypatch, lambda: sel.ids_by_geom(layer, MIXED, queries, relation="esriSpatialRel" + name))
    assert got == want and want


def _lines(n, long):
    """Lines on a grid, so that many touch, overlap or repeat; some with ``long`` edges, and one without any."""
    rng = np.random.default_rng(5)
    out = [(0, ("line", [[(1.0, 1.0, None), (1.0, 1.0, None)]]))]
    for i in range(1, n):
        k = long if i % 17 == 0 else 1 + i % 4
        at = np.cumsum(np.vstack([rng.integers(0, 24, 2), rng.integers(-3, 4, (k, 2))]), axis=0) / 8 + 0.1
        out.append((i, ("line", [[(float(x), float(y), None) for x, y in at]])))
    return out


@pytest.mark.parametrize("long", [5, 40])
def test_lines_crossed_one_by_one_are_those_of_the_row_wise_test(spark, monkeypatch, long):
    lines = spark.createDataFrame(_lines(300, long), f"id bigint, geom {g.GEOMETRY}")
    queries = lines.select(F.col("id").alias("query_id"), "geom")
    monkeypatch.setattr(block_join, "CROWD", -1)
    monkeypatch.setattr(block_join, "STEP", 100)
    info = LayerInfo("id", kind="line")
    want, got = _both(monkeypatch, lambda: sel.ids_by_geom(
        lines.repartition(1), info, queries.repartition(1), relation="esriSpatialRelCrosses"))
    assert got == want and len(want) > 1000


def _tracks(rng, n, k):
    """Lines of ``k`` edges off any grid, as the blocks have them."""
    at = np.cumsum(np.concatenate([rng.uniform(0, 2, (n, 1, 2)), rng.uniform(-.5, .5, (n, k, 2))], axis=1), axis=1) - 100
    both = pa.array([[{"x": float(x), "y": float(y)} for x, y in line] for line in at])
    ends = pa.array([[{"x": float(x), "y": float(y)} for x, y in line[[0, -1]]] for line in at])
    segs = pa.array([[dict(x1=float(a), y1=float(b), x2=float(c), y2=float(d)) for (a, b), (c, d) in zip(line, line[1:])]
                     for line in at])
    return pair_tests.Shapes(pa.StructArray.from_arrays(
        [pa.array([1] * n), both, segs, ends], names=["dim", "verts", "segs", "ends"]))


def test_a_crowd_of_lines_is_crossed_without_the_pairs_of_edges(monkeypatch):
    rng = np.random.default_rng(2)
    a, b = _tracks(rng, 500, 3), _tracks(rng, 20, 4)
    at = np.arange(500)
    want = np.stack([pair_tests.judge("crosses", a, at, b, np.full(500, q), 1e-9) for q in range(20)])
    monkeypatch.setattr(pair_tests, "_meetings", None)
    got = np.stack([pair_tests.judge_one("crosses", a, at, b, q, 1e-9) for q in range(20)])
    sure = got != pair_tests.LATER
    assert (got[sure] == want[sure]).all() and sure.mean() > 0.99 and 500 < want.sum() < 9000
    # A step to the side of each edge's line is told, one within reach of the exact test is left to it.
    for step, says in ((1e-3, {pair_tests.YES, pair_tests.NO}), (1e-8, {pair_tests.LATER})):
        t = _tracks(np.random.default_rng(1), 1, 1)
        one = object.__new__(pair_tests.Shapes)
        vars(one).update(vars(t))
        one.x1, one.y1 = t.x1 + (t.x2 - t.x1) / 3 - step * (t.y2 - t.y1), t.y1 + (t.y2 - t.y1) / 3 + step * (t.x2 - t.x1)
        one.x2, one.y2 = t.x2 + 1, t.y2 - 2
        assert set(pair_tests.judge_one("crosses", t, np.arange(1), one, 0, 1e-9)) <= says


def test_results_leave_a_block_as_lists(shapes):
    """One row for a query and not one for each of its pairs."""
    left = sel._prepared(shapes, "id", "geom")
    right = sel._prepared(shapes.select(F.col("id").alias("query_id"), "geom"), "query_id", "geom")
    seen = block_join.block_pairs(
        left, right, 0.5, _all_hold, _all_hold, "false").where("l_id >= 0")._jdf.queryExecution().toString()
    assert "explode(l_id" in seen


def _all_hold(a, ai, b, bi):
    return np.ones(len(ai), np.int8)


def test_chords_tell_distances_as_the_ellipsoid_does():
    rng = np.random.default_rng(3)
    for metres in (5, 30_000, 900_000):
        n, reach = 3000, metres / 111_000 * 1.2
        lat = rng.uniform(-89, 89, n)
        lon = rng.uniform(-180, 180, n)
        lon2 = lon + rng.uniform(-reach, reach, n) / np.cos(np.radians(lat))
        lat2 = np.clip(lat + rng.uniform(-reach, reach, n), -90, 90)
        one, two = (_spots_of(x, y) for x, y in ((lon, lat), (lon2, lat2)))
        at = np.arange(n)
        says = pair_tests.near_spots(one, at, two, at, metres)
        exact = pair_tests._geodesic(*map(np.radians, (lon, lat, lon2, lat2)))
        known = ~np.isnan(exact) & (says != pair_tests.UNSURE)
        assert known.sum() > n * 0.9 and (says[known] == (exact[known] <= metres)).all()
        assert says.any() and not says.all()


def _spots_of(x, y):
    shapes = object.__new__(pair_tests.Shapes)
    shapes.vx, shapes.vy, shapes.vert_at, shapes.spot = x, y, np.arange(len(x)), np.ones(len(x), bool)
    return shapes
