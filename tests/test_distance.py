"""Distances across 180 degrees, and the relations whose answer is nearly every pair."""

import pytest
from pyspark.sql import functions as F

from geolayer.functions import geometry as g
from geolayer.layer import LayerInfo
from geolayer.operators import select as sel

POINTS, LINES = LayerInfo("id", kind="point"), LayerInfo("id", kind="line")


def layer(spark, shapes):
    rows = [(i, g.as_geometry(s)) for i, s in enumerate(shapes)]
    return spark.createDataFrame(rows, f"id bigint, geom {g.GEOMETRY}")


def pairs(df):
    return sorted(map(tuple, df.select("query_id", "feature_id").collect()))


def test_points_across_180_degrees(spark):
    spots = layer(spark, [(179.9, 10.0), (-179.9, 10.0), (179.0, 10.0), (-179.95, -10.0), (0.0, 10.0)])
    queries = layer(spark, [(-179.95, 10.0), (179.95, 10.0)]).withColumnRenamed("id", "query_id")
    assert pairs(sel.within_distance(spots, POINTS, queries, 30_000)) == [(0, 0), (0, 1), (1, 0), (1, 1)]
    got = pairs(sel.features_by_geom(spots, POINTS, queries, predicate="BEYOND", metres=30_000))
    assert got == [(q, f) for q in (0, 1) for f in (2, 3, 4)]


def test_lines_and_areas_across_180_degrees(spark):
    lines = layer(spark, [
        {"kind": "line", "parts": [[(179.8, 0.0), (179.9, 1.0)]]},
        {"kind": "line", "parts": [[(-179.9, 0.0), (-179.8, 1.0)]]},
        {"kind": "line", "parts": [[(-179.0, 0.0), (179.0, 0.5)]]},
        {"kind": "line", "parts": [[(100.0, 0.0), (101.0, 0.5)]]}])
    area = (179.95, 0.0, 179.99, 1.0)
    got = pairs(sel.within_distance(lines, LINES, area, 15_000))
    assert got == [(0, 0), (0, 1)]
    # A line nearly round the globe is met by the query as it is given, and once.
    assert pairs(sel.within_distance(lines, LINES, area, 120_000)) == [(0, 0), (0, 1), (0, 2)]


@pytest.mark.parametrize("metres", [None, 300_000])
def test_complement_in_the_scan_finds_what_the_anti_join_finds(spark, monkeypatch, metres):
    made = [((i * 0.618034) % 1 * 20, (i * 0.7548777) % 1 * 20) for i in range(200)]
    spots = layer(spark, made).withColumn("name", F.concat(F.lit("n"), "id"))
    spots = spots.unionByName(spark.createDataFrame([(500, None, "x")], spots.schema))
    shapes = [(0, (1.0, 1.0, 9.0, 9.0)), (1, (5.0, 5.0)), (1, (12.0, 12.0, 19.0, 13.0)), (2, made[3])]
    queries = spark.createDataFrame(
        [(i, g.as_geometry(s)) for i, s in shapes] + [(9, None)], f"query_id bigint, geom {g.GEOMETRY}")
    asked = dict(predicate="BEYOND" if metres else "DISJOINT", metres=metres, outfields=["name"])
    scan = sel.features_by_geom(spots, POINTS, queries, **asked)
    assert scan.columns == ["query_id", "feature_id", "name"]
    monkeypatch.setattr(sel, "MAX_COMPLEMENT_VERTICES", 0)
    joined = sel.features_by_geom(spots, POINTS, queries, **asked)
    assert joined.columns == scan.columns
    got = sorted(map(tuple, scan.collect()))
    assert got == sorted(map(tuple, joined.collect())) and 100 < len(got) < 600
    assert not pairs(sel.features_by_geom(spots, POINTS, queries.limit(0), **asked))
    monkeypatch.undo()
    assert not pairs(sel.features_by_geom(spots, POINTS, queries.limit(0), **asked))


def test_complement_moves_no_feature(spark):
    plan = sel.features_by_geom(
        layer(spark, [(1.0, 1.0)]), POINTS, (0.0, 0.0, 2.0, 2.0),
        predicate="DISJOINT")._jdf.queryExecution().executedPlan().toString()
    main = plan.split("Subquery")[0]
    assert "Exchange" not in main and "Join" not in main
