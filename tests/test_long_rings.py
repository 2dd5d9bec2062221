"""Points against areas with long rings."""

import math
import time
from urllib.parse import urlparse

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from geolayer.functions import geometry as g
from geolayer.layer import LayerInfo
from geolayer.operators import select as sel
from geolayer.plans import block_join, long_rings
from geolayer.session import written
from workloads import selection

POINTS = LayerInfo("id", kind="point")


def star(n, x, y, near, far):
    """Ring whose radius swings between ``near`` and ``far``."""
    return [(x + r * math.cos(a), y + r * math.sin(a)) for i in range(n)
            for a, r in [(2 * math.pi * i / n, far if i % 2 else near)]]


def spots(spark, n):
    """Points over the square from -3 to 3, some on vertices, twice each for ids divisible by 10."""
    made = [(i, ((i * 0.618034) % 1) * 6 - 3, ((i * 0.7548777) % 1) * 6 - 3) for i in range(n)]
    made += [(10_000 + i, x, y) for i, (x, y) in enumerate(star(300, 0.0, 0.0, 1.0, 2.0)[::7])]
    made += [(20_000 + i, x, y) for i, (x, y) in enumerate(BAR)]
    made += [m for m in made if m[0] % 10 == 0]
    table = spark.createDataFrame(made, "id bigint, x double, y double")
    return table.select("id", F.concat(F.lit("n"), "id").alias("name"), g.point(F.col("x"), F.col("y")).alias("geom"))


BAR = [(-2.5, -2.5), (2.5, -2.5), (2.5, -2.2), (0.0, -2.2), (-2.5, -2.2)]


def areas(spark):
    hole = star(200, 0.0, 0.0, 0.3, 0.7)
    comb = [(-2.8 + i * 0.01, 2.9 if i % 2 else 2.0) for i in range(200)] + [(-0.8, 1.9), (-2.8, 1.9)]
    shapes = [
        (1, {"kind": "polygon", "parts": [star(300, 0.0, 0.0, 1.0, 2.0), hole]}),
        (1, {"kind": "polygon", "parts": [star(250, 1.0, 1.0, 0.5, 0.6)]}),
        (2, {"kind": "polygon", "parts": [star(300, 0.0, 0.0, 1.0, 2.0), hole]}),
        (2, {"kind": "polygon", "parts": [star(300, 0.0, 0.0, 1.0, 2.0), hole]}),
        (3, {"kind": "polygon", "parts": [comb]}),
        (4, {"kind": "polygon", "parts": [BAR + [(-2.5 + i * 1e-4, -2.3) for i in range(150)]]}),
        (5, (-1.0, -1.0, 1.0, 1.0)),
        (6, {"kind": "line", "parts": [star(300, 0.0, 0.0, 1.0, 2.0)]}),
    ]
    rows = [(i, g.as_geometry(s)) for i, s in shapes] + [(7, None), (None, g.as_geometry(shapes[0][1]))]
    return spark.createDataFrame(rows, f"query_id bigint, geom {g.GEOMETRY}")


def rows(df):
    return sorted(map(str, df.select("query_id", "feature_id", "name").collect()))


@pytest.mark.parametrize("few", [True, False])
@pytest.mark.parametrize("predicate", ["INTERSECTS", "WITHIN"])
def test_segments_find_what_whole_rings_find(spark, monkeypatch, predicate, few):
    layer, queries = spots(spark, 1500), areas(spark)
    whole = rows(sel.features_by_geom(layer, POINTS, queries, predicate=predicate, outfields=["name"]))
    monkeypatch.setattr(sel, "LONG_RING", 100)
    if not few:
        monkeypatch.setattr(long_rings, "small_rows", lambda df, limit: False)
        monkeypatch.setattr("geolayer.plans.spatial_join.BLOCK_ROWS", 40)
    cut = rows(sel.features_by_geom(layer, POINTS, queries, predicate=predicate, outfields=["name"]))
    assert cut == whole and len(whole) > 1000


def test_contains_by_id_and_empty_tables(spark, monkeypatch):
    layer, queries = spots(spark, 300), areas(spark)
    asked = dict(relation="esriSpatialRelContains", outfields=["name"])
    whole = rows(sel.ids_by_geom(layer, POINTS, queries, **asked))
    monkeypatch.setattr(sel, "LONG_RING", 100)
    assert rows(sel.ids_by_geom(layer, POINTS, queries, **asked)) == whole
    assert rows(sel.ids_by_geom(layer.limit(0), POINTS, queries, **asked)) == []
    assert rows(sel.ids_by_geom(layer, POINTS, queries.limit(0), **asked)) == []


def test_a_ring_of_100_000_vertices(spark):
    n = 100_000
    ring = {"kind": "polygon", "parts": [[
        (r * math.cos(a), r * math.sin(a)) for i in range(n)
        for a in [2 * math.pi * i / n] for r in [2 + 0.001 * math.sin(50_000 * a / 7)]]]}
    queries = g.literal_table(spark, ring)
    layer = spark.range(100_000).select(
        "id", g.point(F.pmod(F.col("id") * 0.618034, F.lit(1.0)) * 6 - 3,
                      F.pmod(F.col("id") * 0.7548777, F.lit(1.0)) * 6 - 3).alias("geom"))
    start = time.time()
    found = sel.ids_by_geom(layer, POINTS, queries).count()
    seconds = time.time() - start
    assert abs(found / 100_000 - math.pi * 4 / 36) < 0.005
    assert seconds < 30, seconds
    print("seconds", seconds)


def row_groups(df):
    return [m.row_group(i).num_rows for f in df.inputFiles()
            for m in [pq.ParquetFile(urlparse(f).path).metadata] for i in range(m.num_row_groups)]


def test_long_rows_are_stored_in_small_row_groups(spark):
    df = spark.range(0, 500, 1, 1).select("id", F.sequence(F.lit(1), F.lit(2000)).alias("v"))
    stored = written(df, long_rows=True)
    assert sum(row_groups(stored)) == 500 and max(row_groups(stored)) <= 64
    assert stored.orderBy("id").collect() == df.collect()
    assert row_groups(written(df.select("id"))) == [500]


def test_the_query_stores_its_rings_in_small_row_groups(spark, tmp_path, monkeypatch):
    spark.range(400).selectExpr(
        "id * 977 AS c_custkey", "0 AS c_nationkey", "0D AS c_acctbal", "'A' AS c_mktsegment").write.parquet(
        str(tmp_path / "customer.parquet"))
    spark.range(200).selectExpr("id AS s_suppkey", "0D AS s_acctbal").write.parquet(str(tmp_path / "supplier.parquet"))
    stored = []

    def kept(*args, **kinds):
        stored.append(written(*args, **kinds))
        return stored[-1]

    monkeypatch.setattr(selection, "written", kept)
    # All rings in one file, as those of a large table are.
    monkeypatch.setattr(selection.ly, "spread_small", lambda df, key: df.coalesce(1))
    found = selection.c3b_long_rings(spark, str(tmp_path))
    short = selection.c3b(spark, str(tmp_path))
    assert found.count() > 50 and sorted(found.collect()) == sorted(short.collect())
    assert sum(row_groups(stored[0])) == 200 and max(row_groups(stored[0])) <= 64


def test_rings_are_counted_by_their_sizes(spark, monkeypatch):
    """Only the first measure and the last step read the rings; no ring is prepared for the row-wise test."""
    layer, queries = spots(spark, 1500), areas(spark).where("query_id IN (1, 2, 3)")
    asked = dict(predicate="WITHIN", outfields=["name"])
    whole = rows(sel.features_by_geom(layer, POINTS, queries, **asked))
    monkeypatch.setattr(sel, "LONG_RING", 100)
    monkeypatch.setattr("geolayer.plans.block_join.BLOCK_POINTS", 200)
    monkeypatch.setattr(long_rings, "BLOCK_RING_VERTICES", 400)
    asked_of, counted = [], []
    real = {n: getattr(block_join, n) for n in ("measure", "hot_cells")}

    def measured(df, n, level):
        asked_of.append(df.columns)
        return real["measure"](df, n, level)

    def hot(left, right, *bounds):
        counted.append(right.columns)
        return real["hot_cells"](left, right, *bounds)

    monkeypatch.setattr(block_join, "measure", measured)
    monkeypatch.setattr(block_join, "hot_cells", hot)
    found = sel.features_by_geom(layer, POINTS, queries, **asked)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert rows(found) == whole and len(whole) > 300
    assert len(asked_of) == 2 and len(counted) == 1
    assert not any({"xs", "ys", "prep"} & set(c) for c in (*asked_of, *counted))
    assert "l_prep" not in plan
