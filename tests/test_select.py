import pytest
from pyspark.sql import functions as F

from geolayer.errors import InputTypeError, InputValueError, ZeroMatchedError
from geolayer.functions import geometry as g
from geolayer.functions import relate
from geolayer.layer import LayerInfo
from geolayer.operators import select as sel
from geolayer.plans import bounded, spatial_join
from workloads import layers as ly
from workloads.layers import CATCHMENTS, SITES

SITE = LayerInfo("id")


def layer(spark, shapes):
    rows = [(i, g.as_geometry(s)) for i, s in enumerate(shapes)]
    return spark.createDataFrame(rows, f"id bigint, geom {g.GEOMETRY}")


def found(df):
    return sorted(r.feature_id for r in df.collect())


def pairs(df):
    return sorted(map(tuple, df.select("query_id", "feature_id").collect()))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


RING = {"kind": "polygon", "parts": [[(0, 0), (4, 0), (4, 4), (0, 4)], [(1, 1), (3, 1), (3, 3), (1, 3)]]}


def test_within_and_contains_are_opposite_between_the_two_apis(spark):
    areas = layer(spark, [(0.0, 0.0, 4.0, 4.0), (10.0, 10.0, 11.0, 11.0), (1.0, 1.0, 2.0, 2.0)])
    spot = (1.5, 1.5)
    assert found(sel.ids_by_geom(areas, SITE, spot, relation="esriSpatialRelWithin")) == [0, 2]
    assert found(sel.ids_by_geom(areas, SITE, spot, relation="esriSpatialRelContains")) == []
    assert found(sel.features_by_geom(areas, SITE, spot, predicate="CONTAINS")) == [0, 2]
    assert found(sel.features_by_geom(areas, SITE, spot, predicate="WITHIN")) == []
    frame = (0.5, 0.5, 5.0, 5.0)
    assert found(sel.ids_by_geom(areas, SITE, frame, relation="esriSpatialRelContains")) == [2]
    assert found(sel.features_by_geom(areas, SITE, frame, predicate="within")) == [2]


def test_point_and_line_in_one_area_find_the_same(spark):
    areas = layer(spark, [(0.0, 0.0, 4.0, 4.0), (5.0, 0.0, 6.0, 4.0)])
    a = sel.ids_by_geom(areas, SITE, (1.0, 1.0), relation="esriSpatialRelWithin")
    b = sel.ids_by_geom(areas, SITE, {"kind": "line", "parts": [[(1, 1), (2, 2)]]})
    assert found(a) == found(b) == [0]


def test_holes_are_kept(spark):
    spots = layer(spark, [(2.0, 2.0), (0.5, 0.5), (1.0, 2.0)])
    assert found(sel.ids_by_geom(spots, SITE, RING)) == [1, 2]
    assert found(sel.features_by_geom(spots, SITE, RING, predicate="disjoint")) == [0]


def test_disjoint_is_all_but_intersects(spark, sf):
    spots = ly.sites(spark, sf)
    queries = ly.as_queries(ly.boxes(spark, sf), "box_id")
    hit = pairs(sel.features_by_geom(spots, SITES, queries, predicate="INTERSECTS"))
    miss = pairs(sel.features_by_geom(spots, SITES, queries, predicate="DISJOINT"))
    assert not set(hit) & set(miss)
    assert len(hit) + len(miss) == 25 * spots.count()


def test_disjoint_refuses_long_query_tables(spark, monkeypatch):
    monkeypatch.setattr(sel, "MAX_COMPLEMENT_QUERIES", 2)
    spots = layer(spark, [(1.0, 1.0)])
    queries = layer(spark, [(1.0, 1.0)] * 3).withColumnRenamed("id", "query_id")
    with pytest.raises(InputValueError):
        sel.features_by_geom(spots, SITE, queries, predicate="DISJOINT")


def test_relation_pattern(spark):
    areas = layer(spark, [(0.0, 0.0, 2.0, 2.0), (2.0, 0.0, 4.0, 2.0)])
    frame = (2.0, 0.0, 4.0, 2.0)
    got = sel.features_by_geom(areas, SITE, frame, predicate="RELATE", pattern="FF*F1****")
    assert found(got) == [0]
    with pytest.raises(InputTypeError):
        sel.features_by_geom(areas, SITE, frame, predicate="RELATE")
    with pytest.raises(InputValueError):
        sel.features_by_geom(areas, SITE, frame, predicate="RELATE", pattern="FF*FF****")
    with pytest.raises(InputTypeError):
        sel.ids_by_geom(areas, SITE, frame, relation="esriSpatialRelRelation")


def test_query_is_moved_to_the_layer_crs(spark):
    spots = layer(spark, [(-69.76361, 45.445491), (-69.0, 45.0)])
    near = sel.ids_by_geom(spots, SITE, (-7766149.0, 5691829.0, -7765949.0, 5692029.0), geo_crs=3857)
    assert found(near) == [0]


def test_distance_to_lines_and_areas(spark):
    shapes = [(0.02, 0.0), {"kind": "line", "parts": [[(0.005, -1), (0.005, 1)]]},
              (0.03, -0.01, 0.04, 0.01), (0.5, 0.5)]
    things = layer(spark, shapes)
    assert found(sel.within_distance(things, SITE, (0.0, 0.0), 600)) == [1]
    assert found(sel.within_distance(things, SITE, (0.0, 0.0), 2300)) == [0, 1]
    assert found(sel.within_distance(things, SITE, (0.0, 0.0), 3400)) == [0, 1, 2]
    assert found(sel.ids_by_geom(things, SITE, (0.0, 0.0), distance=0.9)) == []
    with pytest.raises(InputValueError):
        sel.within_distance(things, SITE, (0.0, 0.0), 0.5)


def test_distance_to_several_points_and_in_a_projected_layer(spark):
    spots = layer(spark, [(-75.0, 40.0), (-75.0, 40.02), [(-80.0, 40.0), (-75.0, 40.05)]])
    ends = [(-75.0, 40.001), (-79.99, 40.0)]
    assert found(sel.ids_by_geom(spots, SITE, ends, distance=1500)) == [0, 2]
    from geolayer.operators import coordinates as co
    metric = LayerInfo("id", epsg=32618)
    moved = co.reproject(spots, 32618)
    assert found(sel.ids_by_geom(moved, metric, ends, distance=1500)) == [0, 2]
    with pytest.raises(InputValueError):
        sel.ids_by_geom(spots, SITE, ends, distance=5, relation="esriSpatialRelWithin")


def test_beyond(spark):
    spots = layer(spark, [(0.01, 0.0), (1.0, 0.0)])
    assert found(sel.features_by_geom(spots, SITE, (0.0, 0.0), predicate="BEYOND", metres=5000)) == [1]
    with pytest.raises(InputTypeError):
        sel.features_by_geom(spots, SITE, (0.0, 0.0), predicate="BEYOND")


def brute_envelopes(a, b):
    return sorted((q, f) for f, (fw, fs, fe, fn) in enumerate(a) for q, (qw, qs, qe, qn) in enumerate(b)
                  if fw <= qe and qw <= fe and fs <= qn and qs <= fn)


def mixed_boxes(n, seed):
    import random
    rng = random.Random(seed)
    out = []
    for i in range(n):
        w, s = rng.randrange(-40, 40) / 4, rng.randrange(-40, 40) / 4
        side = rng.choice([0.05, 0.25, 0.5, 1.0, 7.0, 30.0])
        out.append((w, s, w + side, s + side * rng.choice([0.1, 1.0])))
    return out


@pytest.mark.parametrize("shuffled", [False, True])
def test_candidates_of_mixed_sizes_are_complete_and_unique(spark, monkeypatch, shuffled):
    if shuffled:
        monkeypatch.setattr(bounded, "MAX_BROADCAST_ROWS", 0)
        monkeypatch.setattr(spatial_join, "BLOCK_ROWS", 4)
        monkeypatch.setattr(spatial_join, "MAX_SENT_CELLS", 10)
    a, b = mixed_boxes(120, 1), mixed_boxes(80, 2)
    queries = layer(spark, b).withColumnRenamed("id", "query_id")
    got = sel.ids_by_geom(layer(spark, a), SITE, queries, relation="esriSpatialRelEnvelopeIntersects")
    assert pairs(got) == brute_envelopes(a, b)


def dense(spark, n, side, seed):
    """Boxes of one side, 99 of 100 within a thousandth of the default cell."""
    spread = F.when(F.col("id") % 100 == 0, 20.0).otherwise(0.0005)
    return spark.range(n).select(
        "id", (F.lit(10.0) + F.rand(seed) * spread).alias("xmin"),
        (F.lit(10.0) + F.rand(seed + 1) * spread).alias("ymin")).select(
        "id", "xmin", "ymin", (F.col("xmin") + side).alias("xmax"), (F.col("ymin") + side).alias("ymax"),
        F.col("id").alias("_salt"), F.lit(5).alias("_nv"))


@pytest.mark.parametrize("shuffled", [False, True])
@pytest.mark.parametrize("side", [0.0, 4e-6])
def test_dense_features_meet_few_that_are_far(spark, monkeypatch, shuffled, side):
    """Of 400 million pairs of the two tables, few more meet in a cell than have overlapping envelopes."""
    if shuffled:
        monkeypatch.setattr(bounded, "MAX_BROADCAST_ROWS", 0)
    left, right = dense(spark, 20_000, side, 1).drop("_nv").cache(), dense(spark, 2_000, 1e-5, 7).cache()
    cells = spatial_join.cells_of(left, right, 0.5, None, side == 0)
    assert cells.send != shuffled
    met, pairs = cells.joined().count(), spatial_join.candidate_pairs(left, right, 0.5, None, side == 0)
    want = left.alias("l").join(right.alias("r"), F.expr(
        "l.xmin <= r.xmax AND r.xmin <= l.xmax AND l.ymin <= r.ymax AND r.ymin <= l.ymax")).count()
    assert pairs.count() == want > 1000
    assert met < 30 * want + 100_000


def test_levels_follow_the_crowd(spark):
    size = bounded.Size(1_000_000, 0, (-20,), (1_000_000,))
    queries = bounded.Size(300, 0, (-6, -3, 0), (100, 100, 100))
    sparse = {k: 1.0 for k in range(-20, 25, 2)}
    assert spatial_join.chosen_levels(size, queries, sparse) == (0,)
    dense_ = {k: 1e6 * 4.0 ** min(k, 0) for k in range(-20, 25, 2)}
    assert spatial_join.chosen_levels(size, queries, dense_) == (-6, -3, 0)
    one_spot = spark.range(5000).select(F.lit(1.0).alias("xmin"), F.lit(1.0).alias("ymin"))
    assert all(abs(v - 5000) < 1 for v in spatial_join.crowding(one_spot, 0.5).values())
    even = spark.range(40_000).select(
        (F.col("id") % 200 / 2 + 0.1).alias("xmin"), (F.floor(F.col("id") / 200) / 2 + 0.1).alias("ymin"))
    got = spatial_join.crowding(even, 0.5)
    assert 1 <= got[0] < 1.5 and 12 < got[2] < 20


def test_large_geometries_are_prepared_fast(spark):
    import time
    ring = F.transform(F.sequence(F.lit(0), F.lit(100_000)), lambda i: g.vertex(
        F.cos(i % 100_000 * 2e-5 * 3.141592653589793), F.sin(i % 100_000 * 2e-5 * 3.141592653589793)))
    whole = spark.range(1).select(F.struct(
        F.lit("line").alias("kind"), F.array(ring).alias("parts")).alias("geom"))
    start = time.perf_counter()
    row = whole.select(F.expr(f"transform(array({relate.prepare('geom')}), "
                              "p -> array(size(p.verts), size(p.segs), size(p.ends)))[0]").alias("n")).first()
    assert row.n == [100_000, 100_000, 0]
    assert time.perf_counter() - start < 30


def test_one_rule_for_short_and_long_id_lists(spark):
    spots = spark.range(50).select("id", F.expr("date_add(DATE'2020-01-01', int(id))").alias("day"))
    more = [str(i) for i in range(1000, 2500)]
    for odd, want in ((["1_0", "7"], [7]), ([2 ** 70, 3], [3]), (["x", " 4 "], [4]), ([], [])):
        for ids in (odd, odd + more):
            got = sel.ids_by_field(spots, SITE, "id", ids)
            assert sorted(r.id for r in got.collect()) == want
    for ids in (["2020-01-03", "no day"], ["2020-01-03", "no day", *("d" + i for i in more)]):
        assert [r.id for r in sel.ids_by_field(spots, SITE, "day", ids).collect()] == [2]


def test_hot_cell_is_split_and_nothing_is_lost(spark, monkeypatch):
    monkeypatch.setattr(bounded, "MAX_BROADCAST_ROWS", 0)
    monkeypatch.setattr(spatial_join, "BLOCK_ROWS", 20)
    spots = spark.range(300).select("id", g.point(F.lit(0.1), F.lit(0.1)).alias("geom"))
    queries = spark.range(50).select(
        F.col("id").alias("query_id"),
        g.box(F.lit(0.0), F.lit(0.0), F.lit(0.2), F.lit(0.2)).alias("geom"))
    got = sel.ids_by_geom(spots, LayerInfo("id", kind="point"), queries)
    assert got.count() == 300 * 50 == got.distinct().count()


def test_fields_are_carried_without_a_join_on_the_id(spark, sf):
    spots = ly.sites(spark, sf)
    queries = ly.as_queries(ly.boxes(spark, sf), "box_id")
    got = sel.ids_by_geom(spots, SITES, queries, outfields=["segment", "site_id"])
    assert got.columns == ["query_id", "feature_id", "segment", "site_id"]
    assert plan(got).count("Join") == 1
    assert got.where("feature_id <> site_id").count() == 0
    far = sel.features_by_geom(spots, SITES, (-100.0, 30.0), predicate="BEYOND", metres=1000,
                               outfields=["segment"])
    assert far.columns == ["query_id", "feature_id", "segment"]
    with pytest.raises(InputValueError):
        sel.ids_by_geom(spots, SITES, queries, outfields=["nope"])


def test_empty_and_null_geometries_match_nothing(spark):
    rows = spark.createDataFrame([(0, None), (1, ("polygon", []))], f"id bigint, geom {g.GEOMETRY}")
    assert found(sel.ids_by_geom(rows, SITE, (0.0, 0.0, 1.0, 1.0))) == []
    none = layer(spark, [(0.0, 0.0)]).where("id > 5")
    assert found(sel.ids_by_geom(none, SITE, (0.0, 0.0, 1.0, 1.0))) == []
    assert found(sel.ids_by_geom(layer(spark, [(0.0, 0.0)]), SITE, none.withColumnRenamed(
        "id", "query_id"))) == []


def test_no_quadratic_join_and_filter_reaches_the_scan(spark, sf):
    spots = ly.sites(spark, sf)
    queries = ly.as_queries(ly.catchments(spark, sf), "catch_id")
    got = sel.ids_by_geom(spots, SITES, queries, where="acctbal > 0 AND segment = 'BUILDING'")
    text = plan(got)
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
    assert "GreaterThan(c_acctbal,0.0)" in text and "EqualTo(c_mktsegment,BUILDING)" in text
    near = plan(sel.within_distance(spots, SITES, ly.as_queries(spots, "site_id"), 1000))
    assert "CartesianProduct" not in near and "NestedLoopJoin" not in near


def test_shuffled_plan_has_no_quadratic_join(spark, sf, monkeypatch):
    monkeypatch.setattr(bounded, "MAX_BROADCAST_ROWS", 0)
    areas = ly.catchments(spark, sf)
    text = plan(sel.ids_by_geom(areas, CATCHMENTS, ly.as_queries(areas, "catch_id")))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


def test_box_filter_is_pushed(spark, sf, tmp_path):
    path = str(tmp_path / "sites")
    ly.sites(spark, sf).write.parquet(path)
    text = plan(sel.features_by_box(spark.read.parquet(path), SITES, (-100.0, 30.0, -90.0, 40.0)))
    assert "LessThanOrEqual(xmin,-90.0)" in text and "GreaterThanOrEqual(ymax,30.0)" in text


def test_box_argument(spark):
    spots = layer(spark, [(10.0, 50.0), (50.0, 10.0)])
    assert [r.id for r in sel.features_by_box(spots, SITE, (9.0, 49.0, 11.0, 51.0)).collect()] == [0]
    # The axis flag concerns the text of a request, not the order in which a box is given.
    same = sel.features_by_box(spots, SITE, (9.0, 49.0, 11.0, 51.0), always_xy=False)
    assert [r.id for r in same.collect()] == [0]
    with pytest.raises(InputTypeError):
        sel.features_by_box(spots, SITE, (1.0, 2.0, 3.0))


def test_bad_arguments(spark):
    spots = layer(spark, [(0.0, 0.0)])
    with pytest.raises(InputValueError, match="esriSpatialRelIntersects"):
        sel.ids_by_geom(spots, SITE, (0.0, 0.0), relation="intersects")
    with pytest.raises(InputValueError, match="BEYOND"):
        sel.features_by_geom(spots, SITE, (0.0, 0.0), predicate="NEAR")
    with pytest.raises(InputTypeError):
        sel.ids_by_geom(spots, SITE, (1.0, 2.0, 3.0, 4.0, 5.0))
    with pytest.raises(InputTypeError):
        sel.ids_by_sql(spots, SITE, 3)
    with pytest.raises(InputValueError, match="id"):
        sel.ids_by_field(spots, SITE, "nope", [1])
    with pytest.raises(InputTypeError):
        sel.features_by_id(spots, SITE, "id", [])
    with pytest.raises(ZeroMatchedError):
        sel.ids_by_sql(spots, SITE, "id > 7", require_match=True)
    assert sel.ids_by_sql(spots, SITE, "id > 7").count() == 0


def test_long_id_lists_become_a_join(spark):
    spots = spark.range(5000).withColumn("name", F.col("id").cast("string"))
    info = LayerInfo("id")
    assert sel.ids_by_field(spots, info, "id", list(range(0, 3000)) * 2).count() == 3000
    assert sel.ids_by_field(spots, info, "name", [str(i) for i in range(2000)]).count() == 2000
    assert sel.features_by_id(spots, info, "id", "17").count() == 1
