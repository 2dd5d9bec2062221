"""Selection by fields, clauses, boxes and geometry."""

from __future__ import annotations

from pyspark.sql import functions as F

from geolayer.functions import geometry as g
from geolayer.layer import LayerInfo
from geolayer.operators import select as sel
from geolayer.session import written
from workloads import layers as ly
from workloads.layers import (
    BOXES_SQL, CATCHMENT_EDGES_SQL, CATCHMENT_GRID_SQL, CATCHMENTS, CATCHMENTS_SQL, PARCELS,
    PARCELS_SQL, REACH_EDGES_SQL, REACH_GRID_SQL, REACHES, REACHES_SQL, SITES, SITES_SQL,
)
from workloads.registry import query
from workloads.sqltext import clipped_sql, crossing_sql, geodesic_sql, points_in_sql

ORDERS = LayerInfo("o_orderkey")
LINEITEM = LayerInfo("l_orderkey")
SEGMENTS = ["BUILDING", "MACHINERY", "BUILDING"]

SITE_IN_CATCHMENT = points_in_sql(
    f"SELECT site_id AS pid, lon AS x, lat AS y FROM ({SITES_SQL})",
    f"SELECT catch_id AS gid, x1, y1, x2, y2 FROM ({CATCHMENT_EDGES_SQL})")
SITE_IN_BOX = f"""SELECT box_id, site_id, acctbal FROM ({BOXES_SQL}) b JOIN ({SITES_SQL}) s
    ON lon >= west AND lon <= east AND lat >= south AND lat <= north"""
CATCHMENT_CROSSING = crossing_sql(CATCHMENT_GRID_SQL, CATCHMENT_GRID_SQL, "catch_id", "catch_id")
REACH_IN_BOX = clipped_sql(
    f"SELECT reach_id AS lid, x1, y1, x2, y2 FROM ({REACH_EDGES_SQL})",
    f"SELECT box_id AS bid, west, south, east, north FROM ({BOXES_SQL})")
REACH_OUTSIDE = f"""SELECT box_id AS bid, reach_id AS lid FROM ({BOXES_SQL}) JOIN ({REACHES_SQL}) ON
    NOT (least(x0,x1,x2) >= west AND greatest(x0,x1,x2) <= east
    AND least(y0,y1,y2) >= south AND greatest(y0,y1,y2) <= north)"""


def ids(pairs):
    return pairs.select("query_id", "feature_id")


@query("c1_ids_by_field", "SELECT o_orderkey FROM orders WHERE o_custkey IN (7, 11, 44, 101)")
def c1(spark, sf):
    return sel.ids_by_field(ly.table(spark, sf, "orders"), ORDERS, "o_custkey", [7, 11, 44, 101, 11])


@query("c1_ids_by_id_table", """SELECT o_orderkey FROM orders WHERE o_custkey IN
    (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def c1_table(spark, sf):
    wanted = ly.table(spark, sf, "customer").where("c_mktsegment = 'BUILDING'").select("c_custkey")
    return sel.ids_by_field(ly.table(spark, sf, "orders"), ORDERS, "o_custkey", wanted)


@query("c1_ids_by_text_field", """SELECT site_id FROM (%s)
    WHERE segment IN ('BUILDING', 'MACHINERY')""" % SITES_SQL)
def c1_text(spark, sf):
    return sel.ids_by_field(ly.sites(spark, sf), SITES, "segment", SEGMENTS)


@query("c2_ids_by_sql", """SELECT l_orderkey FROM lineitem WHERE l_quantity > 45 AND
    l_discount BETWEEN 0.02 AND 0.06 AND l_returnflag <> 'N' AND l_shipdate < DATE '1997-01-01'""")
def c2(spark, sf):
    return sel.ids_by_sql(
        ly.table(spark, sf, "lineitem"), LINEITEM,
        "l_quantity > 45 AND l_discount BETWEEN 0.02D AND 0.06D AND l_returnflag <> 'N' "
        "AND l_shipdate < DATE '1997-01-01'")


@query("c3a_intersects_sites_boxes",
       f"SELECT box_id AS query_id, site_id AS feature_id FROM ({SITE_IN_BOX})")
def c3a(spark, sf):
    return ids(sel.ids_by_geom(
        ly.sites(spark, sf), SITES, ly.as_queries(ly.boxes(spark, sf), "box_id")))


@query("c3a_intersects_sites_catchments",
       f"SELECT gid AS query_id, pid AS feature_id FROM ({SITE_IN_CATCHMENT})")
def c3a_catchments(spark, sf):
    return ids(sel.ids_by_geom(
        ly.sites(spark, sf), SITES, ly.as_queries(ly.catchments(spark, sf), "catch_id")))


@query("c3a_intersects_reaches_catchments", f"""WITH hit AS ({crossing_sql(
    CATCHMENT_EDGES_SQL, REACH_EDGES_SQL, "catch_id", "reach_id")}),
    inside AS ({points_in_sql(
        f"SELECT reach_id AS pid, x0 AS x, y0 AS y FROM ({REACHES_SQL})",
        f"SELECT catch_id AS gid, x1, y1, x2, y2 FROM ({CATCHMENT_EDGES_SQL})")})
    SELECT aid AS query_id, bid AS feature_id FROM hit UNION SELECT gid, pid FROM inside""")
def c3a_lines(spark, sf):
    return ids(sel.ids_by_geom(
        ly.reaches(spark, sf), REACHES, ly.as_queries(ly.catchments(spark, sf), "catch_id")))


@query("c3b_contains_sites_in_catchments",
       f"SELECT gid AS query_id, pid AS feature_id FROM ({SITE_IN_CATCHMENT})")
def c3b(spark, sf):
    return ids(sel.ids_by_geom(
        ly.sites(spark, sf), SITES, ly.as_queries(ly.catchments(spark, sf), "catch_id"),
        relation="esriSpatialRelContains"))


@query("c3b_contains_sites_in_long_rings",
       f"SELECT gid AS query_id, pid AS feature_id FROM ({SITE_IN_CATCHMENT})")
def c3b_long_rings(spark, sf):
    # Stored, as query tables are best given: it is read more than once.
    areas = written(ly.as_queries(ly.long_catchments(spark, sf), "catch_id"), "areas", long_rows=True)
    return ids(sel.ids_by_geom(
        ly.sites(spark, sf), SITES, areas, relation="esriSpatialRelContains"))


def _in_ring_sql(role: str) -> str:
    x, half = ly.BASIN_RINGS[role]
    return f"lon BETWEEN {x} - {half} AND {x} + {half} AND lat BETWEEN cy - {half} AND cy + {half}"


@query("c3b_contains_sites_in_basins", f"""SELECT basin_id AS query_id, site_id AS feature_id
    FROM ({ly.BASINS_SQL}) JOIN ({SITES_SQL}) ON lon BETWEEN cx - r AND cx + r*5/2 AND lat BETWEEN cy - r AND cy + r
    WHERE ({_in_ring_sql('shell')} AND NOT ({_in_ring_sql('hole')})) OR ({_in_ring_sql('island')})
    OR ({_in_ring_sql('second')})""")
def c3b_basins(spark, sf):
    """Sites in areas with holes, islands and several shells."""
    return ids(sel.ids_by_geom(
        ly.sites(spark, sf), SITES, ly.as_queries(ly.basins(spark, sf), "basin_id"),
        relation="esriSpatialRelContains"))


@query("c3b_contains_catchments_in_boxes", f"""SELECT box_id AS query_id, catch_id AS feature_id
    FROM ({BOXES_SQL}) JOIN ({CATCHMENTS_SQL}) ON xmin >= west AND xmax <= east AND ymin >= south
    AND ymax <= north""")
def c3b_areas(spark, sf):
    return ids(sel.ids_by_geom(
        ly.catchments(spark, sf), CATCHMENTS, ly.as_queries(ly.boxes(spark, sf), "box_id"),
        relation="esriSpatialRelContains"))


@query("c3c_crosses_reaches_boxes", f"""SELECT bid AS query_id, lid AS feature_id FROM (
    SELECT bid, lid FROM ({REACH_IN_BOX}) INTERSECT SELECT bid, lid FROM ({REACH_OUTSIDE}))""")
def c3c(spark, sf):
    return ids(sel.ids_by_geom(
        ly.reaches(spark, sf), REACHES, ly.as_queries(ly.boxes(spark, sf), "box_id"),
        relation="esriSpatialRelCrosses"))


@query("c3c_crosses_reaches_reaches", f"""SELECT aid AS query_id, bid AS feature_id FROM ({
    crossing_sql(REACH_GRID_SQL, REACH_GRID_SQL, "reach_id", "reach_id")}) WHERE aid <> bid""")
def c3c_lines(spark, sf):
    lines = ly.reaches(spark, sf)
    pairs = sel.ids_by_geom(
        lines, REACHES, ly.as_queries(lines, "reach_id"), relation="esriSpatialRelCrosses")
    return ids(pairs).where("query_id <> feature_id")


@query("c3d_envelope_intersects", f"""SELECT box_id AS query_id, catch_id AS feature_id
    FROM ({BOXES_SQL}) JOIN ({CATCHMENTS_SQL}) ON xmin <= east AND xmax >= west AND ymin <= north
    AND ymax >= south""")
def c3d(spark, sf):
    return ids(sel.ids_by_geom(
        ly.catchments(spark, sf), CATCHMENTS, ly.as_queries(ly.boxes(spark, sf), "box_id"),
        relation="esriSpatialRelEnvelopeIntersects"))


@query("c3e_index_intersects", f"""SELECT a.catch_id AS query_id, b.catch_id AS feature_id
    FROM ({CATCHMENTS_SQL}) a JOIN ({CATCHMENTS_SQL}) b ON a.xmin <= b.xmax AND a.xmax >= b.xmin
    AND a.ymin <= b.ymax AND a.ymax >= b.ymin""")
def c3e(spark, sf):
    areas = ly.catchments(spark, sf)
    return ids(sel.ids_by_geom(
        areas, CATCHMENTS, ly.as_queries(areas, "catch_id"),
        relation="esriSpatialRelIndexIntersects"))


@query("c3f_overlaps_catchments",
       f"SELECT aid AS query_id, bid AS feature_id FROM ({CATCHMENT_CROSSING}) WHERE aid <> bid")
def c3f(spark, sf):
    areas = ly.catchments(spark, sf)
    return ids(sel.ids_by_geom(
        areas, CATCHMENTS, ly.as_queries(areas, "catch_id"), relation="esriSpatialRelOverlaps"))


@query("c3g_touches_parcels", f"""SELECT a.parcel_id AS query_id, b.parcel_id AS feature_id
    FROM ({PARCELS_SQL}) a JOIN ({PARCELS_SQL}) b ON abs(a.col - b.col) <= 1
    AND abs(a.row - b.row) <= 1 AND a.parcel_id <> b.parcel_id""")
def c3g(spark, sf):
    lots = ly.parcels(spark, sf)
    return ids(sel.ids_by_geom(
        lots, PARCELS, ly.as_queries(lots, "parcel_id"), relation="esriSpatialRelTouches"))


@query("c3h_within_sites_as_queries",
       f"SELECT pid AS query_id, gid AS feature_id FROM ({SITE_IN_CATCHMENT})")
def c3h(spark, sf):
    return ids(sel.ids_by_geom(
        ly.catchments(spark, sf), CATCHMENTS, ly.as_queries(ly.sites(spark, sf), "site_id"),
        relation="esriSpatialRelWithin"))


@query("c3i_relation_pattern_reaches_boxes",
       f"SELECT bid AS query_id, lid AS feature_id FROM ({REACH_IN_BOX})")
def c3i(spark, sf):
    return ids(sel.ids_by_geom(
        ly.reaches(spark, sf), REACHES, ly.as_queries(ly.boxes(spark, sf), "box_id"),
        relation="esriSpatialRelRelation", pattern="1********"))


def _site_spot(k: int) -> tuple[float, float]:
    return (-125 + ((k * 7919) % 58000) / 1000, 25 + ((k * 104729) % 24000) / 1000)


@query("c4_geometry_kinds", f"""WITH s AS ({SITES_SQL}) SELECT 0::BIGINT AS query_id, site_id AS feature_id
    FROM s WHERE lon = {_site_spot(10)[0]!r} AND lat = {_site_spot(10)[1]!r}
    UNION ALL SELECT 1, site_id FROM s WHERE
      (lon = {_site_spot(20)[0]!r} AND lat = {_site_spot(20)[1]!r})
      OR (lon = {_site_spot(30)[0]!r} AND lat = {_site_spot(30)[1]!r})
    UNION ALL SELECT 2, site_id FROM s WHERE lat = {_site_spot(40)[1]!r}
      AND lon BETWEEN {_site_spot(40)[0]!r} AND {_site_spot(40)[0]!r} + 30
    UNION ALL SELECT 3, site_id FROM s WHERE lon > -110.0005 AND lat > 30.0005
      AND (lon + 110.0005) + (lat - 30.0005) < 14.0003
    UNION ALL SELECT 4, site_id FROM s WHERE lon BETWEEN -100.5 AND -90.25 AND lat BETWEEN 30.5 AND 40""")
def c4(spark, sf):
    x, y = _site_spot(40)
    shapes = [
        _site_spot(10),
        [_site_spot(20), _site_spot(30)],
        {"kind": "line", "parts": [[(x, y), (x + 30, y)]]},
        {"kind": "polygon", "parts": [[
            (-110.0005, 30.0005), (-110.0005 + 14.0003, 30.0005), (-110.0005, 30.0005 + 14.0003)]]},
        (-100.5, 30.5, -90.25, 40.0),
    ]
    queries = None
    for i, shape in enumerate(shapes):
        one = g.literal_table(spark, shape, i)
        queries = one if queries is None else queries.unionByName(one)
    return ids(sel.ids_by_geom(ly.sites(spark, sf), SITES, queries))


CENTRES_SQL = f"SELECT box_id, west + 5.8 AS mx, south + 2.4 AS my FROM ({BOXES_SQL})"


def centres(spark, sf):
    return ly.boxes(spark, sf).select(
        F.col("box_id").alias("query_id"),
        g.point(F.col("west") + 5.8, F.col("south") + 2.4).alias("geom"))


@query("c5_within_distance_of_centres", f"""SELECT box_id AS query_id, site_id AS feature_id FROM ({
    geodesic_sql("mx", "my", "lon", "lat", f"SELECT * FROM ({CENTRES_SQL}), ({SITES_SQL})")})
    WHERE metres <= 150000""")
def c5(spark, sf):
    return ids(sel.within_distance(ly.sites(spark, sf), SITES, centres(spark, sf), 150_000.9))


@query("c5_site_pairs_within_distance", f"""SELECT aid AS query_id, bid AS feature_id FROM ({
    geodesic_sql("ax", "ay", "bx", "b_y", f'''SELECT a.site_id AS aid, a.lon AS ax, a.lat AS ay,
      b.site_id AS bid, b.lon AS bx, b.lat AS b_y FROM ({SITES_SQL}) a JOIN ({SITES_SQL}) b
      ON abs(a.lat - b.lat) < 0.5 AND abs(a.lon - b.lon) < 0.7''')}) WHERE metres <= 30000""")
def c5_pairs(spark, sf):
    spots = ly.sites(spark, sf)
    return ids(sel.ids_by_geom(
        spots, SITES, ly.as_queries(spots, "site_id"), distance=30_000))


@query("c6_features_by_box", f"""SELECT site_id, segment, lon, lat FROM ({SITES_SQL}) WHERE
    lon BETWEEN -100.1234 AND -80.5 AND lat BETWEEN 28.25 AND 41.75""")
def c6(spark, sf):
    found = sel.features_by_box(ly.sites(spark, sf), SITES, (-100.12340004, 28.25, -80.5, 41.75))
    return found.select("site_id", "segment", "lon", "lat")


_MX = [round(v, 2) for v in (-11000000.0, 3500000.0, -9000000.0, 5000000.0)]


@query("c6_features_by_mercator_box", f"""SELECT reach_id FROM ({clipped_sql(
    f"SELECT reach_id AS lid, x1, y1, x2, y2 FROM ({REACH_EDGES_SQL})",
    f'''SELECT 0 AS bid, degrees({_MX[0]}/6378137.0) AS west,
      degrees(pi()/2 - 2*atan(exp(-{_MX[1]}/6378137.0))) AS south,
      degrees({_MX[2]}/6378137.0) AS east,
      degrees(pi()/2 - 2*atan(exp(-{_MX[3]}/6378137.0))) AS north''')}) JOIN (
    SELECT reach_id FROM ({REACHES_SQL})) ON lid = reach_id""")
def c6_mercator(spark, sf):
    return sel.features_by_box(
        ly.reaches(spark, sf), REACHES, tuple(_MX), box_crs=3857).select("reach_id")


@query("c7a_equals_catchments", f"""SELECT a.catch_id AS query_id, b.catch_id AS feature_id
    FROM ({CATCHMENTS_SQL}) a JOIN ({CATCHMENTS_SQL}) b ON a.cx = b.cx AND a.cy = b.cy
    AND a.r = b.r""")
def c7a(spark, sf):
    areas = ly.catchments(spark, sf)
    return ids(sel.features_by_geom(
        areas, CATCHMENTS, ly.as_queries(areas, "catch_id"), predicate="equals"))


LITERAL_BOX = (-105.25, 30.25, -85.75, 42.5)


@query("c7b_disjoint_sites_box", f"""SELECT 0::BIGINT AS query_id, site_id AS feature_id FROM ({SITES_SQL})
    WHERE NOT (lon BETWEEN {LITERAL_BOX[0]} AND {LITERAL_BOX[2]}
    AND lat BETWEEN {LITERAL_BOX[1]} AND {LITERAL_BOX[3]})""")
def c7b(spark, sf):
    return ids(sel.features_by_geom(
        ly.sites(spark, sf), SITES, LITERAL_BOX, predicate="DISJOINT"))


@query("c7c_intersects_sites_catchments",
       f"SELECT gid AS query_id, pid AS feature_id FROM ({SITE_IN_CATCHMENT})")
def c7c(spark, sf):
    return ids(sel.features_by_geom(
        ly.sites(spark, sf), SITES, ly.as_queries(ly.catchments(spark, sf), "catch_id")))


@query("c7d_touches_parcels", f"""SELECT a.parcel_id AS query_id, b.parcel_id AS feature_id
    FROM ({PARCELS_SQL}) a JOIN ({PARCELS_SQL}) b ON abs(a.col - b.col) <= 1
    AND abs(a.row - b.row) <= 1 AND a.parcel_id <> b.parcel_id""")
def c7d(spark, sf):
    lots = ly.parcels(spark, sf)
    return ids(sel.features_by_geom(
        lots, PARCELS, ly.as_queries(lots, "parcel_id"), predicate="TOUCHES"))


@query("c7e_crosses_reaches_boxes", f"""SELECT bid AS query_id, lid AS feature_id FROM (
    SELECT bid, lid FROM ({REACH_IN_BOX}) INTERSECT SELECT bid, lid FROM ({REACH_OUTSIDE}))""")
def c7e(spark, sf):
    return ids(sel.features_by_geom(
        ly.reaches(spark, sf), REACHES, ly.as_queries(ly.boxes(spark, sf), "box_id"),
        predicate="CROSSES"))


@query("c7f_within_sites_catchments",
       f"SELECT gid AS query_id, pid AS feature_id FROM ({SITE_IN_CATCHMENT})")
def c7f(spark, sf):
    return ids(sel.features_by_geom(
        ly.sites(spark, sf), SITES, ly.as_queries(ly.catchments(spark, sf), "catch_id"),
        predicate="WITHIN"))


@query("c7g_contains_catchments_around_sites",
       f"SELECT pid AS query_id, gid AS feature_id FROM ({SITE_IN_CATCHMENT})")
def c7g(spark, sf):
    return ids(sel.features_by_geom(
        ly.catchments(spark, sf), CATCHMENTS, ly.as_queries(ly.sites(spark, sf), "site_id"),
        predicate="CONTAINS"))


@query("c7h_overlaps_catchments",
       f"SELECT aid AS query_id, bid AS feature_id FROM ({CATCHMENT_CROSSING}) WHERE aid <> bid")
def c7h(spark, sf):
    areas = ly.catchments(spark, sf)
    return ids(sel.features_by_geom(
        areas, CATCHMENTS, ly.as_queries(areas, "catch_id"), predicate="OVERLAPS"))


@query("c7i_relate_sites_catchments",
       f"SELECT gid AS query_id, pid AS feature_id FROM ({SITE_IN_CATCHMENT})")
def c7i(spark, sf):
    return ids(sel.features_by_geom(
        ly.sites(spark, sf), SITES, ly.as_queries(ly.catchments(spark, sf), "catch_id"),
        predicate="RELATE", pattern="0FFFFF212"))


@query("c7j_beyond_sites_point", f"""SELECT 0::BIGINT AS query_id, site_id AS feature_id FROM ({
    geodesic_sql("-96.5", "37.25", "lon", "lat", SITES_SQL)}) WHERE metres > 800000""")
def c7j(spark, sf):
    return ids(sel.features_by_geom(
        ly.sites(spark, sf), SITES, (-96.5, 37.25), predicate="BEYOND", metres=800_000))


@query("c8_features_by_id", "SELECT * FROM orders WHERE o_custkey IN (3, 5, 8, 13, 1200)")
def c8(spark, sf):
    return sel.features_by_id(
        ly.table(spark, sf, "orders"), ORDERS, "o_custkey", ["3", 5, 8, 13, 13, 1200])


@query("c9_features_by_filter", """SELECT p_partkey, p_name, p_type FROM part
    WHERE p_name LIKE 's%ring' AND p_size > 10""")
def c9(spark, sf):
    return sel.features_by_filter(
        ly.table(spark, sf, "part"), "p_name LIKE 's%ring' AND p_size > 10"
    ).select("p_partkey", "p_name", "p_type")


@query("c10_geometry_and_clause", f"""SELECT gid AS query_id, pid AS feature_id FROM (
    {SITE_IN_CATCHMENT}) JOIN ({SITES_SQL}) ON site_id = pid WHERE acctbal > 0 AND segment <> 'BUILDING'""")
def c10(spark, sf):
    return ids(sel.ids_by_geom(
        ly.sites(spark, sf), SITES, ly.as_queries(ly.catchments(spark, sf), "catch_id"),
        where="acctbal > 0 AND segment <> 'BUILDING'"))


@query("c10_catchments_meeting_boxes_large_radius", f"""SELECT box_id AS query_id,
    catch_id AS feature_id FROM ({BOXES_SQL}) JOIN ({CATCHMENTS_SQL}) ON xmin <= east + 1e-9
    AND xmax >= west - 1e-9 AND ymin <= north + 1e-9 AND ymax >= south - 1e-9 AND r > 0.75""")
def c10_areas(spark, sf):
    return ids(sel.ids_by_geom(
        ly.catchments(spark, sf), CATCHMENTS, ly.as_queries(ly.boxes(spark, sf), "box_id"),
        where="r > 0.75"))


def sites_in_boxes(spark, sf):
    """Flagship: the sites in each box that owe nothing, with their attributes."""
    found = sel.ids_by_geom(
        ly.sites(spark, sf), SITES, ly.as_queries(ly.boxes(spark, sf), "box_id"),
        where="acctbal > 0", outfields=["segment", "acctbal"])
    return found.select(F.col("query_id").alias("box_id"), F.col("feature_id").alias("site_id"),
                        "segment", "acctbal")


query("flagship_sites_in_boxes", f"""SELECT box_id, b.site_id, segment, b.acctbal FROM ({SITE_IN_BOX}) b
    JOIN ({SITES_SQL}) s ON b.site_id = s.site_id WHERE b.acctbal > 0""")(sites_in_boxes)


