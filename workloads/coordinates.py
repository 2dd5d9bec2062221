"""Coordinates, encodings and tiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from geolayer.functions import crs
from geolayer.functions import geometry as g
from geolayer.operators import coordinates as co
from geolayer.operators import tiles as tl
from workloads import layers as ly
from workloads.layers import (
    BOXES_SQL, CATCHMENTS_SQL, REACH_EDGES_SQL, REACHES_SQL, SITES, SITES_SQL,
)
from workloads.registry import query
from workloads.sqltext import albers_sql, geodesic_sql, utm_sql

GRID = 1e6


def spot(name: str, part: int = 0, place: int = 0):
    return F.col(name).parts[part][place]


@query("f1_check_crs", """SELECT n_nationkey, code, ok AS crs_valid, CASE WHEN ok THEN 'epsg:' || num END AS crs
    FROM (SELECT *, num IN (4326, 4269, 3857, 2149) OR num BETWEEN 32601 AND 32660
      OR num BETWEEN 32701 AND 32760 OR num BETWEEN 26901 AND 26923 AS ok FROM (
      SELECT n_nationkey, CASE n_nationkey % 5 WHEN 0 THEN 'EPSG:' || (26900 + n_nationkey) WHEN 1 THEN '4326'
      WHEN 2 THEN 'epsg:' || (32600 + n_nationkey) WHEN 3 THEN '9999' ELSE '2149' END AS code,
      CASE n_nationkey % 5 WHEN 0 THEN 26900 + n_nationkey WHEN 1 THEN 4326 WHEN 2 THEN 32600 + n_nationkey
      WHEN 3 THEN 9999 ELSE 2149 END AS num FROM nation))""")
def f1(spark, sf):
    k = F.col("n_nationkey")
    code = (F.when(k % 5 == 0, F.concat(F.lit("EPSG:"), (k + 26900).cast("string")))
            .when(k % 5 == 1, "4326").when(k % 5 == 2, F.concat(F.lit("epsg:"), (k + 32600).cast("string")))
            .when(k % 5 == 3, "9999").otherwise("2149"))
    rows = ly.table(spark, sf, "nation").select("n_nationkey", code.alias("code"))
    return crs.check_crs(rows, "code")


MERCATOR_SQL = ("round(radians({x})*6378137.0, 3)", "round(ln(tan(pi()/4 + radians({y})/2))*6378137.0, 3)")


@query("f2_reproject_mercator", f"""SELECT site_id, {MERCATOR_SQL[0].format(x='lon')} AS x,
    {MERCATOR_SQL[1].format(y='lat')} AS y FROM ({SITES_SQL})""")
def f2(spark, sf):
    moved = co.reproject(ly.sites(spark, sf), 3857)
    return moved.select("site_id", F.round(spot("geom").x, 3).alias("x"),
                        F.round(spot("geom").y, 3).alias("y"))


@query("f2_reproject_utm", f"""SELECT site_id, round(easting, 3) AS x, round(northing, 3) AS y FROM (
    {utm_sql('lon', 'lat', 2149, f"SELECT * FROM ({SITES_SQL})")})""")
def f2_utm(spark, sf):
    moved = co.reproject(ly.sites(spark, sf), 2149, 4269)
    return moved.select("site_id", F.round(spot("geom").x, 3).alias("x"),
                        F.round(spot("geom").y, 3).alias("y"))


@query("f2_reproject_there_and_back", f"""SELECT catch_id, round(cx - r, 6) AS x, round(cy - r, 6) AS y,
    2149 + catch_id % 2 * 30465 AS epsg FROM ({CATCHMENTS_SQL})""")
def f2_back(spark, sf):
    areas = ly.catchments(spark, sf).withColumn("epsg", F.lit(2149) + F.col("catch_id") % 2 * 30465)
    there = areas.withColumn("geom", F.when(
        F.col("epsg") == 2149, F.expr(crs.reproject_geom("geom", 4326, 2149))
    ).otherwise(F.expr(crs.reproject_geom("geom", 4326, 32614))))
    back = co.reproject(there, 4326, F.col("epsg"))
    return back.select("catch_id", F.round(spot("geom").x, 6).alias("x"),
                       F.round(spot("geom").y, 6).alias("y"), "epsg")


@query("f2_reproject_albers", f"""SELECT site_id, round(easting, 3) AS x, round(northing, 3) AS y FROM (
    {albers_sql('lon', 'lat', SITES_SQL)})""")
def f2_albers(spark, sf):
    moved = co.reproject(ly.sites(spark, sf), "EPSG:5070")
    return moved.select("site_id", F.round(spot("geom").x, 3).alias("x"),
                        F.round(spot("geom").y, 3).alias("y"))


@query("f2_reproject_by_code", f"""SELECT reach_id, e.place, CASE WHEN reach_id % 6 <> 3 THEN round(e.x, 6) END AS x,
    CASE WHEN reach_id % 6 <> 3 THEN round(e.y, 6) END AS y, reach_id % 6 <> 3 AS valid FROM (
    SELECT reach_id, unnest([{{'place': 0, 'x': x0, 'y': y0}}, {{'place': 1, 'x': x1, 'y': y1}},
      {{'place': 2, 'x': x2, 'y': y2}}]) AS e FROM ({REACHES_SQL})) WHERE reach_id % 6 <> 3 OR e.place = 0""")
def f2_by_code(spark, sf):
    """Lines back from the system that each row names; one name is not known."""
    codes = {0: "EPSG:3857", 1: "4326", 2: "epsg:32614", 3: "9999", 4: "EPSG:5070", 5: "2149"}
    k = F.col("reach_id") % 6
    name, there = F.lit(codes[3]), F.col("geom")
    for i, code in codes.items():
        name = F.when(k == i, code).otherwise(name)
        if i != 3:
            there = F.when(k == i, F.expr(crs.reproject_geom("geom", 4326, code))).otherwise(there)
    moved = ly.reaches(spark, sf).withColumn("geom", there).withColumn("code", name)
    back = co.reproject(moved, 4326, F.col("code"), valid="valid")
    lines = back.select("reach_id", "valid", F.posexplode_outer(F.col("geom.parts")[0]).alias("place", "v"))
    return lines.select("reach_id", F.coalesce("place", F.lit(0)).alias("place"), F.round("v.x", 6).alias("x"),
                        F.round("v.y", 6).alias("y"), "valid")


@query("f2_reproject_boxes", f"""SELECT box_id, {MERCATOR_SQL[0].format(x='west')} AS west,
    {MERCATOR_SQL[1].format(y='south')} AS south, {MERCATOR_SQL[0].format(x='east')} AS east,
    {MERCATOR_SQL[1].format(y='north')} AS north FROM ({BOXES_SQL})""")
def f2_boxes(spark, sf):
    sides = ("west", "south", "east", "north")
    moved = ly.boxes(spark, sf).select(
        "box_id", F.expr(crs.reproject_box(*sides, 4326, 3857)).alias("b"))
    return moved.select("box_id", *[F.round(f"b.{s}", 3).alias(s) for s in sides])


@query("f3_snap", f"""SELECT reach_id, floor(x1*{GRID} + 0.5)/{GRID} AS x, floor(y1*{GRID} + 0.5)/{GRID} AS y,
    0 AS collapsed FROM (SELECT reach_id, (x1 + reach_id*0.00000001::DOUBLE) AS x1,
    (y1 - reach_id*0.00000003::DOUBLE) AS y1 FROM ({REACHES_SQL}))""")
def f3(spark, sf):
    drift = f"""transform(geom.parts, p -> transform(p, v -> named_struct(
        'x', v.x + reach_id * 0.00000001D, 'y', v.y - reach_id * 0.00000003D, 'm', v.m)))"""
    moved = ly.reaches(spark, sf).withColumn(
        "geom", F.expr(f"CAST(named_struct('kind', geom.kind, 'parts', {drift}) AS {g.GEOMETRY})"))
    return co.snap(moved).select(
        "reach_id", spot("geom", 0, 1).x.alias("x"), spot("geom", 0, 1).y.alias("y"), "collapsed")


@query("f4_flip_axes", f"""SELECT reach_id, CASE WHEN reach_id % 2 = 0 THEN y2 ELSE x2 END AS x,
    CASE WHEN reach_id % 2 = 0 THEN x2 ELSE y2 END AS y FROM ({REACHES_SQL})""")
def f4(spark, sf):
    flipped = co.flip_axes(ly.reaches(spark, sf), F.col("reach_id") % 2 == 0)
    return flipped.select("reach_id", spot("geom", 0, 2).x.alias("x"), spot("geom", 0, 2).y.alias("y"))


@query("f5_length_m", f"""SELECT reach_id, round(sum(metres), 3) AS length_m FROM ({
    geodesic_sql("x1", "y1", "x2", "y2", REACH_EDGES_SQL)}) GROUP BY reach_id""")
def f5(spark, sf):
    return co.with_length_m(ly.reaches(spark, sf)).select(
        "reach_id", F.round("length_m", 3).alias("length_m"))


@query("f6_geometry_payloads", f"""SELECT 'site' AS layer, site_id AS id, 'esriGeometryPoint' AS geometry_type,
    '4326' AS in_sr, '4326' AS wkid, floor(lon*{GRID} + 0.5)/{GRID} AS x, floor(lat*{GRID} + 0.5)/{GRID} AS y, 1 AS n
    FROM ({SITES_SQL}) UNION ALL SELECT 'catchment', catch_id, 'esriGeometryPolygon', '4326', '4326',
    floor((cx-r)*{GRID} + 0.5)/{GRID}, floor((cy-r)*{GRID} + 0.5)/{GRID}, 6 FROM ({CATCHMENTS_SQL})
    UNION ALL SELECT 'reach', reach_id, 'esriGeometryPolyline', '4326', '4326',
    floor(x0*{GRID} + 0.5)/{GRID}, floor(y0*{GRID} + 0.5)/{GRID}, 3 FROM ({REACHES_SQL})
    UNION ALL SELECT 'box', box_id, 'esriGeometryEnvelope', '4326', '4326',
    floor(west*{GRID} + 0.5)/{GRID}, floor(north*{GRID} + 0.5)/{GRID}, 0 FROM ({BOXES_SQL})""")
def f6(spark, sf):
    shape = ("struct<x:double,y:double,paths:array<array<array<double>>>,rings:array<array<array<double>>>,"
             "xmin:double,ymax:double,spatialReference:struct<wkid:string>>")

    def read(df, layer, key):
        j = F.from_json("geometry", shape)
        path = F.coalesce(j.paths, j.rings)[0]
        return df.select(
            F.lit(layer).alias("layer"), F.col(key).cast("bigint").alias("id"), "geometry_type", "in_sr",
            j.spatialReference.wkid.alias("wkid"),
            F.coalesce(j.x, path[0][0], j.xmin).alias("x"), F.coalesce(j.y, path[0][1], j.ymax).alias("y"),
            F.when(j.x.isNotNull(), 1).when(path.isNotNull(), F.size(path)).otherwise(0).alias("n"))

    return (
        read(co.geometry_payloads(ly.sites(spark, sf)), "site", "site_id")
        .unionByName(read(co.geometry_payloads(ly.catchments(spark, sf)), "catchment", "catch_id"))
        .unionByName(read(co.geometry_payloads(ly.reaches(spark, sf)), "reach", "reach_id"))
        .unionByName(read(co.box_payloads(ly.boxes(spark, sf)), "box", "box_id")))


def _number_sql(value: str) -> str:
    """Text of a number with at least one and at most ten decimals."""
    text = f"rtrim(printf('%.10f', {value}), '0')"
    return f"CASE WHEN {text} LIKE '%.' THEN {text} || '0' ELSE {text} END"


def _pair_sql(x: str, y: str) -> str:
    return f"({_number_sql(y)}) || ' ' || ({_number_sql(x)})"


def _join_sql(pairs: list[tuple[str, str]]) -> str:
    return " || ', ' || ".join(_pair_sql(x, y) for x, y in pairs)


@query("f7_wkt", f"""SELECT reach_id AS id, 'LINESTRING (' || {_join_sql([('x0', 'y0'), ('x1', 'y1'), ('x2', 'y2')])}
    || ')' AS wkt FROM ({REACHES_SQL}) UNION ALL SELECT catch_id, 'POLYGON ((' || {_join_sql([
        ('cx-r', 'cy-r'), ('cx+r', 'cy-r'), ('cx+r', 'cy+r'), ('cx', 'cy+r/2'), ('cx-r', 'cy+r'),
        ('cx-r', 'cy-r')])} || '))' FROM ({CATCHMENTS_SQL})""")
def f7(spark, sf):
    lines = co.with_wkt(ly.reaches(spark, sf)).select(F.col("reach_id").alias("id"), "wkt")
    areas = co.with_wkt(ly.catchments(spark, sf)).select(F.col("catch_id").alias("id"), "wkt")
    return lines.unionByName(areas)


def _corners(role: str) -> list[tuple[str, str]]:
    x, half = ly.BASIN_RINGS[role]
    w, e, s, n = f"{x} - {half}", f"{x} + {half}", f"cy - {half}", f"cy + {half}"
    return [(w, s), (e, s), (e, n), (w, n), (w, s)]


def _ring_sql(role: str) -> str:
    return f"'(' || {_join_sql(_corners(role))} || ')'"


@query("f7_wkt_nested", f"""SELECT basin_id, 'MULTIPOLYGON ((' || {_ring_sql('shell')} || ', ' || {_ring_sql('hole')}
    || '), (' || {_ring_sql('island')} || '), (' || {_ring_sql('second')} || '))' AS wkt FROM ({ly.BASINS_SQL})""")
def f7_nested(spark, sf):
    return co.with_wkt(ly.basins(spark, sf)).select("basin_id", "wkt")


def _vertices_sql(no: int, role: str) -> str:
    spots = _corners(role) if role == "hole" else _corners(role)[::-1]
    return " UNION ALL ".join(
        f"SELECT basin_id, {no} AS ring, {i} AS place, floor(({x})*{GRID} + 0.5)/{GRID} AS x, "
        f"floor(({y})*{GRID} + 0.5)/{GRID} AS y FROM basins" for i, (x, y) in enumerate(spots))


@query("f6_payload_rings", f"WITH basins AS ({ly.BASINS_SQL}) " + " UNION ALL ".join(
    _vertices_sql(i, role) for i, role in enumerate(("shell", "hole", "island", "second"))))
def f6_rings(spark, sf):
    """Every position of the rings sent for areas with holes and islands."""
    sent = co.geometry_payloads(ly.basins(spark, sf)).select("basin_id", F.posexplode(F.from_json(
        "geometry", "struct<rings:array<array<array<double>>>>").rings).alias("ring", "r"))
    return sent.select("basin_id", "ring", F.posexplode("r").alias("place", "v")).select(
        "basin_id", "ring", "place", F.col("v")[0].alias("x"), F.col("v")[1].alias("y"))


@query("f8_box_report", """SELECT o_orderkey, CASE WHEN k = 3 THEN 'not four numbers' WHEN k = 5 THEN
    'south above north' WHEN k = 7 THEN 'west beyond east, may cross the antimeridian' END AS reason
    FROM (SELECT o_orderkey, o_orderkey % 11 AS k FROM orders)""")
def f8(spark, sf):
    k = F.col("o_orderkey") % 11
    rows = ly.table(spark, sf, "orders").select(
        "o_orderkey", F.when(k == 3, "x").when(k == 7, "12.5").otherwise("-10").alias("west"),
        F.when(k == 5, "9").otherwise("1").alias("south"), F.lit("11").alias("east"),
        F.lit("5").alias("north"))
    return tl.box_report(rows).select("o_orderkey", "reason")


def plots(spark, sf):
    """Boxes around the catchments, a table that grows with the data."""
    return ly.catchments(spark, sf).select(
        F.col("catch_id").alias("box_id"), F.col("xmin").alias("west"), F.col("ymin").alias("south"),
        F.col("xmax").alias("east"), F.col("ymax").alias("north"))


PLOTS_SQL = f"""SELECT catch_id AS box_id, xmin AS west, ymin AS south, xmax AS east, ymax AS north
    FROM ({CATCHMENTS_SQL})"""


def size_sql(boxes: str, res: float) -> str:
    """Boxes with width and height in pixels."""
    along = geodesic_sql("west", "south", "east", "south", boxes)
    wide = f"SELECT box_id, west, south, east, north, ceil(metres/{res})::BIGINT AS width FROM ({along})"
    up = geodesic_sql("west", "south", "west", "north", wide)
    return (f"SELECT box_id, west, south, east, north, width, ceil(metres/{res})::BIGINT AS height "
            f"FROM ({up})")


def plan_sql(boxes: str, res: float, max_px: int) -> str:
    """Boxes with their tiling."""
    n = f"ceil(width::DOUBLE*height/{max_px})"
    nx = f"CASE WHEN width*height <= {max_px} THEN 1 ELSE ceil(sqrt({n}*(width::DOUBLE)/height)) END"
    sql = f"SELECT *, ({nx})::BIGINT AS nx FROM ({size_sql(boxes, res)})"
    sql = f"SELECT *, (CASE WHEN width*height <= {max_px} THEN 1 ELSE ceil({n}/nx) END)::BIGINT AS ny FROM ({sql})"
    return (f"SELECT *, (east-west)/nx AS dx, (north-south)/ny AS dy, ceil(width/nx)::BIGINT AS sub_width, "
            f"ceil(height/ny)::BIGINT AS sub_height FROM ({sql})")


@query("g1_pixel_size", f"SELECT box_id, width, height FROM ({size_sql(BOXES_SQL, 30.0)})")
def g1(spark, sf):
    return tl.pixel_size(ly.boxes(spark, sf), 30.0).select("box_id", "width", "height")


@query("g2_decompose", f"""SELECT box_id, ix, iy, ix*ny + iy AS tile_no, round(west + ix*dx, 9) AS west,
    round(south + iy*dy, 9) AS south, round(least(west + (ix+1)*dx, east), 9) AS east,
    round(least(south + (iy+1)*dy, north), 9) AS north, sub_width, sub_height
    FROM (SELECT *, unnest(generate_series(0, ny - 1)) AS iy FROM (
    SELECT *, unnest(generate_series(0, nx - 1)) AS ix FROM ({plan_sql(PLOTS_SQL, 30.0, 1_000_000)})))""")
def g2(spark, sf):
    tiles = tl.decompose(plots(spark, sf), 30.0, max_px=1_000_000)
    return tiles.select("box_id", "ix", "iy", "tile_no", *[
        F.round(c, 9).alias(c) for c in tl.SIDES], "sub_width", "sub_height")


@query("g3_tile_requests", f"""SELECT box_id, layer, layer || '_dd_' || (ix*ny + iy) AS key,
    sub_width::VARCHAR AS width, 'epsg:4326' AS crs, 'default' AS styles,
    round(south + iy*dy, 5) AS first_bound FROM (SELECT *, unnest(generate_series(0, ny - 1)) AS iy FROM (
    SELECT *, unnest(generate_series(0, nx - 1)) AS ix FROM ({plan_sql(PLOTS_SQL, 30.0, 8_000_000)}))),
    (VALUES ('dem'), ('cover')) AS y(layer)""")
def g3(spark, sf):
    asked = tl.tile_requests(
        plots(spark, sf), ["dem", "cover"], 30.0,
        extra={"styles": "default", "crs": "ignored", "bbox": "ignored"})
    p = F.col("params")
    return asked.select(
        "box_id", "layer", "key", p["width"].alias("width"), p["crs"].alias("crs"),
        p["styles"].alias("styles"),
        F.round(F.split(p["bbox"], ",")[0].cast("double"), 5).alias("first_bound"))


PLACED_SQL = f"""SELECT box_id, site_id AS feature_id, acctbal, ix*ny + iy AS tile_no,
    least(floor((lon - (west + ix*dx))/(dx/sub_width)), sub_width - 1)::BIGINT AS px,
    (sub_height - 1 - least(floor((lat - (south + iy*dy))/(dy/sub_height)), sub_height - 1))::BIGINT AS py
    FROM (SELECT *, least(floor((lon - west)/dx), nx - 1)::BIGINT AS ix,
      least(floor((lat - south)/dy), ny - 1)::BIGINT AS iy
      FROM ({plan_sql(PLOTS_SQL, 250.0, 100_000)}) JOIN ({SITES_SQL})
      ON lon >= west AND lon <= east AND lat >= south AND lat <= north)"""


def placed(spark, sf):
    return tl.points_to_tiles(
        ly.sites(spark, sf), SITES, plots(spark, sf), 250.0, 100_000, values=("acctbal",))


@query("g4_points_to_tiles", PLACED_SQL)
def g4(spark, sf):
    return placed(spark, sf)


@query("g5_rasterize", f"""SELECT box_id, tile_no, px, py, count(*) AS n, round(avg(acctbal), 6) AS mean
    FROM ({PLACED_SQL}) GROUP BY 1, 2, 3, 4""")
def g5(spark, sf):
    pixels = tl.rasterize_points(ly.sites(spark, sf), SITES, plots(spark, sf), 250.0, 100_000, "acctbal")
    return pixels.withColumn("mean", F.round("mean", 6))
