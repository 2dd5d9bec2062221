"""Layers derived from the driver tables, in Spark and as SQL text for the comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geolayer.functions import geometry as g
from geolayer.layer import LayerInfo
from geolayer.plans.bounded import spread_small

SITES = LayerInfo("site_id", kind="point")
CATCHMENTS = LayerInfo("catch_id", kind="polygon")
REACHES = LayerInfo("reach_id", kind="line")
PARCELS = LayerInfo("parcel_id", kind="polygon")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def sites(spark: SparkSession, sf: str) -> DataFrame:
    """Points of the customers."""
    k = F.col("c_custkey")
    return table(spark, sf, "customer").select(
        k.alias("site_id"), F.col("c_nationkey").alias("nation_id"),
        F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("segment"),
        (F.lit(-125) + ((k * 7919) % 58000) / 1000).alias("lon"),
        (F.lit(25) + ((k * 104729) % 24000) / 1000).alias("lat"),
    ).withColumn("geom", g.point(F.col("lon"), F.col("lat"))).withColumns({
        "xmin": F.col("lon"), "ymin": F.col("lat"), "xmax": F.col("lon"), "ymax": F.col("lat")})


SITES_SQL = """SELECT c_custkey AS site_id, c_nationkey AS nation_id, c_acctbal AS acctbal,
    c_mktsegment AS segment, -125 + ((c_custkey*7919) % 58000)/1000 AS lon,
    25 + ((c_custkey*104729) % 24000)/1000 AS lat FROM customer"""


def boxes(spark: SparkSession, sf: str) -> DataFrame:
    """Five by five cells of the nations."""
    k = F.col("n_nationkey")
    return (
        table(spark, sf, "nation")
        .select(k.alias("box_id"), F.col("n_name").alias("box_name"),
                (F.lit(-125.0005) + (k % 5) * F.lit(11.6)).alias("west"),
                (F.lit(25.0005) + F.floor(k / 5) * F.lit(4.8)).alias("south"))
        .withColumn("east", F.col("west") + 11.6)
        .withColumn("north", F.col("south") + 4.8)
        .withColumn("geom", g.box(F.col("west"), F.col("south"), F.col("east"), F.col("north")))
    )


BOXES_SQL = """SELECT *, west + 11.6::DOUBLE AS east, south + 4.8::DOUBLE AS north FROM (
    SELECT n_nationkey AS box_id, n_name AS box_name,
    (-125.0005)::DOUBLE + (n_nationkey % 5) * 11.6::DOUBLE AS west,
    25.0005::DOUBLE + (n_nationkey // 5) * 4.8::DOUBLE AS south FROM nation)"""


def catchments(spark: SparkSession, sf: str) -> DataFrame:
    """Concave polygons of the suppliers: a square with a notch in its north side."""
    k = F.col("s_suppkey")
    cx, cy, r = F.col("cx"), F.col("cy"), F.col("r")
    ring = g.polygon(
        g.vertex(cx - r, cy - r), g.vertex(cx + r, cy - r), g.vertex(cx + r, cy + r),
        g.vertex(cx, cy + r / 2), g.vertex(cx - r, cy + r))
    return table(spark, sf, "supplier").select(
        k.alias("catch_id"), F.col("s_acctbal").alias("acctbal"),
        (F.lit(-124) + ((k * 3571) % 56000) / 1000 + F.lit(0.0005)).alias("cx"),
        (F.lit(26) + ((k * 1237) % 22000) / 1000 + F.lit(0.0005)).alias("cy"),
        (F.lit(0.5) + (k % 4) * F.lit(0.25)).alias("r"),
    ).withColumn("geom", ring).withColumns({
        "xmin": cx - r, "ymin": cy - r, "xmax": cx + r, "ymax": cy + r})


CATCHMENTS_SQL = """SELECT *, cx - r AS xmin, cy - r AS ymin, cx + r AS xmax, cy + r AS ymax FROM (
    SELECT s_suppkey AS catch_id, s_acctbal AS acctbal,
    -124 + ((s_suppkey*3571) % 56000)/1000 + 0.0005::DOUBLE AS cx,
    26 + ((s_suppkey*1237) % 22000)/1000 + 0.0005::DOUBLE AS cy,
    0.5::DOUBLE + (s_suppkey % 4) * 0.25::DOUBLE AS r FROM supplier)"""

# Edges of every catchment: five rows each.
CATCHMENT_EDGES_SQL = f"""SELECT catch_id, e.x1, e.y1, e.x2, e.y2 FROM ({CATCHMENTS_SQL}),
    LATERAL (SELECT unnest([
      {{'x1':cx-r,'y1':cy-r,'x2':cx+r,'y2':cy-r}}, {{'x1':cx+r,'y1':cy-r,'x2':cx+r,'y2':cy+r}},
      {{'x1':cx+r,'y1':cy+r,'x2':cx,'y2':cy+r/2}}, {{'x1':cx,'y1':cy+r/2,'x2':cx-r,'y2':cy+r}},
      {{'x1':cx-r,'y1':cy+r,'x2':cx-r,'y2':cy-r}}]) AS e)"""

def long_catchments(spark: SparkSession, sf: str, steps: int = 600) -> DataFrame:
    """The catchments with ``steps`` vertices on every edge, as drawn shore lines have."""
    def between(c: str) -> str:
        return f"v.{c} + (get(geom.parts[0], i + 1).{c} - v.{c}) * j / {steps}D"

    vertex = f"named_struct('x', {between('x')}, 'y', {between('y')}, 'm', CAST(NULL AS DOUBLE))"
    edges = (f"flatten(transform(slice(geom.parts[0], 1, size(geom.parts[0]) - 1), (v, i) -> "
             f"transform(sequence(0, {steps - 1}), j -> {vertex})))")
    ring = f"array(concat({edges}, slice(geom.parts[0], -1, 1)))"
    # Spread before the vertices are made: the table is a small file, and its rings are not.
    return spread_small(catchments(spark, sf), "catch_id").withColumn(
        "geom", F.expr(f"CAST(named_struct('kind', 'polygon', 'parts', {ring}) AS {g.GEOMETRY})"))


# The same in whole numbers of 1/8000 degree, so that edge tests are exact.
CATCHMENT_GRID_SQL = """SELECT catch_id, e.x1, e.y1, e.x2, e.y2 FROM (
    SELECT s_suppkey AS catch_id, (-124000 + (s_suppkey*3571) % 56000)*8 + 4 AS cx,
    (26000 + (s_suppkey*1237) % 22000)*8 + 4 AS cy, 4000 + (s_suppkey % 4)*2000 AS r FROM supplier),
    LATERAL (SELECT unnest([
      {'x1':cx-r,'y1':cy-r,'x2':cx+r,'y2':cy-r}, {'x1':cx+r,'y1':cy-r,'x2':cx+r,'y2':cy+r},
      {'x1':cx+r,'y1':cy+r,'x2':cx,'y2':cy+r//2}, {'x1':cx,'y1':cy+r//2,'x2':cx-r,'y2':cy+r},
      {'x1':cx-r,'y1':cy+r,'x2':cx-r,'y2':cy-r}]) AS e)"""


def reaches(spark: SparkSession, sf: str) -> DataFrame:
    """Lines with a measure, of the parts."""
    k = F.col("p_partkey")
    x, y = F.col("x0"), F.col("y0")
    return table(spark, sf, "part").select(
        k.alias("reach_id"), F.col("p_name").alias("name"), F.col("p_type").alias("ftype"),
        F.col("p_size").alias("size"),
        (F.lit(-124) + ((k * 4241) % 55000) / 1000 + F.lit(0.0003)).alias("x0"),
        (F.lit(26) + ((k * 2903) % 21000) / 1000 + F.lit(0.0003)).alias("y0"),
    ).withColumn("geom", g.line(
        g.vertex(x, y, F.lit(0)), g.vertex(x + 0.4, y + 0.3, F.lit(50)),
        g.vertex(x + 0.9, y + F.lit(0.1) * (F.col("reach_id") % 7), F.lit(100))))


REACHES_SQL = """SELECT *, x0 + 0.4::DOUBLE AS x1, y0 + 0.3::DOUBLE AS y1, x0 + 0.9::DOUBLE AS x2,
    y0 + 0.1::DOUBLE*(reach_id % 7) AS y2 FROM (
    SELECT p_partkey AS reach_id, p_name AS name, p_type AS ftype, p_size AS size,
    -124 + ((p_partkey*4241) % 55000)/1000 + 0.0003::DOUBLE AS x0,
    26 + ((p_partkey*2903) % 21000)/1000 + 0.0003::DOUBLE AS y0 FROM part)"""

REACH_EDGES_SQL = f"""SELECT reach_id, x0 AS x1, y0 AS y1, x1 AS x2, y1 AS y2 FROM ({REACHES_SQL})
    UNION ALL SELECT reach_id, x1, y1, x2, y2 FROM ({REACHES_SQL})"""

# Whole numbers of 1/10000 degree.
REACH_GRID_SQL = """SELECT reach_id, e.x1, e.y1, e.x2, e.y2 FROM (
    SELECT p_partkey AS reach_id, (-124000 + (p_partkey*4241) % 55000)*10 + 3 AS x,
    (26000 + (p_partkey*2903) % 21000)*10 + 3 AS y, 1000*(p_partkey % 7) AS dy FROM part),
    LATERAL (SELECT unnest([{'x1':x,'y1':y,'x2':x+4000,'y2':y+3000},
      {'x1':x+4000,'y1':y+3000,'x2':x+9000,'y2':y+dy}]) AS e)"""


def parcels(spark: SparkSession, sf: str) -> DataFrame:
    """Squares of 0.01 degrees side by side in rows of fifty, of the customers."""
    k = F.col("c_custkey")
    w = F.lit(-120.0) + (k % 50) * F.lit(0.01)
    s = F.lit(30.0) + F.floor(k / 50) * F.lit(0.01)
    return table(spark, sf, "customer").select(
        k.alias("parcel_id"), F.col("c_mktsegment").alias("segment"),
        g.box(w, s, w + 0.01, s + 0.01).alias("geom"))


PARCELS_SQL = """SELECT c_custkey AS parcel_id, c_mktsegment AS segment, c_custkey % 50 AS col,
    c_custkey // 50 AS row FROM customer"""


def basins(spark: SparkSession, sf: str) -> DataFrame:
    """Areas of the suppliers: a hole, its shell, an island in the hole, and a second shell."""
    k, cx, cy, r = F.col("s_suppkey"), F.col("cx"), F.col("cy"), F.col("r")

    def square(x, half):
        return g.box(x - half, cy - half, x + half, cy + half).parts[0]

    return table(spark, sf, "supplier").select(
        k.alias("basin_id"),
        (F.lit(-124) + ((k * 3571) % 56000) / 1000 + F.lit(0.0005)).alias("cx"),
        (F.lit(26) + ((k * 1237) % 22000) / 1000 + F.lit(0.0005)).alias("cy"),
        (F.lit(0.5) + (k % 4) * F.lit(0.25)).alias("r"),
    ).withColumn("geom", g.geometry("multipolygon", F.array(
        square(cx, r / 2), square(cx, r), square(cx, r / 5), square(cx + r * 2, r / 2))))


# Centre and half width of the rings by role.
BASIN_RINGS = {"hole": ("cx", "r/2"), "shell": ("cx", "r"), "island": ("cx", "r/5"), "second": ("(cx + r*2)", "r/2")}
BASINS_SQL = """SELECT s_suppkey AS basin_id, -124 + ((s_suppkey*3571) % 56000)/1000 + 0.0005::DOUBLE AS cx,
    26 + ((s_suppkey*1237) % 22000)/1000 + 0.0005::DOUBLE AS cy, 0.5::DOUBLE + (s_suppkey % 4) * 0.25::DOUBLE AS r
    FROM supplier"""


def as_queries(df: DataFrame, key: str) -> DataFrame:
    """Query table of a layer."""
    return df.select(F.col(key).alias("query_id"), "geom")
