"""Pixel-budgeted tiles of boxes, and points counted on their grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geolayer.errors import InputTypeError, InputValueError
from geolayer.functions import crs
from geolayer.functions import geometry as g
from geolayer.functions.pixels import pixel_counts
from geolayer.functions.sql import let
from geolayer.layer import LayerInfo, geometry_column
from geolayer.plans.block_join import points_by_box
from geolayer.plans.spatial_join import candidate_pairs
from geolayer.operators.select import grid_of

# Fixed value: largest number of pixels of one request.
MAX_PIXELS = 8_000_000
SIDES = ("west", "south", "east", "north")
VERSIONS = ("1.1.1", "1.3.0")


def box_report(boxes: DataFrame) -> DataFrame:
    """Add ``reason``: why a row is no usable box, or null."""
    w, s, e, n = (F.col(c).try_cast("double") for c in SIDES)
    bad = [c.isNull() | F.isnan(c) for c in (w, s, e, n)]
    return boxes.withColumn(
        "reason",
        F.when(bad[0] | bad[1] | bad[2] | bad[3], "not four numbers")
        .when(s > n, "south above north")
        .when(w > e, "west beyond east, may cross the antimeridian"),
    )


def pixel_size(boxes: DataFrame, resolution: float, epsg: int = 4326) -> DataFrame:
    """Add ``width`` and ``height`` in pixels of ``resolution`` metres.

    The width is taken along the south side and the height along the west side.
    """
    along = crs.geodesic("_d.west", "_d.south", "_d.east", "_d.south")
    up = crs.geodesic("_d.west", "_d.south", "_d.west", "_d.north")
    return (
        boxes.withColumn("_d", F.expr(crs.reproject_box(*SIDES, epsg, 4326)))
        .withColumn("width", F.ceil(F.expr(along) / resolution))
        .withColumn("height", F.ceil(F.expr(up) / resolution))
        .drop("_d")
    )


def tile_plan(
    boxes: DataFrame, resolution: float, epsg: int = 4326, max_px: int = MAX_PIXELS
) -> DataFrame:
    """One row per box: tiles each way (``nx, ny``), tile steps and tile size in pixels."""
    if resolution <= 0 or max_px < 1:
        raise InputValueError("resolution and max_px", ["above 0"], (resolution, max_px))
    w, h = F.col("width").cast("double"), F.col("height").cast("double")
    pixels = w * h
    needed = F.ceil(pixels / max_px)
    nx = F.when(pixels <= max_px, 1).otherwise(F.ceil(F.sqrt(needed * w / h)))
    ny = F.when(pixels <= max_px, 1).otherwise(F.ceil(needed / F.col("nx")))
    return (
        pixel_size(boxes, resolution, epsg)
        .withColumn("nx", nx.cast("bigint"))
        .withColumn("ny", ny.cast("bigint"))
        .withColumn("dx", (F.col("east") - F.col("west")) / F.col("nx"))
        .withColumn("dy", (F.col("north") - F.col("south")) / F.col("ny"))
        .withColumn("sub_width", F.ceil(w / F.col("nx")))
        .withColumn("sub_height", F.ceil(h / F.col("ny")))
    )


def decompose(
    boxes: DataFrame, resolution: float, epsg: int = 4326, max_px: int = MAX_PIXELS
) -> DataFrame:
    """One row per tile: place (``ix, iy, tile_no``), bounds and size in pixels.

    Tiles run upwards within a column and columns run eastwards; the outer edges are the box's.
    """
    plan = tile_plan(boxes, resolution, epsg, max_px)
    rest = [c for c in boxes.columns if c not in SIDES]
    cells = plan.withColumn("ix", F.explode(F.sequence(F.lit(0), F.col("nx") - 1))).withColumn(
        "iy", F.explode(F.sequence(F.lit(0), F.col("ny") - 1)))
    whole = (F.col("nx") == 1) & (F.col("ny") == 1)

    def edge(low: str, high: str, step: str, i: Column) -> Column:
        return F.when(whole & (i == F.lit(0)), F.col(low)).otherwise(
            F.least(F.col(low) + i * F.col(step), F.col(high)))

    ix, iy = F.col("ix"), F.col("iy")
    return cells.select(
        *rest, "ix", "iy", (ix * F.col("ny") + iy).alias("tile_no"),
        edge("west", "east", "dx", ix).alias("west"),
        edge("south", "north", "dy", iy).alias("south"),
        F.when(whole, F.col("east")).otherwise(
            F.least(F.col("west") + (ix + 1) * F.col("dx"), F.col("east"))).alias("east"),
        F.when(whole, F.col("north")).otherwise(
            F.least(F.col("south") + (iy + 1) * F.col("dy"), F.col("north"))).alias("north"),
        "sub_width", "sub_height",
    )


def number_text(value: str, decimals: int) -> str:
    """Rounded number as plain text with at least one decimal and no trailing zeros."""
    shape = "0.0" + "#" * (decimals - 1)
    return let(f"format_number({g.on_grid(value, decimals)}, '{shape}')",
               lambda t: f"IF({t} = '-0.0', '0.0', {t})")


def tile_requests(
    boxes: DataFrame,
    layers: list[str] | str,
    resolution: float,
    epsg: int = 4326,
    box_crs: int | str = 4326,
    version: str = "1.3.0",
    outformat: str = "image/tiff",
    always_xy: bool = False,
    max_px: int = MAX_PIXELS,
    extra: dict[str, str] | None = None,
) -> DataFrame:
    """One request row per layer and tile with its key and parameter map.

    Boxes are moved to the layer CRS. ``extra`` parameters win over the base ones and lose
    against the CRS and the tile's own. Geographic boxes are written ``south, west, ...`` except in
    version 1.1.1 or with ``always_xy``.
    """
    if version not in VERSIONS:
        raise InputValueError("version", VERSIONS, version)
    if extra is not None and not isinstance(extra, dict):
        raise InputTypeError("extra", "a dict or None")
    layers = [layers] if isinstance(layers, str) else [str(name) for name in layers]
    rest = [c for c in boxes.columns if c not in SIDES]
    moved = boxes.select(*rest, F.expr(crs.reproject_box(
        *SIDES, box_crs, epsg)).alias("_b")).select(*rest, "_b.*")
    tiles = decompose(moved, resolution, epsg, max_px)
    decimals = crs.grid_decimals(epsg)
    order = SIDES
    if version != "1.1.1" and not crs.is_projected(epsg) and not always_xy:
        order = ("south", "west", "north", "east")
    bbox = F.concat_ws(",", *[F.expr(number_text(c, decimals)) for c in order])
    fixed = {
        "version": version, "format": outformat, "request": "GetMap", **(extra or {}),
        ("srs" if version == "1.1.1" else "crs"): crs.validate_crs(epsg),
    }
    for own in ("bbox", "width", "height", "layers"):
        fixed.pop(own, None)
    pairs = [p for k, v in fixed.items() for p in (F.lit(k), F.lit(str(v)))]
    named = tiles.withColumn("layer", F.explode(F.array(*[F.lit(n) for n in layers])))
    return named.withColumn("bbox", bbox).withColumn(
        "key", F.concat(F.col("layer"), F.lit("_dd_"), F.col("tile_no").cast("string"))
    ).withColumn("params", F.create_map(
        *pairs, F.lit("bbox"), F.col("bbox"),
        F.lit("width"), F.col("sub_width").cast("string"),
        F.lit("height"), F.col("sub_height").cast("string"),
        F.lit("layers"), F.col("layer")))


def _points_and_boxes(
    points: DataFrame, info: LayerInfo, boxes: DataFrame, resolution: float, max_px: int, box_id: str,
    values: tuple[str, ...],
) -> tuple[DataFrame, DataFrame]:
    """The two sides of the join of points and boxes with their tiling."""
    plan = tile_plan(boxes, resolution, info.epsg, max_px)
    grid = [*SIDES, "nx", "ny", "dx", "dy", "sub_width", "sub_height"]
    right = plan.select(
        F.col(box_id).alias("id"), F.struct(*grid).alias("grid"),
        F.col("west").alias("xmin"), F.col("south").alias("ymin"),
        F.col("east").alias("xmax"), F.col("north").alias("ymax"),
        F.lit(5).alias("_nv"), F.xxhash64(box_id).alias("_salt"))
    if not set(g.BBOX) <= set(points.columns):
        points = g.with_bbox(points, geometry_column(points, info))
    left = points.where(F.col("xmin") == F.col("xmax")).where(
        F.col("ymin") == F.col("ymax")).select(
        F.col(info.id_col).alias("id"), *values, *g.BBOX, F.xxhash64(info.id_col).alias("_salt"))
    return left, right


def points_to_tiles(
    points: DataFrame,
    info: LayerInfo,
    boxes: DataFrame,
    resolution: float,
    max_px: int = MAX_PIXELS,
    box_id: str = "box_id",
    values: tuple[str, ...] = (),
    cell: float | None = None,
) -> DataFrame:
    """Tile and pixel of every point in every box that holds it.

    Tiles and pixels hold their west and south edges; the outer east and north edges of a box
    belong to its last tiles. Pixel rows count from the top. Boxes are found by grid cell, the
    tile then follows by arithmetic, so tiles are never joined.
    """
    left, right = _points_and_boxes(points, info, boxes, resolution, max_px, box_id, values)
    side, finest = grid_of(info.epsg, cell)
    pairs = candidate_pairs(left, right, side, None, True, finest)
    b, x, y = F.col("r_grid"), F.col("l_xmin"), F.col("l_ymin")

    def step(offset: Column, size: Column, last: Column) -> Column:
        return F.least(F.floor(offset / size), last - 1)

    tiles = pairs.withColumn("ix", step(x - b.west, b.dx, b.nx)).withColumn(
        "iy", step(y - b.south, b.dy, b.ny))
    px = step(x - (b.west + F.col("ix") * b.dx), b.dx / b.sub_width, b.sub_width)
    row = step(y - (b.south + F.col("iy") * b.dy), b.dy / b.sub_height, b.sub_height)
    return tiles.select(
        F.col("r_id").alias(box_id), F.col("l_id").alias("feature_id"),
        (F.col("ix") * b.ny + F.col("iy")).alias("tile_no"),
        F.greatest(px, F.lit(0)).alias("px"),
        F.greatest(b.sub_height - 1 - row, F.lit(0)).alias("py"),
        *[F.col("l_" + v).alias(v) for v in values])


def rasterize(
    placed: DataFrame, value: str | None = None, box_id: str = "box_id"
) -> DataFrame:
    """Count, and mean of ``value``, of the points of each pixel."""
    aggs = [F.count(F.lit(1)).alias("n")]
    if value:
        aggs.append(F.avg(value).alias("mean"))
    return placed.groupBy(box_id, "tile_no", "px", "py").agg(*aggs)


def rasterize_points(
    points: DataFrame,
    info: LayerInfo,
    boxes: DataFrame,
    resolution: float,
    max_px: int = MAX_PIXELS,
    value: str | None = None,
    box_id: str = "box_id",
    cell: float | None = None,
) -> DataFrame:
    """``rasterize(points_to_tiles(...))`` without a shuffle of the placed points.

    The points of a box come together (``points_by_box``), so its pixels are counted where they are placed. Only
    boxes whose points lie in several blocks are summed up by a shuffle of their counted pixels. ``value`` is taken as a double.
    """
    left, right = _points_and_boxes(points, info, boxes, resolution, max_px, box_id, (value,) if value else ())
    mean = F.col(value).cast("double") if value else F.lit(None).cast("double")
    left = left.select(mean.alias("value"), *g.BBOX, "_salt")
    right = right.select("id", "grid.*", *g.BBOX, "_salt")
    side, finest = grid_of(info.epsg, cell)
    schema = T.StructType([
        T.StructField("id", right.schema["id"].dataType), *[T.StructField(c, T.LongType()) for c in (
            "tile_no", "px", "py", "n", "n_value")], T.StructField("total", T.DoubleType())])
    counted, any_split = points_by_box(left, right, side, finest, pixel_counts, schema)
    keys = ["id", "tile_no", "px", "py"]
    pixels = counted.where("NOT _split").drop("_split") if any_split else counted.drop("_split")
    if any_split:
        parts = counted.where("_split").groupBy(*keys)
        pixels = pixels.unionByName(parts.agg(*[F.sum(c).alias(c) for c in ("n", "n_value", "total")]))
    means = [F.expr("IF(n_value > 0, total / n_value, NULL)").alias("mean")] if value else []
    return pixels.select(F.col("id").alias(box_id), "tile_no", "px", "py", "n", *means)
