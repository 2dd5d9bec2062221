"""Coordinates of geometry tables: CRS, precision, axis order, length and text encodings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geolayer.functions import crs
from geolayer.functions import geometry as g
from geolayer.functions import rings
from geolayer.functions.sql import each, each_indexed, let, struct

# Geometry type names of the service.
TYPE_NAMES = {
    "point": "esriGeometryPoint", "multipoint": "esriGeometryMultipoint",
    "line": "esriGeometryPolyline", "multiline": "esriGeometryPolyline",
    "polygon": "esriGeometryPolygon", "multipolygon": "esriGeometryPolygon",
    "envelope": "esriGeometryEnvelope",
}
PAYLOAD_DECIMALS = 6


def _reference(epsg: int) -> str:
    return struct(wkid=f"'{epsg}'")


def geometry_payloads(
    df: DataFrame, geom: str = "geom", in_crs: int | str = 4326, out_crs: int | str = 4326
) -> DataFrame:
    """Add ``geometry_type, geometry, in_sr``: moved to the layer CRS, snapped, as JSON.

    Every ring is sent, so holes are kept: shells run clockwise and holes counterclockwise, which is
    how a service tells them apart.
    """
    epsg = crs.parse_crs(out_crs)
    def pairs(parts: str) -> str:
        return each(parts, lambda p: each(p, lambda v: f"array({v}.x, {v}.y)"))

    paths = pairs("_shape.parts")
    turned = each(rings.polygons("_shape.parts"), lambda area: each_indexed(area, lambda r, i: (
        f"IF({i} = 0, {rings.oriented(r, True)}, {rings.oriented(r, False)})")))

    def body(**fields: str) -> str:
        return f"to_json({struct(**fields, spatialReference=_reference(epsg))})"

    first = "get(get(_shape.parts, 0), 0)"
    text = f"""CASE WHEN _shape.kind = 'point' THEN {body(x=f'{first}.x', y=f'{first}.y')}
        WHEN _shape.kind = 'multipoint' THEN {body(points=f'flatten({paths})')}
        WHEN {g.one_of('_shape.kind', g.LINES)} THEN {body(paths=paths)}
        WHEN {g.one_of('_shape.kind', g.AREAS)} THEN {body(rings=pairs(f'flatten({turned})'))} END"""
    names = F.create_map(*[F.lit(t) for kv in TYPE_NAMES.items() for t in kv])
    return (
        df.withColumn("_shape", F.expr(crs.reproject_geom(geom, in_crs, out_crs)))
        .withColumn("_shape", F.expr(g.snap("_shape", PAYLOAD_DECIMALS)))
        .withColumn("geometry_type", names[F.col("_shape.kind")])
        .withColumn("geometry", F.expr(text))
        .withColumn("in_sr", F.lit(str(epsg)))
        .drop("_shape")
    )


def box_payloads(
    df: DataFrame, in_crs: int | str = 4326, out_crs: int | str = 4326
) -> DataFrame:
    """The same columns for a table of boxes ``west, south, east, north``."""
    epsg = crs.parse_crs(out_crs)
    sides = ("west", "south", "east", "north")
    bounds = {n: g.on_grid(f"_box.{s}", PAYLOAD_DECIMALS) for s, n in zip(sides, g.BBOX)}
    return (
        df.withColumn("_box", F.expr(crs.reproject_box(*sides, in_crs, out_crs)))
        .withColumn("geometry_type", F.lit(TYPE_NAMES["envelope"]))
        .withColumn("geometry", F.expr(
            f"to_json({struct(**bounds, spatialReference=_reference(epsg))})"))
        .withColumn("in_sr", F.lit(str(epsg)))
        .drop("_box")
    )


def with_wkt(df: DataFrame, epsg: int = 4326, always_xy: bool = False, geom: str = "geom") -> DataFrame:
    """Add ``wkt``; ``y x`` for a geographic layer unless ``always_xy``."""
    flipped = not crs.is_projected(epsg) and not always_xy
    return df.withColumn("wkt", F.expr(g.wkt(geom, yx=flipped)))


def with_length_m(df: DataFrame, geom: str = "geom", epsg: int = 4326) -> DataFrame:
    """Add ``length_m``: geodesic length over the segments of every part."""
    def part(p: str) -> str:
        heads = f"slice({p}, 1, greatest(size({p}) - 1, 0))"
        return each_indexed(heads, lambda v, i: let(f"get({p}, {i} + 1)", lambda w: crs.geodesic(
            f"{v}.x", f"{v}.y", f"{w}.x", f"{w}.y")))

    steps = f"flatten({each('_line.parts', part)})"
    total = f"aggregate({steps}, 0.0D, (total, step) -> total + step)"
    moved = df.withColumn("_line", F.expr(crs.reproject_geom(geom, epsg, 4326)))
    return moved.withColumn("length_m", F.expr(total)).drop("_line")


def flip_axes(df: DataFrame, when: Column | bool = True, geom: str = "geom") -> DataFrame:
    """Swap x and y of the geometry where ``when`` holds."""
    if isinstance(when, bool):
        return df.withColumn(geom, F.expr(g.flip(geom))) if when else df
    return df.withColumn(geom, F.when(when, F.expr(g.flip(geom))).otherwise(F.col(geom)))


def yx_order(
    epsg: int, always_xy: bool = False, tile_version: str | None = None
) -> bool:
    """Whether a service wants ``y, x``: geographic, not overruled, and no 1.1.1 tile request."""
    return not crs.is_projected(epsg) and not always_xy and tile_version != "1.1.1"


def reproject(
    df: DataFrame, out_crs: int | str, in_crs: int | str | Column = 4326, geom: str = "geom",
    valid: str | None = None,
) -> DataFrame:
    """Geometry column in another CRS; ``in_crs`` may be a column of codes, numbers or ``epsg:n`` texts.

    With a column, rows whose code is not supported become null; ``valid`` names a column that tells
    them from rows without a geometry. Nothing is read while the plan is built.
    """
    if not isinstance(in_crs, Column):
        moved = df.withColumn(geom, F.expr(crs.reproject_geom(geom, in_crs, out_crs)))
        return moved if valid is None else moved.withColumn(valid, F.lit(True))
    coded = df.withColumn("_code", crs.code_number(in_crs))
    moved = coded.withColumn(geom, F.expr(crs.reproject_by_code(geom, "_code", out_crs)))
    if valid is not None:
        known = F.col("_code").isin(crs.supported_codes())
        moved = moved.withColumn(valid, F.coalesce(known, F.lit(False)))
    return moved.drop("_code")


def snap(df: DataFrame, epsg: int = 4326, geom: str = "geom", payload: bool = False) -> DataFrame:
    """Snap to the grid of the CRS; add ``collapsed``, the number of parts lost.

    ``payload`` uses the six decimals of query payloads whatever the CRS.
    """
    decimals = PAYLOAD_DECIMALS if payload else crs.grid_decimals(epsg)
    out = df.withColumn("_snapped", F.expr(g.snap(geom, decimals)))
    lost = F.size(F.col(f"{geom}.parts")) - F.size(F.col("_snapped.parts"))
    return out.withColumn("collapsed", lost).withColumn(geom, F.col("_snapped")).drop("_snapped")
