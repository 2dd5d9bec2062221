"""Geometry as a struct of vertex arrays, built and read with column functions.

A point is one part with one vertex, a multipoint one part per point, a line one part per
path. A polygon is a list of closed rings read by the even-odd rule, so holes and several
shells need no nesting; ``rings.polygons`` finds it for text forms that do.

Constructors take columns; what transforms a whole geometry is SQL text for ``F.expr``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geolayer.errors import InputTypeError
from geolayer.functions.rings import polygons
from geolayer.functions.sql import each, let, num, struct

VERTEX = "struct<x:double,y:double,m:double>"
GEOMETRY = f"struct<kind:string,parts:array<array<{VERTEX}>>>"
BBOX = ("xmin", "ymin", "xmax", "ymax")
KINDS = ("point", "multipoint", "line", "multiline", "polygon", "multipolygon")
AREAS = ("polygon", "multipolygon")
LINES = ("line", "multiline")


def one_of(kind: str, names: tuple[str, ...]) -> str:
    """Test of a kind."""
    return f"{kind} IN (" + ", ".join(f"'{n}'" for n in names) + ")"


def is_area(geom: str) -> str:
    """Test for polygons."""
    return one_of(f"{geom}.kind", AREAS)


def n_vertices(geom: str) -> str:
    """Number of vertices, 0 for a null geometry."""
    return f"coalesce(size(flatten({geom}.parts)), 0)"


def vertex(x: Column, y: Column, m: Column | None = None) -> Column:
    """One vertex."""
    measure = F.lit(None).cast("double") if m is None else m.cast("double")
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"), measure.alias("m"))


def geometry(kind: str | Column, parts: Column) -> Column:
    """Geometry struct of a kind and its parts."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return F.struct(kind.alias("kind"), parts.alias("parts")).cast(GEOMETRY)


def point(x: Column, y: Column) -> Column:
    """Point geometry."""
    return geometry("point", F.array(F.array(vertex(x, y))))


def line(*vertices: Column) -> Column:
    """Line through the given vertices."""
    return geometry("line", F.array(F.array(*vertices)))


def polygon(*vertices: Column) -> Column:
    """Polygon of one ring, closed here."""
    return geometry("polygon", F.array(F.array(*vertices, vertices[0])))


def box(west: Column, south: Column, east: Column, north: Column) -> Column:
    """Rectangle as a polygon."""
    return polygon(
        vertex(west, south), vertex(east, south), vertex(east, north), vertex(west, north)
    )


def vertex_text(x: str, y: str, m: str = "CAST(NULL AS DOUBLE)") -> str:
    """One vertex, as text."""
    return struct(x=x, y=y, m=m)


def envelope(geom: str) -> str:
    """Bounding box struct; null for a null or empty geometry."""
    return let(f"flatten({geom}.parts)", lambda v: struct(
        xmin=f"array_min({v}.x)", ymin=f"array_min({v}.y)",
        xmax=f"array_max({v}.x)", ymax=f"array_max({v}.y)"))


def with_bbox(df: DataFrame, geom: str = "geom") -> DataFrame:
    """Add plain ``xmin, ymin, xmax, ymax`` columns, which Parquet statistics can prune on."""
    kept = [c for c in df.columns if c not in BBOX]
    return df.select(*kept, F.expr(envelope(geom)).alias("_env")).select(
        *kept, *[F.col(f"_env.{b}").alias(b) for b in BBOX])


def map_vertices(geom: str, fn: Callable[[str], str]) -> str:
    """Apply ``fn`` to every vertex."""
    parts = each(f"{geom}.parts", lambda p: each(p, fn, "v"), "p")
    moved = struct(kind=f"{geom}.kind", parts=parts)
    return f"IF({geom} IS NULL, NULL, CAST({moved} AS {GEOMETRY}))"


def flip(geom: str) -> str:
    """Swap x and y of every vertex."""
    return map_vertices(geom, lambda v: vertex_text(f"{v}.y", f"{v}.x", f"{v}.m"))


def drop_measure(geom: str) -> str:
    """Null out the measure of every vertex."""
    return map_vertices(geom, lambda v: vertex_text(f"{v}.x", f"{v}.y"))


def on_grid(value: str, decimals: int) -> str:
    """Nearest multiple of ``10**-decimals``, halves up; not-a-number stays what it is."""
    scale = num(10**decimals)
    return f"if(isnan({value}), {value}, floor({value} * {scale} + 0.5D) / {scale})"


def snap(geom: str, decimals: int) -> str:
    """Snap vertices to the grid, drop repeated neighbours, drop parts that collapse.

    A ring needs four vertices and a path two; topology is not repaired.
    """
    least = (f"CASE WHEN {one_of(f'{geom}.kind', AREAS)} THEN 4 "
             f"WHEN {one_of(f'{geom}.kind', LINES)} THEN 2 ELSE 1 END")

    def tidy(part: str) -> str:
        grid = each(part, lambda v: vertex_text(
            on_grid(f"{v}.x", decimals), on_grid(f"{v}.y", decimals), f"{v}.m"), "v")
        return let(grid, lambda g: (
            f"filter({g}, (v, i) -> i = 0 OR v.x != get({g}, i - 1).x OR v.y != get({g}, i - 1).y)"))

    parts = f"filter({each(f'{geom}.parts', tidy, 'p')}, p -> size(p) >= {least})"
    return (f"IF({geom} IS NULL, NULL, CAST({struct(kind=f'{geom}.kind', parts=parts)} "
            f"AS {GEOMETRY}))")


def as_geometry(value: object) -> tuple[str, list[list[tuple[float, float, float | None]]]]:
    """Kind and parts of a geometry given as a Python value.

    ``(x, y)`` is a point, ``[(x, y), ...]`` a multipoint, ``(west, south, east, north)`` a
    box, and ``{"kind": ..., "parts": [[(x, y), ...], ...]}`` anything else. Rings are closed.
    """
    def number(v: object) -> bool:
        return isinstance(v, (int, float)) and not isinstance(v, bool)

    def vert(v: object) -> tuple[float, float, float | None]:
        if isinstance(v, (tuple, list)) and len(v) in (2, 3) and all(map(number, v)):
            return (float(v[0]), float(v[1]), float(v[2]) if len(v) == 3 else None)
        raise InputTypeError("geom", "made of (x, y) pairs", "(-70.02, 44.43)")

    if isinstance(value, dict) and value.get("kind") in KINDS and value.get("parts"):
        parts = [[vert(v) for v in part] for part in value["parts"]]
        if value["kind"] in AREAS:
            parts = [p if p[0][:2] == p[-1][:2] else [*p, p[0]] for p in parts]
        return value["kind"], parts
    if isinstance(value, tuple) and len(value) == 2 and all(map(number, value)):
        return "point", [[vert(value)]]
    if isinstance(value, tuple) and len(value) == 4 and all(map(number, value)):
        w, s, e, n = map(float, value)
        ring = [(w, s), (e, s), (e, n), (w, n), (w, s)]
        return "polygon", [[vert(v) for v in ring]]
    if isinstance(value, list) and value:
        return "multipoint", [[vert(v)] for v in value]
    raise InputTypeError(
        "geom", "a point, a list of points, a line, a polygon or a box", "(x, y)"
    )


def literal_table(spark: SparkSession, geom: object, query_id: int = 0) -> DataFrame:
    """One-row query table ``(query_id, geom)`` of a geometry given as a Python value."""
    return spark.createDataFrame(
        [(query_id, as_geometry(geom))], f"query_id bigint, geom {GEOMETRY}"
    )


def wkt(geom: str, yx: bool = False) -> str:
    """Text form, ``y x`` order if asked.

    Rings are grouped to shells with their holes, so a polygon of several shells is written as a
    multipolygon. Positions keep their order.
    """
    def number(c: str) -> str:
        return f"regexp_replace(format_number({c}, '0.0#########'), '^-(0[.]0)$', '$1')"

    def pair(v: str) -> str:
        first, second = (f"{v}.y", f"{v}.x") if yx else (f"{v}.x", f"{v}.y")
        return f"concat({number(first)}, ' ', {number(second)})"

    def coords(part: str) -> str:
        return f"array_join({each(part, pair, 'v')}, ', ')"

    def listed(parts: str) -> str:
        items = each(parts, lambda p: f"concat('(', {coords(p)}, ')')", "p")
        return f"array_join({items}, ', ')"

    def areas(groups: str) -> str:
        texts = each(groups, lambda p: f"concat('(', {listed(p)}, ')')")
        return let(texts, lambda t: (
            f"IF({geom}.kind = 'polygon' AND size({t}) = 1, concat('POLYGON ', get({t}, 0)), "
            f"concat('MULTIPOLYGON (', array_join({t}, ', '), ')'))"))

    bare = coords(f"flatten({geom}.parts)")
    return f"""CASE WHEN {geom}.kind = 'point' THEN concat('POINT (', {bare}, ')')
        WHEN {geom}.kind = 'multipoint' THEN concat('MULTIPOINT (', {listed(f'{geom}.parts')}, ')')
        WHEN {geom}.kind = 'line' THEN concat('LINESTRING (', {bare}, ')')
        WHEN {geom}.kind = 'multiline' THEN concat('MULTILINESTRING (', {listed(f'{geom}.parts')}, ')')
        WHEN {is_area(geom)} THEN {let(polygons(f'{geom}.parts'), areas)} END"""
