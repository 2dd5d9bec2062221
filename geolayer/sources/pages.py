"""Features from reply pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geolayer.functions import geometry as g
from geolayer.functions.rings import polygons

_PAIRS = "array<array<double>>"


def _verts(pairs: Column, has_z: Column | None = None, has_m: Column | None = None) -> Column:
    """Positions of one list; a measure is read only if the flags are given."""
    def measure(p: Column) -> Column | None:
        if has_z is None:
            return None
        after_height = has_z | (F.size(p) > 3)
        m = F.when(F.coalesce(after_height, F.lit(False)), F.get(p, F.lit(3))).otherwise(F.get(p, F.lit(2)))
        return F.when(F.coalesce(has_m, F.lit(True)), m)

    return F.transform(pairs, lambda p: g.vertex(F.get(p, F.lit(0)), F.get(p, F.lit(1)), measure(p)))


def _rings(parts: Column, *flags: Column) -> Column:
    return F.transform(parts, lambda p: _verts(p, *flags))


def _spots(pairs: Column, *flags: Column) -> Column:
    return F.transform(_verts(pairs, *flags), lambda v: F.array(v))


def esri_geometry(
    shape: Column, has_z: Column | None = None, has_m: Column | None = None
) -> Column:
    """Geometry of an Esri JSON shape; flags of the shape come before those of its page.

    A measure is the third number of a position, or the fourth if heights are sent as well. Without
    flags, the third of three numbers counts as a measure.
    """
    unknown = F.lit(None).cast("boolean")
    has_z = F.coalesce(shape.hasZ, unknown if has_z is None else has_z)
    has_m = F.coalesce(shape.hasM, unknown if has_m is None else has_m)

    many = F.size(shape.paths) > 1
    return (
        F.when(shape.x.isNotNull(), g.geometry("point", F.array(F.array(
            g.vertex(shape.x, shape.y, shape.m)))))
        .when(shape.points.isNotNull(), g.geometry("multipoint", _spots(shape.points, has_z, has_m)))
        .when(shape.paths.isNotNull(), g.geometry(
            F.when(many, "multiline").otherwise("line"), _rings(shape.paths, has_z, has_m)))
        .when(shape.rings.isNotNull(), g.geometry("polygon", _rings(shape.rings, has_z, has_m)))
    )


def geojson_geometry(shape: Column) -> Column:
    """Geometry of a GeoJSON shape, whose coordinates are still text; heights are not kept."""
    def parse(schema: str) -> Column:
        return F.from_json(shape.coordinates, schema)

    kind = shape.type
    return (
        F.when(kind == "Point", g.geometry("point", _spots(F.array(parse("array<double>")))))
        .when(kind == "MultiPoint", g.geometry("multipoint", _spots(parse(_PAIRS))))
        .when(kind == "LineString", g.geometry("line", F.array(_verts(parse(_PAIRS)))))
        .when(kind == "MultiLineString", g.geometry("multiline", _rings(parse(f"array<{_PAIRS}>"))))
        .when(kind == "Polygon", g.geometry("polygon", _rings(parse(f"array<{_PAIRS}>"))))
        .when(kind == "MultiPolygon", g.geometry(
            "multipolygon", _rings(F.flatten(parse(f"array<array<{_PAIRS}>>")))))
    )


def features_from_pages(
    pages: DataFrame, schema: str | T.StructType, payload: str = "payload"
) -> DataFrame:
    """One row per feature of JSON pages, with the fields of ``schema`` and ``geom``.

    Esri pages keep fields in ``attributes``, GeoJSON pages in ``properties``. Esri rings of several
    shells become a ``multipolygon``. Pages with no ``features``, such as error replies, give no rows;
    :func:`page_report` lists them. Parsing runs on the executors.
    """
    fields = schema.simpleString() if isinstance(schema, T.StructType) else f"struct<{schema}>"
    shape = ("struct<x:double,y:double,m:double,points:array<array<double>>,"
             "paths:array<array<array<double>>>,rings:array<array<array<double>>>,"
             "hasZ:boolean,hasM:boolean,type:string,coordinates:string>")
    page = (f"struct<hasZ:boolean,hasM:boolean,"
            f"features:array<struct<attributes:{fields},properties:{fields},geometry:{shape}>>>")
    rest = [c for c in pages.columns if c != payload]
    body = pages.select(*rest, F.from_json(payload, page).alias("_p")).select(
        *rest, F.col("_p.hasZ").alias("_z"), F.col("_p.hasM").alias("_m"),
        F.explode("_p.features").alias("_f"))
    found = F.col("_f")
    geom = F.coalesce(
        esri_geometry(found.geometry, F.col("_z"), F.col("_m")), geojson_geometry(found.geometry))
    several = F.expr(f"geom.kind = 'polygon' AND size({polygons('geom.parts')}) > 1")
    kind = F.when(several, "multipolygon").otherwise(F.col("geom.kind"))
    return body.select(
        *rest, F.coalesce(found.attributes, found.properties).alias("_a"),
        found.geometry.rings.isNotNull().alias("_r"), geom.alias("geom")
    ).withColumn("geom", F.when(F.col("_r"), g.geometry(kind, F.col("geom.parts"))).otherwise(F.col("geom"))
    ).select(*rest, "_a.*", "geom")


def page_report(pages: DataFrame, payload: str = "payload") -> DataFrame:
    """What became of each page: its other columns, ``n_features``, and ``reason`` if it gave none.

    The reasons are ``empty``, ``not JSON`` (such as a page cut off in transit), ``error reply``, ``no
    features`` (another document) and ``no rows`` (an empty list).
    """
    body = F.col(payload).cast("string")
    tree = F.try_parse_json(body)
    n = F.size(F.try_variant_get(tree, "$.features", "array<variant>"))
    n = F.coalesce(F.when(n >= 0, n), F.lit(0)).cast("bigint")
    listed = F.try_variant_get(tree, "$.features", "array<variant>").isNotNull()
    reason = (F.when(body.isNull() | (F.trim(body) == ""), "empty")
              .when(tree.isNull(), "not JSON")
              .when(n > 0, None)
              .when(F.try_variant_get(tree, "$.error", "variant").isNotNull(), "error reply")
              .when(~listed, "no features").otherwise("no rows"))
    rest = [c for c in pages.columns if c != payload]
    return pages.select(*rest, n.alias("n_features"), reason.alias("reason"))


# Marks put where a record or a value ends, outside quotes, and how they are written inside them.
_RECORD, _VALUE, _ESCAPE = "\x1e", "\x1f", "\x1c"
_KEPT = ((_ESCAPE, _ESCAPE + "0"), (_RECORD, _ESCAPE + "1"), (_VALUE, _ESCAPE + "2"))
_LONE_QUOTE = ('"', _ESCAPE + "3")


def _replaced(text: Column, pairs: list[tuple[str, str]]) -> Column:
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def _marked(text: Column) -> Column:
    """Page text with marks for the ends of records and values.

    Split at quotes, every second piece lies inside quotes, whatever it holds. If their number is odd,
    quotes are taken as any other character.
    """
    kept = _replaced(text, list(_KEPT))
    bare = _replaced(kept, [_LONE_QUOTE])
    odd = (F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))) % 2 == 1
    ends = [("\r\n", _RECORD), ("\n", _RECORD), ("\r", _RECORD), (",", _VALUE)]
    pieces = F.transform(F.split(F.when(odd, bare).otherwise(kept), '"'), lambda piece, i: F.when(
        i % 2 == 0, _replaced(piece, ends)).otherwise(piece))
    return F.array_join(pieces, '"')


def _value(text: Column) -> Column:
    """A value without its quotes; an unquoted empty one is null."""
    bare = F.trim(text)
    quoted = bare.startswith('"') & bare.endswith('"') & (F.length(bare) > 1)
    inner = F.replace(F.substring(bare, F.lit(2), F.length(bare) - 2), F.lit('""'), F.lit('"'))
    plain = F.when(quoted, inner).otherwise(F.when(bare != "", text))
    return _replaced(plain, [(new, old) for old, new in (_LONE_QUOTE, *reversed(_KEPT))])


def rows_from_csv_pages(
    pages: DataFrame, schema: str, payload: str = "payload"
) -> DataFrame:
    """Rows of CSV pages, each of which begins with its own header.

    Columns are found by the names in the page's header, in any order and case; one that the page
    lacks is null, as is a value that does not fit its type. Values in quotes may hold commas, line
    breaks and doubled quotes; an empty one is an empty text, while no value at all is null. Lines
    without text are skipped. A page whose quotes do not pair up is read line by line, with
    quotes as any other character.
    """
    names = T.StructType.fromDDL(schema)
    rest = [c for c in pages.columns if c != payload]
    text = F.regexp_replace(F.col(payload).cast("string"), "^\ufeff", "")
    records = pages.select(*rest, F.filter(
        F.split(_marked(text), _RECORD), lambda r: F.trim(r) != "").alias("_r"))
    heads = F.transform(F.split(F.get("_r", F.lit(0)), _VALUE), lambda v: F.lower(F.trim(_value(v))))
    rows = records.select(*rest, heads.alias("_h"), F.explode(
        F.slice("_r", F.lit(2), F.greatest(F.size("_r") - 1, F.lit(0)))).alias("_line"))
    cells = F.transform(F.split("_line", _VALUE), _value)
    split = rows.select(*rest, "_h", cells.alias("_v"))
    at = {f.name: F.array_position("_h", F.lit(f.name.lower())) for f in names}
    return split.select(*rest, *[
        F.when(at[f.name] > 0, F.get("_v", (at[f.name] - 1).cast("int"))).try_cast(f.dataType).alias(f.name)
        for f in names])
