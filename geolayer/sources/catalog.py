"""Layer catalogs from capability documents, and checks against them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geolayer.errors import InputValueError
from geolayer.functions.xml import well_formed

_WMS_LAYER = "Name:string,Title:string,CRS:array<string>,SRS:array<string>"
_WFS_PARAM = "array<struct<_name:string,Value:array<string>,AllowedValues:struct<Value:array<string>>>>"
_WFS = (
    "struct<OperationsMetadata:struct<Operation:array<struct<_name:string,"
    f"Parameter:{_WFS_PARAM}>>>,"
    "FeatureTypeList:struct<FeatureType:array<struct<Name:string,Title:string,"
    "DefaultCRS:array<string>,OtherCRS:array<string>,DefaultSRS:array<string>,"
    "OtherSRS:array<string>>>>>"
)


def _listed(*lists: Column) -> Column:
    return F.concat(*[F.coalesce(c, F.array().cast("array<string>")) for c in lists])


def _lower(texts: Column) -> Column:
    return F.array_distinct(F.transform(texts, lambda t: F.lower(F.trim(t))))


def _code(texts: Column) -> Column:
    """``epsg:n`` from the short and the urn form."""
    return F.array_distinct(F.transform(
        texts, lambda t: F.regexp_replace(F.lower(F.trim(t)), "^urn:.*epsg:[^:]*:", "epsg:")))


def _wms(depth: int) -> str:
    """Schema of a map service's document with layers nested ``depth`` deep."""
    layer = f"struct<{_WMS_LAYER}>"
    for _ in range(depth - 1):
        layer = f"struct<{_WMS_LAYER},Layer:array<{layer}>>"
    return ("struct<Capability:struct<Request:struct<GetMap:struct<Format:array<string>>>,"
            f"Layer:array<{layer}>>>")


def _layer_depth(text: Column) -> Column:
    """How deep layers are nested in a text that is XML."""
    bare = F.regexp_replace(text, r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>", "")
    tags = F.regexp_extract_all(bare, F.lit(r"(<Layer(?=[\s>/])[^>]*>|</Layer\s*>)"), F.lit(1))
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))

    def step(at: Column, tag: Column) -> Column:
        inner = at.now + F.when(tag.startswith("</"), -1).otherwise(1)
        return F.struct(
            (inner - F.when(tag.endswith("/>"), 1).otherwise(0)).alias("now"),
            F.greatest(at.most, inner).alias("most"))

    return F.aggregate(tags, start, step, lambda at: at.most)


def _all_layers(layers: Column, outer: Column, depth: int) -> Column:
    """Layers of all levels with their own codes before those of the layers around them."""
    def codes(y: Column) -> Column:
        return F.concat(_listed(y.CRS, y.SRS), outer)

    own = F.transform(layers, lambda y: F.struct(
        y.Name.alias("Name"), y.Title.alias("Title"), codes(y).alias("codes")))
    if depth > 1:
        own = F.concat(own, F.flatten(F.transform(
            layers, lambda y: _all_layers(y.getField("Layer"), codes(y), depth - 1))))
    return F.coalesce(own, F.array().cast(
        "array<struct<Name:string,Title:string,codes:array<string>>>"))


def catalog_from_xml(docs: DataFrame, service: str = "wms", xml: str = "xml") -> DataFrame:
    """One row per layer: ``layer, title, crs, formats``, codes and formats lowercased.

    Map layers with a name are listed from any level, and also offer the codes of all layers around
    them; the depth is taken from the documents in a pass of its own. Documents that are not XML
    give one row with nulls, so that an unavailable service can be seen.
    """
    if service not in ("wms", "wfs"):
        raise InputValueError("service", ("wms", "wfs"), service)
    rest = [c for c in docs.columns if c != xml]
    text = F.when(well_formed(F.col(xml)), F.col(xml))
    depth = 1
    if service == "wms":
        depth = max(1, docs.agg(F.max(_layer_depth(text))).first()[0] or 1)
    doc = docs.select(
        *rest, F.from_xml(text, _wms(depth) if service == "wms" else _WFS).alias("_d"))
    if service == "wms":
        layers = F.filter(
            _all_layers(F.col("_d.Capability.Layer"), F.array().cast("array<string>"), depth),
            lambda y: y.Name.isNotNull())
        formats = _lower(_listed(F.col("_d.Capability.Request.GetMap.Format")))
        rows = doc.select(*rest, formats.alias("formats"), F.explode_outer(layers).alias("_y"))
        codes = _code(F.col("_y.codes"))
    else:
        def of(items: Column, name: str) -> Column:
            return F.filter(items, lambda o: o.getField("_name") == name)

        params = F.flatten(F.transform(
            of(F.col("_d.OperationsMetadata.Operation"), "GetFeature"), lambda o: o.Parameter))
        values = F.flatten(F.transform(of(params, "outputFormat"), lambda p: _listed(
            p.Value, p.AllowedValues.Value)))
        rows = doc.select(*rest, _lower(_listed(values)).alias("formats"),
                          F.explode_outer("_d.FeatureTypeList.FeatureType").alias("_y"))
        codes = _code(_listed(*[F.col(f"_y.{n}") for n in (
            "DefaultCRS", "OtherCRS", "DefaultSRS", "OtherSRS")]))
    return rows.select(
        *rest, F.col("_y.Name").alias("layer"), F.col("_y.Title").alias("title"),
        F.when(F.col("_y").isNotNull(), codes).alias("crs"), "formats")


def check_options(requests: DataFrame, catalog: DataFrame) -> DataFrame:
    """Add ``reason`` (first bad option or null) and ``valid`` (what its layer offers).

    Requests carry ``layer, outformat, crs``; the code must be offered by that layer.
    """
    offered = catalog.where("layer is not null").select(
        F.col("layer").alias("_layer"), F.col("crs").alias("_crs"),
        F.col("formats").alias("_formats"))
    joined = requests.join(offered, F.col("layer") == F.col("_layer"), "left")
    bad_format = ~F.array_contains("_formats", F.lower("outformat"))
    bad_crs = ~F.array_contains("_crs", F.lower(F.col("crs")))
    reason = (
        F.when(F.col("_layer").isNull(), "layer")
        .when(F.coalesce(bad_format, F.lit(True)), "outformat")
        .when(F.coalesce(bad_crs, F.lit(True)), "crs")
    )
    valid = F.when(reason == "outformat", F.array_join("_formats", ", ")).when(
        reason == "crs", F.array_join("_crs", ", "))
    return joined.select(*requests.columns, reason.alias("reason"), valid.alias("valid"))
