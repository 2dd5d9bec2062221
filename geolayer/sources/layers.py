"""Reading, writing and describing layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geolayer.errors import InputValueError
from geolayer.functions import crs
from geolayer.functions import geometry as g
from geolayer.layer import LayerInfo, geometry_column
from geolayer.operators.retrieve import select_fields

FORMATS = ("parquet", "json", "orc", "csv")

# Field type tags by column type.
TYPE_TAGS = {
    "string": "string", "bigint": "biginteger", "int": "integer", "smallint": "smallinteger",
    "tinyint": "smallinteger", "double": "double", "float": "single", "timestamp": "date",
    "timestamp_ntz": "date", "date": "date", "binary": "blob", "boolean": "smallinteger",
}


def read_layer(
    spark: SparkSession,
    path: str,
    info: LayerInfo | None = None,
    schema: str | T.StructType | None = None,
    fmt: str = "parquet",
    outfields: str | list[str] = "*",
) -> DataFrame:
    """A layer from files, with the declared schema and only the asked-for fields."""
    if fmt not in FORMATS:
        raise InputValueError("fmt", FORMATS, fmt)
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", "true")
    return select_fields(reader.load(path), outfields, info)


def write_layer(df: DataFrame, path: str, by: str | list[str] | None = None) -> None:
    """Write as Parquet, replacing only the partitions that ``df`` holds.

    Rows are brought together by partition value; a value with very many rows is spread over
    several tasks and files by the rebalance step.
    """
    if by is None:
        df.write.mode("overwrite").parquet(path)
        return
    keys = [by] if isinstance(by, str) else list(by)
    (df.hint("rebalance", *keys).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path))


def type_tag(dtype: T.DataType) -> str:
    """Field type tag of a column type."""
    text = dtype.simpleString()
    if text.startswith("decimal"):
        return "double"
    if text == g.GEOMETRY:
        return "geometry"
    return TYPE_TAGS.get(text, text)


def describe_layer(df: DataFrame, info: LayerInfo) -> DataFrame:
    """One row per field: alias, type tag, whether it is the geometry, row and null counts."""
    alias = {v: k for k, v in info.aliases.items()}
    counts = df.agg(
        F.count(F.lit(1)).alias("_n"), *[F.count(F.col(c)).alias(c) for c in df.columns])
    geom = geometry_column(df, info) if any("geom" in c for c in df.columns) else None

    def tag(f: T.StructField) -> str:
        return "oid" if f.name == info.id_col else type_tag(f.dataType)

    rows = F.array(*[
        F.struct(
            F.lit(f.name).alias("field"),
            F.lit(alias.get(f.name, f.metadata.get("alias", f.name))).alias("alias"),
            F.lit(tag(f)).alias("type"),
            F.lit(f.name == geom).alias("is_geometry"),
            F.col("_n").alias("n_rows"),
            (F.col("_n") - F.col(f.name)).alias("n_nulls"),
        )
        for f in df.schema.fields
    ])
    return counts.select(F.inline(rows))


def layer_extent(
    df: DataFrame, info: LayerInfo, fallback: tuple[float, float, float, float] | None = None
) -> DataFrame:
    """Extent in degrees; NaN bounds are left out.

    A layer without any usable bound has the ``fallback`` extent, given in its CRS, else nulls.
    """
    if not set(g.BBOX) <= set(df.columns):
        df = g.with_bbox(df, geometry_column(df, info))

    def best(fn, name: str):
        c = F.col(name)
        spare = F.lit(float(fallback[g.BBOX.index(name)]) if fallback else None).cast("double")
        return F.coalesce(fn(F.when(~F.isnan(c), c)), spare).alias(name)

    row = df.agg(best(F.min, "xmin"), best(F.min, "ymin"), best(F.max, "xmax"), best(F.max, "ymax"))
    moved = crs.reproject_box(*g.BBOX, info.epsg, 4326)
    return row.select(F.expr(moved).alias("_e")).select("_e.*")


def feature_types(df: DataFrame, id_col: str, name_col: str) -> DataFrame:
    """Coded types of a layer: distinct id and name."""
    return df.select(F.col(id_col).alias("id"), F.col(name_col).alias("name")).where(
        F.col("id").isNotNull()).distinct()
