"""Curating tables of requests and replies."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from geolayer.errors import InputTypeError, InputValueError
from geolayer.functions.urls import body_text, normalize_url, param_pairs, request_key
from geolayer.functions.xml import stripped, well_formed
from geolayer.plans.ordered import ordered_table

# Parts a request may carry, methods, and the default age limit in seconds.
REQUEST_PARTS = ("params", "data", "json", "headers")
METHODS = ("GET", "POST")
EXPIRE_AFTER = 604_800
# Text before the hit count by service version.
HIT_KEYS = {"2.0.0": "numberMatched=", "1.1.0": "numberOfFeatures="}


def _has(df: DataFrame, name: str) -> bool:
    return name in df.columns


def normalize_urls(df: DataFrame, url: str = "url", params: str | None = None) -> DataFrame:
    """Add ``norm_url``, with the parameters merged in: a map, pairs in an array, or a query text."""
    pairs = param_pairs(F.col(params), df.schema[params].dataType) if params else None
    return df.withColumn("norm_url", normalize_url(F.col(url), pairs=pairs))


def with_request_key(df: DataFrame) -> DataFrame:
    """Add ``norm_url`` and ``key``; ``method, params, data, json`` columns are optional."""
    def body(name: str) -> Column | None:
        if not _has(df, name):
            return None
        is_map = isinstance(df.schema[name].dataType, T.MapType)
        return body_text(F.col(name)) if is_map else F.col(name).cast("string")

    method = F.col("method") if _has(df, "method") else F.lit("GET")
    normal = normalize_urls(df, "url", "params" if _has(df, "params") else None)
    return normal.withColumn(
        "key", request_key(method, F.col("norm_url"), body("data"), body("json")))


def with_output_name(
    df: DataFrame, prefix: str = "", ext: str = "", names: list[str] | None = None
) -> DataFrame:
    """Add ``file_name``: prefix, key and extension, or the given names by ``request_id``.

    Dots are taken out of the extension and an empty one adds nothing. Given names must be as many
    as the requests.
    """
    if names is not None:
        if df.limit(len(names) + 1).count() != len(names):
            raise InputTypeError("names", "as many as the requests")
        listed = df.sparkSession.createDataFrame(
            list(enumerate(names)), "request_id bigint, file_name string")
        return df.join(listed, "request_id", "left")
    tail = ext.replace(".", "")
    keyed = df if _has(df, "key") else with_request_key(df)
    return keyed.withColumn("file_name", F.concat(
        F.lit(prefix), F.col("key"), F.lit(f".{tail}" if tail else "")))


def check_requests(df: DataFrame, parts: str = "parts", method: str = "method") -> DataFrame:
    """Add ``reason``: an unknown part name, a method that is not offered, or null.

    ``parts`` is a map from part name to its text.
    """
    unknown = F.array_except(F.map_keys(parts), F.array(*[F.lit(p) for p in REQUEST_PARTS]))
    return df.withColumn(
        "reason",
        F.when(F.col("url").isNull(), "url")
        .when(F.size(unknown) > 0, F.concat(F.lit("parts: "), F.array_join(F.array_sort(unknown), ",")))
        .when(~F.upper(F.coalesce(F.col(method), F.lit(""))).isin(*METHODS), "method"),
    )


def check_lengths(df: DataFrame, urls: str = "urls", kwds: str = "kwds") -> DataFrame:
    """Add ``reason`` for jobs whose url and keyword lists differ in length."""
    return df.withColumn("reason", F.when(
        F.col(kwds).isNotNull() & (F.size(urls) != F.size(kwds)), "urls/kwds"))


def dedupe_requests(df: DataFrame, by: str = "request_id") -> DataFrame:
    """One row per key: the first request with it, and how many there were."""
    keyed = df if _has(df, "key") else with_request_key(df)
    rest = [c for c in keyed.columns if c != "key"]
    first = F.min_by(F.struct(*rest), F.col(by)).alias("_first")
    return keyed.groupBy("key").agg(first, F.count(F.lit(1)).alias("n_requests")).select(
        "key", "_first.*", "n_requests")


def age_limit(ttl: int | None = None) -> int:
    """Seconds a reply stays fresh: as given, else the environment's, else a week."""
    if ttl is not None:
        return ttl
    return int(os.environ.get("GEOLAYER_CACHE_EXPIRE", EXPIRE_AFTER))


def cache_lookup(
    requests: DataFrame,
    cache: DataFrame,
    keys: list[str],
    ttl: int | None = None,
    disabled: bool | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Add the latest reply of the same key at or before each request, and ``status``.

    ``requests`` has ``request_id, ts``, ``cache`` has ``cache_id, ts``, both have the keys.
    ``status`` is ``hit``, ``expired`` (older than ``ttl``) or ``miss``. A disabled cache always
    misses; a negative ``ttl`` never expires. A request with a null key or time misses.

    Both tables are put in one order of key and time and cut into even parts, whatever the
    key, so a key with a third of the rows is worked on by many tasks. Inside a part a window
    carries the latest reply forward; a part's first key continues what the parts before left
    over, which is one row per part.
    """
    if disabled is None:
        disabled = os.environ.get("GEOLAYER_CACHE_DISABLE", "false").lower() == "true"
    reply = "struct<micros:bigint,id:bigint>"
    if disabled:
        return requests.select(
            F.col("request_id").cast("bigint").alias("request_id"), *keys,
            F.col("ts").cast("timestamp").alias("ts"), F.lit(None).cast("bigint").alias("cache_id"),
            F.lit(None).cast("timestamp").alias("cache_ts"), F.lit("miss").alias("status"))
    limit = age_limit(ttl)

    def side(df: DataFrame, name: str, is_request: int) -> DataFrame:
        return df.select(
            *keys, F.col("ts").cast("timestamp").alias("ts"), F.lit(is_request).alias("_req"),
            F.col(name).cast("bigint").alias("_id"))

    # A reply without a key or time answers nothing, and a request without a key asks for nothing.
    cache = cache.dropna(subset=[*keys, "ts"])
    both = side(cache, "cache_id", 0).unionByName(side(requests, "request_id", 1))
    table = ordered_table(both, [*keys, "ts", "_req", "_id"], partitions)
    own = F.when(F.col("_req") == 0, F.struct(
        F.unix_micros("ts").alias("micros"), F.col("_id").alias("id"))).cast(reply)
    table = table.withColumn("_key", F.struct(*keys)).withColumn("_own", own)
    ends = table.groupBy("_part").agg(
        F.min("_key").alias("first"), F.max("_key").alias("last"),
        F.max(F.when(F.col("_req") == 0, F.struct("_key", F.col("_own").alias("own")))).alias("tip"),
    ).orderBy("_part").collect()
    carried, rows = None, []
    for r in ends:
        if carried is not None and carried[0] == r.first:
            rows.append((r._part, carried[1]))
        tip = (r.tip._key, r.tip.own) if r.tip is not None else None
        if tip and tip[0] == r.last:
            carried = tip
        elif carried is None or carried[0] != r.last:
            carried = None
    starts = requests.sparkSession.createDataFrame(rows, f"_part int, _start {reply}")
    firsts = requests.sparkSession.createDataFrame(
        [(r._part, tuple(r.first)) for r in ends],
        T.StructType([T.StructField("_part", T.IntegerType()),
                      T.StructField("_first", table.schema["_key"].dataType)]))
    heads = firsts.join(starts, "_part")
    so_far = Window.partitionBy("_part", "_key").orderBy("_pos").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    seen = table.withColumn("_seen", F.last("_own", ignorenulls=True).over(so_far)).where("_req = 1")
    found = seen.join(F.broadcast(heads), "_part", "left").withColumn("_got", F.coalesce(
        F.col("_seen"), F.when(F.col("_key").eqNullSafe(F.col("_first")), F.col("_start"))))
    age = F.unix_micros("ts") - F.col("_got.micros")
    fresh = F.lit(True) if limit < 0 else age <= limit * 1_000_000
    return found.select(
        F.col("_id").alias("request_id"), *keys, "ts", F.col("_got.id").alias("cache_id"),
        F.timestamp_micros("_got.micros").alias("cache_ts"),
        F.when(F.col("_got").isNull(), "miss").when(fresh, "hit").otherwise("expired").alias("status"))


def _first_text(xml: Column, path: str) -> Column:
    return stripped(F.get(F.xpath(xml, F.lit(path)), F.lit(0)))


def error_text(reply: Column) -> Column:
    """Message of an error reply.

    White space around a reply or message does not count. Text that is not XML is the message. Otherwise it is the text before the first nested
    element of the first child of the last child, else of the last child, else of the root.
    """
    reply = stripped(reply)
    deep = F.xpath_boolean(reply, F.lit("/*/*[last()]/*"))
    wide = F.xpath_boolean(reply, F.lit("/*/*"))
    inside = (
        F.when(deep, _first_text(reply, "/*/*[last()]/*[1]/node()[1][self::text()]"))
        .when(wide, _first_text(reply, "/*/*[last()]/node()[1][self::text()]"))
        .otherwise(_first_text(reply, "/*/node()[1][self::text()]"))
    )
    return F.when(well_formed(reply), inside).otherwise(reply)


def error_report(
    replies: DataFrame, reply: str = "reply", by: str = "request_id"
) -> DataFrame:
    """Distinct messages of error replies with their count and first request."""
    return replies.withColumn("message", error_text(F.col(reply))).groupBy("message").agg(
        F.count(F.lit(1)).alias("n_replies"), F.min(by).alias("first_request"))


def parse_hits(
    replies: DataFrame, version: str = "2.0.0", reply: str = "reply"
) -> DataFrame:
    """Add ``hits``, or ``error`` with the reply where no whole number follows the key."""
    if version not in HIT_KEYS:
        raise InputValueError("version", HIT_KEYS, version)
    after = F.element_at(F.split(F.col(reply), HIT_KEYS[version]), -1)
    number = F.regexp_replace(F.get(F.split(after, " "), F.lit(0)), '^"+|"+$', "")
    return replies.withColumn("hits", F.trim(number).try_cast("bigint")).withColumn(
        "error", F.when(F.col("hits").isNull(), F.col(reply)))


def hits_per_layer(parsed: DataFrame, layer: str = "layer") -> DataFrame:
    """Total hits and unreadable replies of each layer."""
    return parsed.groupBy(layer).agg(
        F.coalesce(F.sum("hits"), F.lit(0)).alias("hits"),
        F.count_if(F.col("hits").isNull()).alias("n_errors"))


def with_layer(df: DataFrame, url: str = "url", layer: str | None = None) -> DataFrame:
    """Split service and layer number of a URL; an explicit layer column wins.

    A URL whose last part is no number and that names no layer is flagged ``missing_layer``.
    """
    bare = F.regexp_replace(F.col(url), "/+$", "")
    last = F.regexp_extract(bare, "/([^/]*)$", 1).try_cast("int")
    given = F.col(layer).cast("int") if layer else F.lit(None).cast("int")
    service = F.when(given.isNull() & last.isNotNull(), F.regexp_replace(bare, "/[^/]*$", "")).otherwise(bare)
    return df.withColumn("service", service).withColumn(
        "layer_no", F.coalesce(given, last)).withColumn(
        "missing_layer", F.col("layer_no").isNull())


def by_layer(df: DataFrame, url: str = "url", layer: str | None = None) -> DataFrame:
    """Requests per service and layer; those without a layer count under null."""
    return with_layer(df, url, layer).groupBy("service", "layer_no").agg(
        F.count(F.lit(1)).alias("n_requests"))


def manifest_todo(
    wanted: DataFrame, present: DataFrame, name: str = "name", size: str = "size"
) -> DataFrame:
    """Files to write: absent ones and those whose size differs; no expected size is -1."""
    held = present.select(name, F.col(size).alias("_held"))
    expected = F.coalesce(F.col(size), F.lit(-1))
    return wanted.join(held, name, "left").where(
        F.col("_held").isNull() | (F.col("_held") != expected)
    ).withColumn("reason", F.when(F.col("_held").isNull(), "absent").otherwise("size")).drop("_held")
