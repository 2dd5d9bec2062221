"""Retrieving features by id: projection, missing ids, failed replies and retries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geolayer.errors import InputTypeError, InputValueError, ServiceError
from geolayer.functions import crs
from geolayer.functions import geometry as g
from geolayer.layer import LayerInfo, geometry_column, resolve_field
from geolayer.operators.paging import distinct_ids, partition_ids
from geolayer.functions.nested import traverse_json
from geolayer.operators.select import matched, where_in
from geolayer.plans.ordered import with_row_number
from geolayer.session import written
from geolayer.sources.fetch import fetch_pages

RETRY_ROUNDS = 4


def select_fields(
    df: DataFrame, outfields: str | list[str] = "*", info: LayerInfo | None = None
) -> DataFrame:
    """Chosen fields; ``*`` for all, aliases accepted, unknown names are an error."""
    wanted = [outfields] if isinstance(outfields, str) else list(outfields)
    if "*" in wanted:
        for name in wanted:
            if name != "*":
                resolve_field(df, name, info)
        return df
    return df.select(*dict.fromkeys(resolve_field(df, name, info) for name in wanted))


def get_features(
    df: DataFrame,
    info: LayerInfo,
    ids: object,
    outfields: str | list[str] = "*",
    return_geom: bool = True,
    return_m: bool = False,
    out_crs: int | str | None = None,
    require_match: bool = False,
) -> DataFrame:
    """Features by id with chosen fields, optional geometry and measure, in ``out_crs``."""
    found = where_in(df, info.id_col, ids)
    geom = geometry_column(df, info) if return_geom else info.geom_col
    boxes = [b for b in g.BBOX if b in df.columns]
    fields = select_fields(found.drop(geom, *boxes), outfields, info).columns
    if not return_geom:
        return matched(found.select(*fields), require_match)
    if not return_m:
        found = found.withColumn(geom, F.expr(g.drop_measure(geom)))
    shape = crs.reproject_geom(geom, info.epsg, out_crs or info.epsg)
    return matched(found.select(*fields, F.expr(shape).alias(geom)), require_match)


def missing_ids(requested: DataFrame, df: DataFrame, column: str) -> DataFrame:
    """Distinct requested ids that the layer does not hold."""
    wanted = requested.select(F.col(requested.columns[0]).alias(column)).distinct()
    return wanted.join(df.select(column).distinct(), column, "left_anti")


def missing_report(requested: DataFrame, df: DataFrame, column: str) -> DataFrame:
    """Number of requested, found and missing ids."""
    wanted = requested.select(F.col(requested.columns[0]).alias(column)).distinct()
    held = df.select(F.col(column), F.lit(1).alias("_held")).distinct()
    return wanted.join(held, column, "left").agg(
        F.count(F.lit(1)).alias("n_requested"),
        F.count("_held").alias("n_found"),
        F.count_if(F.col("_held").isNull()).alias("n_missing"),
    )


def _error(payload: Column, field: str) -> Column:
    kind = "variant" if field == "$.error" else "string"
    return F.try_variant_get(F.try_parse_json(payload), field, kind)


def split_responses(responses: DataFrame, payload: str = "payload") -> DataFrame:
    """Add ``failed`` and ``message``: a reply with the key ``error`` failed, even a null one.

    A reply that never came (null payload) failed too, and so did one that is no JSON, such as one
    cut off in transit.
    """
    body = F.col(payload)
    return responses.withColumn(
        "failed",
        body.isNull() | F.try_parse_json(body).isNull() | _error(body, "$.error").isNotNull()
    ).withColumn("message", _error(body, "$.error.message"))


def first_error(split: DataFrame, order: str = "request_id") -> DataFrame:
    """One row: number of replies and failures, and the message of the first failing reply."""
    bad = F.when(F.col("failed"), F.col(order))
    return split.agg(
        F.count(F.lit(1)).alias("n_replies"),
        F.count_if("failed").alias("n_failed"),
        F.min_by(F.col("message"), bad).alias("message"),
    )


def ok_responses(split: DataFrame, retry: bool = True) -> DataFrame:
    """Replies that succeeded; none of them and no retry left is an error."""
    good = split.where(~F.col("failed")).drop("failed", "message")
    if not retry and not good.limit(1).count():
        raise ServiceError(first_error(split).first().message or "no reply succeeded")
    return good


def failed_ids(split: DataFrame, requests: DataFrame, id_type: str = "bigint") -> DataFrame:
    """Distinct ids asked for by the failed requests, from their ``object_ids`` text.

    ``id_type`` is the type of the layer's ids, ``string`` for text ids.
    """
    bad = split.where("failed").select("request_id")
    return requests.join(bad, "request_id", "left_semi").select(
        F.explode(F.split("object_ids", ",")).alias("id")).select(
        F.col("id").cast(id_type)).distinct()


def retry_sizes(max_nrecords: int) -> list[int]:
    """Batch sizes of the retry rounds, from half the limit evenly down to one."""
    least = 1 / max_nrecords
    step = (0.5 - least) / (RETRY_ROUNDS - 1)
    return [max(int((step * k + least) * max_nrecords), 1) for k in range(RETRY_ROUNDS - 1, -1, -1)]


def retry_plan(failed: DataFrame, max_nrecords: int) -> DataFrame:
    """Batches of every retry round if all the failed ids went through it.

    The ids are put in order once; the batch in a round follows from an id's number and the round's size.
    """
    rounds = F.array(*[
        F.struct(F.lit(i).alias("round"), F.lit(size).alias("batch_size"))
        for i, size in enumerate(retry_sizes(max_nrecords), 1)])
    numbered = with_row_number(distinct_ids(failed, "id"), ["id"])
    placed = numbered.select("id", "rn", F.explode(rounds).alias("r")).select(
        "r.*", F.floor((F.col("rn") - 1) / F.col("r.batch_size")).alias("batch"), "id")
    return placed.groupBy("round", "batch_size", "batch").agg(
        F.transform(F.sort_array(F.collect_list("id")), lambda i: i.cast("string")).alias("ids"))


def delivered_ids(good: DataFrame, id_path: list[str], id_type: str = "bigint") -> DataFrame:
    """Distinct ids found along ``id_path`` of the JSON replies."""
    found = F.flatten(traverse_json(F.col("payload"), id_path))
    return good.select(F.explode(found).alias("id")).select(
        F.col("id").try_cast(id_type).alias("id")).where("id IS NOT NULL").distinct()


def _round(
    ids: DataFrame, size: int, ask: Callable[[DataFrame], DataFrame], id_type: str,
    id_path: list[str] | None,
) -> tuple[DataFrame, DataFrame]:
    requests = partition_ids(ids, "id", size).select(
        F.col("batch").alias("request_id"), F.array_join("ids", ",").alias("object_ids"))
    requests = written(requests, "requests")
    replies = written(ask(requests), "replies")
    split = split_responses(replies)
    good = ok_responses(split)
    if not id_path:
        return good, failed_ids(split, requests, id_type)
    asked = requests.select(F.explode(F.split("object_ids", ",")).alias("id")).select(
        F.col("id").cast(id_type)).distinct()
    return good, asked.join(delivered_ids(good, id_path, id_type), "id", "left_anti")


def fetch_features(
    ids: DataFrame,
    fetcher: Callable | None = None,
    max_nrecords: int = 1000,
    retry: bool = True,
    slots: int | None = None,
    id_type: str = "bigint",
    id_path: list[str] | None = None,
    replies: Callable[[DataFrame], DataFrame] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Fetch features by id and retry failed batches in smaller ones.

    Batches are answered by ``fetcher``, called for each request, or by ``replies``, a function from the table of
    requests (``request_id, object_ids``) to that of replies, such as ``stored_features``.

    Returns the replies that succeeded and the ids that were not delivered to the end. With
    ``id_path``, the path of the id in a reply (``["features", "attributes", "id"]``), these are the
    ids asked for without those found in the replies, so a feature left out of a reply, or a reply
    without features, counts as missing and is asked for again. Without it only the ids of failed
    requests are known to be missing. ``id_type`` is the type of the ids. Each round keeps only
    the ids still missing; requests and replies are written tables, so nothing is fetched twice
    when an executor is lost. At most four more rounds run.
    """
    if max_nrecords < 1:
        raise InputValueError("max_nrecords", ["1 or more"], max_nrecords)
    if (fetcher is None) == (replies is None):
        raise InputTypeError("fetcher", "given, or else replies")
    ask = replies or (lambda requests: fetch_pages(requests, fetcher, slots))
    good, left = _round(ids, max_nrecords, ask, id_type, id_path)
    good = good.withColumn("round", F.lit(0))
    if not retry:
        return good, left
    for i, size in enumerate(retry_sizes(max_nrecords), 1):
        if not left.limit(1).count():
            break
        more, left = _round(left, size, ask, id_type, id_path)
        good = good.unionByName(more.withColumn("round", F.lit(i)))
    return good, left
