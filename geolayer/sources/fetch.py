"""Bulk page retrieval: one reply row per request row, from a service or from stored replies."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REPLY = "request_id bigint, status string, payload string, error string"
BINARY_REPLY = "request_id bigint, status string, payload binary, error string"


def fetch_pages(
    requests: DataFrame, fetcher: Callable[[dict], str | bytes], slots: int | None = None,
    binary: bool = False,
) -> DataFrame:
    """Run ``fetcher`` for each request; a failure is a row with its error, never an exception.

    ``requests`` has ``request_id`` and whatever the fetcher reads; ``slots`` bounds how many
    run at a time. Rows keep their ``request_id``, which gives the order of the requests.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for request in batch.to_dict("records"):
                try:
                    reply = (request["request_id"], "ok", fetcher(request), None)
                except Exception as ex:
                    reply = (request["request_id"], "failed", None, f"{type(ex).__name__}: {ex}")
                yield pd.DataFrame(
                    [reply], columns=["request_id", "status", "payload", "error"])

    n = slots or requests.sparkSession.sparkContext.defaultParallelism
    return requests.repartition(n, "request_id").mapInPandas(
        run, BINARY_REPLY if binary else REPLY)


def stored_pages(
    requests: DataFrame, stored: DataFrame, key: str = "url", payload: str = "payload"
) -> DataFrame:
    """Replies from a table of stored ones, found by ``key``: the bulk retrieval of pages kept before.

    A request without a stored reply, or whose key or reply is null, has failed. Of several replies with
    one key the least is taken. Each request row gets one reply row.
    """
    held = stored.groupBy(key).agg(F.min(payload).alias("payload"))
    met = requests.select("request_id", key).join(held, key, "left")
    missing = F.col("payload").isNull()
    return met.select(
        "request_id", F.when(missing, "failed").otherwise("ok").alias("status"), "payload",
        F.when(missing, F.concat(F.lit("no reply stored for "), F.coalesce(key, F.lit("null")))).alias("error"))


def stored_features(
    stored: DataFrame, id_col: str = "id", feature: str = "feature", error: str | None = None
) -> Callable[[DataFrame], DataFrame]:
    """Answers to batches of ids out of a table of features, ``feature`` being one's JSON text.

    The function takes requests ``(request_id, object_ids)`` and gives a JSON reply for each: the features it
    holds of the ids asked for, in order, or the error of a feature whose column ``error`` has a message. Ids that are
    not held are left out. Requests are taken apart and joined by id, so the work follows the ids asked for.
    """
    dtype = stored.schema[id_col].dataType
    message = F.col(error) if error else F.lit(None).cast("string")
    held = stored.select(F.col(id_col).alias("_id"), F.col(feature).alias("_f"), message.alias("_e"))

    def replies(requests: DataFrame) -> DataFrame:
        asked = requests.select("request_id", F.explode(F.split("object_ids", ",")).alias("_t")).select(
            "request_id", F.col("_t").try_cast(dtype).alias("_id"))
        found = asked.join(held, "_id", "left").groupBy("request_id").agg(
            F.min("_e").alias("_e"),
            F.sort_array(F.collect_list(F.when(F.col("_f").isNotNull(), F.struct("_id", "_f")))).alias("_f"))
        refused = F.to_json(F.struct(F.struct(F.col("_e").alias("message")).alias("error")))
        body = F.concat(F.lit('{"features":['), F.array_join("_f._f", ","), F.lit("]}"))
        return found.select(
            "request_id", F.lit("ok").alias("status"),
            F.when(F.col("_e").isNotNull(), refused).otherwise(body).alias("payload"),
            F.lit(None).cast("string").alias("error"))

    return replies
