"""Request and reply tables; JSON, URL and XML functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from geolayer.functions.nested import traverse_json
from geolayer.operators import paging
from geolayer.operators import requests as req
from workloads import layers as ly
from workloads.layers import SITES_SQL
from workloads.registry import query


@query("h1_traverse_json", """SELECT conv_id, string_agg(coalesce(role, 'NULL'), '|' ORDER BY turn, role)
    AS found FROM conversations GROUP BY conv_id""")
def h1(spark, sf):
    turn = F.struct("turn", "role")
    docs = ly.table(spark, sf, "conversations").groupBy("conv_id").agg(
        F.sort_array(F.collect_list(turn)).alias("turns")).select(
        "conv_id", F.to_json(F.array(F.struct("turns"))).alias("doc"))
    found = traverse_json(F.col("doc"), ["turns", "role"])
    return docs.select("conv_id", F.array_join(found[0], "|", "NULL").alias("found"))


@query("h1_traverse_json_missing_parts", """SELECT conv_id, 'NULL' AS second, count(*) + 1 AS n_first,
    1 AS n_nulls FROM conversations GROUP BY conv_id""")
def h1_missing(spark, sf):
    roles = F.concat_ws(",", F.collect_list(F.concat(F.lit('{"role":"'), F.col("role"), F.lit('"}'))))
    docs = ly.table(spark, sf, "conversations").groupBy("conv_id").agg(
        F.concat(F.lit('[{"turns":['), roles, F.lit(',{}]},{"other":1}]')).alias("doc"))
    found = traverse_json(F.col("doc"), ["turns", "role"])
    return docs.select(
        "conv_id", F.array_join(found[1], "|", "NULL").alias("second"),
        F.size(found[0]).cast("bigint").alias("n_first"),
        F.size(F.filter(found[0], lambda v: v.isNull())).alias("n_nulls"))


@query("h1_traverse_json_object", """SELECT event_id, json_extract_string(props, '$.k') AS found
    FROM events""")
def h1_object(spark, sf):
    found = traverse_json(F.col("props"), ["k"])
    return ly.table(spark, sf, "events").select("event_id", found[0][0].alias("found"))


# The same two parameters.
SPELLINGS = ("q=caf%C3%A9+x~&q=%41*", "q=A%2a&q=caf%c3%a9%20x%7E")


def page_requests(spark, sf):
    """GET requests of the pages; every third is written again with another host spelling, and every
    fifth twice with a repeated parameter, its escapes written in two ways."""
    pages = ly.table(spark, sf, "pages").select("page_id", "url")
    host = F.regexp_extract("url", "^([a-z]+://[^/]*)", 1)
    odd = F.concat(F.upper(host), F.substring(F.col("url"), F.length(host) + 1, F.length("url")))
    again = pages.where("page_id % 3 = 0").select(
        (F.col("page_id") + 1_000_000_000).alias("request_id"), odd.alias("url"))
    requests = pages.select(F.col("page_id").alias("request_id"), "url").unionByName(again)
    mark = F.when(F.contains("url", F.lit("?")), "&").otherwise("?")
    for n, query in enumerate(SPELLINGS, 2):
        requests = requests.unionByName(pages.where("page_id % 5 = 1").select(
            (F.col("page_id") + n * 1_000_000_000).alias("request_id"),
            F.concat("url", mark, F.lit(query)).alias("url")))
    return requests.withColumn("method", F.lit("get"))


_SHAPE = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(\?[^#]*)?(#.*)?$"


def _piece(i: int) -> str:
    return f"regexp_extract(trim(url), '{_SHAPE}', {i})"


def _coded(text: str) -> str:
    return f"url_encode(url_decode(replace({text}, '+', ' ')))"


_PAIR_SQL = (f"CASE WHEN contains(p, '=') THEN {_coded("split_part(p, '=', 1)")} || '=' || "
             f"{_coded("p[strpos(p, '=') + 1:]")} ELSE {_coded('p')} END")


def normal_sql(source: str) -> str:
    """All columns of ``source`` plus ``norm_url``."""
    sql = (f"SELECT *, lower({_piece(1)}) AS scheme, lower({_piece(2)}) AS host0, "
           f"{_piece(3)} AS path0, {_piece(4)} AS query0 FROM ({source})")
    sql = ("SELECT *, CASE scheme WHEN 'http' THEN regexp_replace(host0, ':80$', '') WHEN 'https' THEN "
           "regexp_replace(host0, ':443$', '') ELSE host0 END AS host, CASE WHEN path0 = '' THEN '/' ELSE "
           f"path0 END AS path, list_transform(list_filter(string_split(query0[2:], '&'), lambda p: p <> ''), "
           f"lambda p: {_PAIR_SQL}) AS pairs FROM ({sql})")
    sql = f"SELECT *, array_to_string(list_sort(pairs), '&') AS query FROM ({sql})"
    return ("SELECT *, scheme || '://' || host || path || CASE WHEN query <> '' THEN '?' || query ELSE '' END "
            f"AS norm_url FROM ({sql})")


PAGE_REQUESTS_SQL = """SELECT page_id AS request_id, url FROM pages UNION ALL SELECT page_id + 1000000000,
    upper(regexp_extract(url, '^([a-z]+://[^/]*)', 1)) || url[length(regexp_extract(url, '^([a-z]+://[^/]*)', 1)) + 1:]
    FROM pages WHERE page_id % 3 = 0""" + "".join(
    f""" UNION ALL SELECT page_id + {n}000000000, url || CASE WHEN contains(url, '?') THEN '&' ELSE '?' END || '{query}'
    FROM pages WHERE page_id % 5 = 1""" for n, query in enumerate(SPELLINGS, 2))
KEYS_SQL = f"""SELECT request_id, norm_url, sha256('GET' || norm_url) AS key FROM ({normal_sql(PAGE_REQUESTS_SQL)})"""


@query("h2_request_key", KEYS_SQL)
def h2(spark, sf):
    return req.with_request_key(page_requests(spark, sf)).select("request_id", "norm_url", "key")


@query("h2_request_key_with_body", """SELECT event_id AS request_id, sha256('POST' || 'https://svc.example.org/'
    || event_type || 'k=' || json_extract_string(props, '$.k') || '&user=' || user_id) AS key FROM events""")
def h2_body(spark, sf):
    rows = ly.table(spark, sf, "events").select(
        F.col("event_id").alias("request_id"), F.lit("POST").alias("method"),
        F.concat(F.lit("HTTPS://svc.example.org:443/"), F.col("event_type")).alias("url"),
        F.create_map(F.lit("user"), F.col("user_id").cast("string"),
                     F.lit("k"), F.get_json_object("props", "$.k")).alias("data"))
    return req.with_request_key(rows).select("request_id", "key")


@query("h3_normalize_urls", f"""SELECT request_id, scheme || '://' || host || path || '?' || array_to_string(
    list_sort(pairs || ['a=' || request_id, 'z=1']), '&')
    AS norm_url FROM ({normal_sql(PAGE_REQUESTS_SQL)})""")
def h3(spark, sf):
    extra = F.create_map(F.lit("z"), F.lit("1"), F.lit("a"), F.col("request_id").cast("string"))
    return req.normalize_urls(
        page_requests(spark, sf).withColumn("params", extra), "url", "params"
    ).select("request_id", "norm_url")


@query("h4_check_requests", """SELECT event_id AS request_id, CASE WHEN event_id % 10 = 3 THEN 'parts: param'
    WHEN event_id % 10 = 6 THEN 'method' END AS reason FROM events""")
def h4(spark, sf):
    k = F.col("event_id") % 10
    part = F.when(k == 3, "param").when(k == 4, "headers").otherwise("params")
    rows = ly.table(spark, sf, "events").select(
        F.col("event_id").alias("request_id"), F.lit("https://svc.example.org").alias("url"),
        F.when(k == 6, "PATCH").when(k == 7, "post").otherwise("GET").alias("method"),
        F.create_map(part, F.col("props")).alias("parts"))
    return req.check_requests(rows).select("request_id", "reason")


@query("h4_check_lengths", """SELECT user_id, CASE WHEN user_id % 4 = 1 THEN 'urls/kwds' END AS reason
    FROM (SELECT DISTINCT user_id FROM events)""")
def h4_lengths(spark, sf):
    jobs = ly.table(spark, sf, "events").select("user_id").distinct().select(
        "user_id", F.array_repeat(F.lit("u"), 2).alias("urls"),
        F.when(F.col("user_id") % 4 == 1, F.array_repeat(F.lit("k"), 1)).when(
            F.col("user_id") % 4 == 2, F.array_repeat(F.lit("k"), 2)).alias("kwds"))
    return req.check_lengths(jobs).select("user_id", "reason")


@query("h5_dedupe_requests", f"""SELECT key, min(request_id) AS request_id, count(*) AS n_requests
    FROM ({KEYS_SQL}) GROUP BY key""")
def h5(spark, sf):
    return req.dedupe_requests(page_requests(spark, sf)).select("key", "request_id", "n_requests")


CACHE_SIDES_SQL = """SELECT *, ts < (SELECT min(ts) + (max(ts) - min(ts)) / 2 FROM events) AS cached FROM events"""


@query("h6_cache_lookup", f"""SELECT q.event_id AS request_id, q.user_id, q.event_type, q.ts, c.event_id AS cache_id,
    c.ts AS cache_ts, CASE WHEN c.ts IS NULL THEN 'miss' WHEN epoch_us(q.ts) - epoch_us(c.ts) <= 604800000000 THEN 'hit'
    ELSE 'expired' END AS status FROM (SELECT * FROM ({CACHE_SIDES_SQL}) WHERE NOT cached) q
    ASOF LEFT JOIN (SELECT * FROM ({CACHE_SIDES_SQL}) WHERE cached) c
    ON q.user_id = c.user_id AND q.event_type = c.event_type AND q.ts >= c.ts""")
def h6(spark, sf):
    events = ly.table(spark, sf, "events")
    middle = events.agg((F.min("ts") + (F.max("ts") - F.min("ts")) / 2).alias("mid")).first().mid
    cache = events.where(F.col("ts") < F.lit(middle)).select(
        F.col("event_id").alias("cache_id"), "user_id", "event_type", "ts")
    asked = events.where(F.col("ts") >= F.lit(middle)).select(
        F.col("event_id").alias("request_id"), "user_id", "event_type", "ts")
    return req.cache_lookup(asked, cache, ["user_id", "event_type"])


def error_replies(spark, sf):
    k = F.col("event_id") % 5
    word = F.concat(F.lit("code "), (F.col("user_id") % 7).cast("string"))
    return ly.table(spark, sf, "events").where("event_type = 'error'").select(
        F.col("event_id").alias("request_id"),
        F.when(k == 0, F.concat(F.lit("plain "), word))
        .when(k == 1, F.concat(F.lit("<R><a>x</a><b><c> deep "), word, F.lit("</c><d>no</d></b></R>")))
        .when(k == 2, F.concat(F.lit("<R><a><z>y</z></a><b>wide "), word, F.lit("</b></R>")))
        .when(k == 3, F.concat(F.lit("<R>root "), word, F.lit("</R>")))
        .otherwise("<a><b>").alias("reply"))


@query("h7_error_report", """SELECT CASE k WHEN 4 THEN '<a><b>' ELSE ['plain', 'deep', 'wide', 'root'][k + 1] || ' code ' ||
    w END AS message, count(*) AS n_replies, min(event_id) AS first_request FROM (
    SELECT event_id, event_id % 5 AS k, user_id % 7 AS w FROM events WHERE event_type = 'error') GROUP BY 1""")
def h7(spark, sf):
    return req.error_report(error_replies(spark, sf))


def hit_replies(spark, sf):
    counted = ly.sites(spark, sf).groupBy("nation_id").agg(F.count(F.lit(1)).alias("n"))
    return counted.select(
        F.col("nation_id").alias("layer"),
        F.when(F.col("nation_id") == 7, "<Exception>no such layer</Exception>").otherwise(
            F.concat(F.lit('<FeatureCollection numberMatched="'), F.col("n").cast("string"),
                     F.lit('" numberReturned="0"/>'))).alias("reply"))


@query("h8_parse_hits", f"""SELECT nation_id AS layer, CASE WHEN nation_id <> 7 THEN count(*) END AS hits,
    CASE WHEN nation_id = 7 THEN '<Exception>no such layer</Exception>' END AS error
    FROM ({SITES_SQL}) GROUP BY nation_id""")
def h8(spark, sf):
    return req.parse_hits(hit_replies(spark, sf)).select("layer", "hits", "error")


@query("h8_pages_from_hits", f"""SELECT layer, hits, n_errors, start_index, CASE WHEN hits <= 25 THEN hits ELSE 25 END
    AS page_size, 'count' AS count_key FROM (SELECT nation_id AS layer, count(*) AS hits, 0 AS n_errors
    FROM ({SITES_SQL}) WHERE nation_id <> 7 GROUP BY nation_id),
    LATERAL (SELECT unnest(generate_series(0, hits - 1, 25)) AS start_index)""")
def h8_pages(spark, sf):
    return paging.page_plan(req.hits_per_layer(req.parse_hits(hit_replies(spark, sf))), 25)


SERVICE_URLS_SQL = """SELECT page_id, regexp_extract(url, '^([a-z]+://[^/]*)', 1) || '/rest/' || CASE page_id % 4
    WHEN 0 THEN (page_id % 6)::VARCHAR WHEN 1 THEN (page_id % 6) || '/' WHEN 2 THEN 'MapServer' ELSE '3' END AS url,
    CASE WHEN page_id % 4 = 3 AND page_id % 8 = 3 THEN 9 END AS given FROM pages"""


def service_urls(spark, sf):
    k = F.col("page_id")
    host = F.regexp_extract("url", "^([a-z]+://[^/]*)", 1)
    tail = (F.when(k % 4 == 0, (k % 6).cast("string")).when(k % 4 == 1, F.concat(
        (k % 6).cast("string"), F.lit("/"))).when(k % 4 == 2, "MapServer").otherwise("3"))
    return ly.table(spark, sf, "pages").select(
        "page_id", F.concat(host, F.lit("/rest/"), tail).alias("url"),
        F.when((k % 4 == 3) & (k % 8 == 3), 9).alias("given"))


@query("h9_requests_by_layer", f"""SELECT CASE WHEN given IS NULL AND num IS NOT NULL THEN
    regexp_replace(bare, '/[^/]*$', '') ELSE bare END AS service, coalesce(given, num) AS layer_no,
    count(*) AS n_requests FROM (SELECT *, TRY_CAST(regexp_extract(bare, '/([^/]*)$', 1) AS INT) AS num FROM (
    SELECT *, regexp_replace(url, '/+$', '') AS bare FROM ({SERVICE_URLS_SQL}))) GROUP BY 1, 2""")
def h9(spark, sf):
    return req.by_layer(service_urls(spark, sf), layer="given")


@query("a7_output_names", f"SELECT request_id, 'tile_' || key || '.tiff' AS file_name FROM ({KEYS_SQL})")
def a7(spark, sf):
    return req.with_output_name(page_requests(spark, sf), "tile_", ".tiff").select(
        "request_id", "file_name")
