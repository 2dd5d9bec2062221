"""Sources, metadata, retrieval by id, batches and pages."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F


from geolayer.layer import LayerInfo
from geolayer.operators import paging, retrieve
from geolayer.operators import requests as req
from geolayer.operators import select as sel
from geolayer.session import work_dir
from geolayer.sources import catalog, fetch, layers as src, pages as pg
from workloads import layers as ly
from workloads.layers import REACHES, REACHES_SQL, SITES, SITES_SQL
from workloads.registry import query
from workloads.selection import ORDERS

CUSTOMER = LayerInfo("c_custkey", aliases={"Balance": "c_acctbal"})
PAGE = 50


@query("a1_read_layer", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def a1(spark, sf):
    return src.read_layer(
        spark, f"{sf}/customer.parquet", CUSTOMER,
        schema="c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
        outfields=["c_custkey", "c_name", "Balance"])


def json_pages(spark, sf):
    """Pages of fifty sites; every seventh page is an error reply."""
    feature = F.struct(
        F.struct("site_id", "segment").alias("attributes"),
        F.struct(F.col("lon").alias("x"), F.col("lat").alias("y")).alias("geometry"))
    paged = ly.sites(spark, sf).groupBy(F.floor(F.col("site_id") / PAGE).alias("request_id")).agg(
        F.sort_array(F.collect_list(feature)).alias("features"),
        F.array_join(F.transform(F.sort_array(F.collect_list("site_id")),
                                 lambda i: i.cast("string")), ",").alias("object_ids"))
    good = F.to_json(F.struct("features"))
    bad = F.concat(F.lit('{"error":{"message":"bad batch '), F.col("request_id").cast("string"),
                   F.lit('"}}'))
    return paged.select(
        "request_id", "object_ids",
        F.when(F.col("request_id") % 7 == 3, bad).otherwise(good).alias("payload"))


@query("a2_features_from_json_pages", f"""SELECT site_id // {PAGE} AS request_id, site_id, segment,
    lon AS x, lat AS y FROM ({SITES_SQL}) WHERE (site_id // {PAGE}) % 7 <> 3""")
def a2(spark, sf):
    found = pg.features_from_pages(
        json_pages(spark, sf).select("request_id", "payload"), "site_id:bigint,segment:string")
    spot = F.col("geom.parts")[0][0]
    return found.select("request_id", "site_id", "segment", spot.x.alias("x"), spot.y.alias("y"))


@query("a2_features_from_geojson_pages", f"""SELECT reach_id, name, x0, y0, x2, y2
    FROM ({REACHES_SQL})""")
def a2_geojson(spark, sf):
    coords = F.transform(F.col("geom.parts")[0], lambda v: F.array(v.x, v.y))
    feature = F.struct(
        F.struct("reach_id", "name").alias("properties"),
        F.struct(F.lit("LineString").alias("type"), coords.alias("coordinates")).alias("geometry"))
    paged = ly.reaches(spark, sf).groupBy(F.floor(F.col("reach_id") / PAGE).alias("page")).agg(
        F.collect_list(feature).alias("features")).select(
        "page", F.to_json(F.struct("features")).alias("payload"))
    found = pg.features_from_pages(paged, "reach_id:bigint,name:string")
    path = F.col("geom.parts")[0]
    return found.select("reach_id", "name", path[0].x.alias("x0"), path[0].y.alias("y0"),
                        path[2].x.alias("x2"), path[2].y.alias("y2"))


@query("a2_features_with_measure", f"""SELECT reach_id, e.place, e.x, e.y, CASE WHEN (reach_id // {PAGE}) % 2 = 0
    THEN e.m END AS m FROM (SELECT reach_id, unnest([{{'place': 0, 'x': x0, 'y': y0, 'm': 0.0::DOUBLE}},
    {{'place': 1, 'x': x1, 'y': y1, 'm': 50.0}}, {{'place': 2, 'x': x2, 'y': y2, 'm': 100.0}}]) AS e
    FROM ({REACHES_SQL}))""")
def a2_measure(spark, sf):
    """Pages with heights; every second one has measures too."""
    page = F.floor(F.col("reach_id") / PAGE)
    measured = page % 2 == 0
    spot = F.transform(F.col("geom.parts")[0], lambda v: F.when(
        measured, F.array(v.x, v.y, F.lit(7.0), v.m)).otherwise(F.array(v.x, v.y, F.lit(7.0))))
    feature = F.struct(F.struct("reach_id").alias("attributes"), F.struct(F.array(spot).alias("paths")).alias("geometry"))
    paged = ly.reaches(spark, sf).groupBy(page.alias("page")).agg(F.collect_list(feature).alias("features")).select(
        "page", F.to_json(F.struct(F.lit(True).alias("hasZ"), (F.col("page") % 2 == 0).alias("hasM"), "features")).alias(
            "payload"))
    found = pg.features_from_pages(paged, "reach_id:bigint")
    return found.select("reach_id", F.posexplode(F.col("geom.parts")[0]).alias("place", "v")).select(
        "reach_id", "place", "v.x", "v.y", "v.m")


@query("a2_page_report", f"""SELECT request_id, CASE WHEN reason IS NULL THEN n ELSE 0 END AS n_features, reason FROM (
    SELECT site_id // {PAGE} AS request_id, count(*) AS n, CASE WHEN any_value(site_id // {PAGE}) % 5 = 2 THEN 'not JSON'
    WHEN any_value(site_id // {PAGE}) % 7 = 3 THEN 'error reply' END AS reason FROM ({SITES_SQL}) GROUP BY 1)""")
def a2_report(spark, sf):
    """Every fifth page was cut off in transit."""
    cut = F.when(F.col("request_id") % 5 == 2, F.expr("left(payload, length(payload) - 3)")).otherwise(F.col("payload"))
    pages = json_pages(spark, sf).select("request_id", cut.alias("payload"))
    return pg.page_report(pages)


@query("a3_quoted_csv_pages", f"""SELECT reach_id, size, CASE reach_id % 3 WHEN 0 THEN name || ', "said"'
    WHEN 1 THEN name || chr(10) || 'two' ELSE name END AS name,
    CASE WHEN (reach_id // {PAGE}) % 2 = 0 THEN ftype END AS ftype FROM ({REACHES_SQL})""")
def a3_quoted(spark, sf):
    """Values with commas, quotes and line breaks; every second page has other columns in another order."""
    k = F.col("reach_id") % 3
    name = F.when(k == 0, F.concat("name", F.lit(', "said"'))).when(
        k == 1, F.concat("name", F.lit("\ntwo"))).otherwise(F.col("name"))
    quoted = F.concat(F.lit('"'), F.replace(name, F.lit('"'), F.lit('""')), F.lit('"'))
    page = F.floor(F.col("reach_id") / PAGE)
    first = F.concat_ws(",", "reach_id", quoted, "size", "ftype")
    other = F.concat_ws(",", "size", F.lit('"x,y"'), quoted, "reach_id")
    rows = ly.reaches(spark, sf).select(page.alias("page"), F.when(page % 2 == 0, first).otherwise(other).alias("line"))
    head = F.when(F.col("page") % 2 == 0, "reach_id,name,size,ftype").otherwise("SIZE,extra,Name,reach_id")
    paged = rows.groupBy("page").agg(F.array_join(F.collect_list("line"), "\r\n").alias("lines")).select(
        "page", F.concat(head, F.lit("\r\n"), "lines").alias("payload"))
    return pg.rows_from_csv_pages(paged, "reach_id bigint, size int, name string, ftype string").drop("page")


@query("a3_rows_from_csv_pages", f"SELECT site_id, segment, lon, lat FROM ({SITES_SQL})")
def a3(spark, sf):
    row = F.concat_ws(",", "site_id", "segment", "lon", "lat")
    paged = ly.sites(spark, sf).groupBy(F.floor(F.col("site_id") / PAGE).alias("page")).agg(
        F.concat(F.lit("site_id,segment,lon,lat\n"),
                 F.array_join(F.collect_list(row), "\n"), F.lit("\n")).alias("payload"))
    return pg.rows_from_csv_pages(
        paged, "site_id bigint, segment string, lon double, lat double"
    ).select("site_id", "segment", "lon", "lat")


@query("a4_fetch_pages", """SELECT w.page_id AS request_id, CASE WHEN s.html IS NULL THEN 'failed' ELSE 'ok' END AS status,
    sha256(s.html) AS payload_sha256, CASE WHEN s.html IS NULL THEN 'no reply stored for ' || w.url END AS error
    FROM pages w LEFT JOIN (SELECT url, min(html) AS html FROM pages WHERE page_id % 11 <> 5 GROUP BY url) s
    ON w.url = s.url""")
def a4(spark, sf):
    """Requests for all pages, of which a part was never stored."""
    pages = ly.table(spark, sf, "pages")
    wanted = pages.select(F.col("page_id").alias("request_id"), "url")
    replies = fetch.stored_pages(wanted, pages.where("page_id % 11 <> 5"), payload="html")
    return replies.select(
        "request_id", "status", F.sha2("payload", 256).alias("payload_sha256"), "error")


@query("a5_write_layer", f"""SELECT segment, count(*) AS n, round(sum(acctbal), 2) AS total
    FROM ({SITES_SQL}) GROUP BY segment""")
def a5(spark, sf):
    path = os.path.join(work_dir(spark), f"layer-{uuid.uuid4().hex}")
    spots = ly.sites(spark, sf)
    src.write_layer(spots, path, "segment")
    src.write_layer(spots.where("segment = 'BUILDING'"), path, "segment")
    return src.read_layer(spark, path).groupBy("segment").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("acctbal"), 2).alias("total"))


@query("a6_manifest_todo", """SELECT 'f' || o_orderkey AS name, o_custkey AS size,
    CASE WHEN o_orderkey % 4 = 0 THEN 'absent' ELSE 'size' END AS reason FROM orders
    WHERE o_orderkey % 4 IN (0, 1)""")
def a6(spark, sf):
    files = ly.table(spark, sf, "orders").select(
        F.concat(F.lit("f"), F.col("o_orderkey").cast("string")).alias("name"),
        F.col("o_custkey").alias("size"), F.col("o_orderkey").alias("k"))
    held = files.where("k % 4 <> 0").select(
        "name", F.when(F.col("k") % 4 == 1, F.col("size") + 1).otherwise(F.col("size")).alias("size"))
    return req.manifest_todo(files.drop("k"), held)


@query("b1_describe_layer", """SELECT 'c_custkey' AS field, 'c_custkey' AS alias, 'oid' AS type,
    false AS is_geometry, count(*) AS n_rows, count(*) - count(c_custkey) AS n_nulls FROM customer
    UNION ALL SELECT 'c_name', 'c_name', 'string', false, count(*), count(*) - count(c_name) FROM customer
    UNION ALL SELECT 'c_nationkey', 'c_nationkey', 'integer', false, count(*), count(*) - count(c_nationkey) FROM customer
    UNION ALL SELECT 'c_acctbal', 'Balance', 'double', false, count(*), count(*) - count(c_acctbal) FROM customer
    UNION ALL SELECT 'c_mktsegment', 'c_mktsegment', 'string', false, count(*), count(*) - count(c_mktsegment) FROM customer""")
def b1(spark, sf):
    return src.describe_layer(ly.table(spark, sf, "customer"), CUSTOMER)


@query("b2_layer_extent", f"""SELECT min(lon) AS west, min(lat) AS south, max(lon) AS east,
    max(lat) AS north FROM ({SITES_SQL})""")
def b2(spark, sf):
    return src.layer_extent(ly.sites(spark, sf), SITES)


@query("b3_feature_types", "SELECT DISTINCT p_size AS id, p_type AS name FROM part")
def b3(spark, sf):
    return src.feature_types(ly.table(spark, sf, "part"), "p_size", "p_type")


def capability_docs(spark, sf):
    """One document per region, listing its nations as layers on levels two to four."""
    layer = F.concat(
        F.lit("<Layer><Name>"), F.col("n_name"), F.lit("</Name><Title>Title of "), F.col("n_name"),
        F.lit("</Title><CRS>EPSG:"), (F.lit(26901) + F.col("n_nationkey") % 20).cast("string"),
        F.lit("</CRS></Layer>"))
    for k in (1, 2, 2):
        layer = F.when(F.col("n_nationkey") % 3 == k, F.concat(
            F.lit("<Layer><Title>group</Title>"), layer, F.lit("</Layer>"))).otherwise(layer)
    nations = ly.table(spark, sf, "nation").groupBy("n_regionkey").agg(
        F.array_join(F.sort_array(F.collect_list(layer)), "").alias("layers"))
    return nations.select(
        F.col("n_regionkey").alias("doc_id"),
        F.concat(
            F.lit('<WMS_Capabilities xmlns="http://www.opengis.net/wms" version="1.3.0"><Capability>'
                  "<Request><GetMap><Format>image/PNG</Format><Format>image/tiff</Format></GetMap>"
                  "</Request><Layer><Title>all</Title><CRS>EPSG:4326</CRS>"),
            F.col("layers"), F.lit("</Layer></Capability></WMS_Capabilities>")).alias("xml"))


CATALOG_SQL = """SELECT n_regionkey AS doc_id, n_name AS layer, 'Title of ' || n_name AS title,
    'epsg:' || (26901 + n_nationkey % 20) AS own FROM nation"""


@query("b4_catalog_from_xml", f"""SELECT doc_id, layer, title, own || ',epsg:4326' AS crs,
    'image/png,image/tiff' AS formats FROM ({CATALOG_SQL})""")
def b4(spark, sf):
    found = catalog.catalog_from_xml(capability_docs(spark, sf))
    return found.select("doc_id", "layer", "title", F.array_join("crs", ",").alias("crs"),
                        F.array_join("formats", ",").alias("formats"))


def option_requests(spark, sf):
    """A request per order, asking one of the layers in some format and CRS."""
    k = F.col("o_orderkey")
    names = ly.table(spark, sf, "nation").select("n_nationkey", "n_name")
    asked = ly.table(spark, sf, "orders").select(
        k.alias("request_id"), (k % 25).cast("int").alias("n_nationkey"),
        F.when(k % 9 == 1, "image/GIF").otherwise("image/TIFF").alias("outformat"),
        F.when(k % 8 == 3, "EPSG:26915").otherwise("epsg:4326").alias("crs"))
    return asked.join(names, "n_nationkey").select(
        "request_id", F.when(F.col("request_id") % 13 == 2, "nowhere").otherwise(
            F.col("n_name")).alias("layer"), "outformat", "crs")


@query("b5_check_options", f"""SELECT request_id, CASE WHEN k13 = 2 THEN 'layer' WHEN k9 = 1 THEN 'outformat'
    WHEN k8 = 3 AND own <> 'epsg:26915' THEN 'crs' END AS reason,
    CASE WHEN k13 = 2 THEN NULL WHEN k9 = 1 THEN 'image/png, image/tiff'
    WHEN k8 = 3 AND own <> 'epsg:26915' THEN own || ', epsg:4326' END AS valid FROM (
    SELECT o_orderkey AS request_id, o_orderkey % 13 AS k13, o_orderkey % 9 AS k9,
      o_orderkey % 8 AS k8, own FROM orders JOIN nation ON o_orderkey % 25 = n_nationkey
      JOIN ({CATALOG_SQL}) c ON c.layer = n_name)""")
def b5(spark, sf):
    offered = catalog.catalog_from_xml(capability_docs(spark, sf))
    return catalog.check_options(option_requests(spark, sf), offered).select(
        "request_id", "reason", "valid")


@query("b6_hits", "SELECT count(*) AS hits FROM lineitem WHERE l_quantity < 10 AND l_tax > 0.02")
def b6(spark, sf):
    return sel.hits(ly.table(spark, sf, "lineitem"), "l_quantity < 10 AND l_tax > 0.02D")


@query("d1_partition_ids", """SELECT batch, string_agg(id::VARCHAR, ',' ORDER BY id) AS ids,
    count(*) AS n FROM (SELECT id, (row_number() OVER (ORDER BY id) - 1) // 1000 AS batch
    FROM (SELECT DISTINCT l_orderkey AS id FROM lineitem)) GROUP BY batch""")
def d1(spark, sf):
    batches = paging.partition_ids(ly.table(spark, sf, "lineitem"), "l_orderkey", 1000)
    return batches.select("batch", F.array_join("ids", ",").alias("ids"),
                          F.size("ids").cast("bigint").alias("n"))


@query("d2_page_plan", f"""SELECT nation_id, hits, start_index, CASE WHEN hits <= 20 THEN hits ELSE 20 END
    AS page_size, 'count' AS count_key FROM (SELECT nation_id, count(*) AS hits FROM ({SITES_SQL})
    GROUP BY nation_id), LATERAL (SELECT unnest(generate_series(0, hits - 1, 20)) AS start_index)""")
def d2(spark, sf):
    counted = ly.sites(spark, sf).groupBy("nation_id").agg(F.count(F.lit(1)).alias("hits"))
    return paging.page_plan(counted, 20)


@query("d3_read_page", """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    ORDER BY o_custkey, o_orderkey LIMIT 250 OFFSET 500""")
def d3(spark, sf):
    orders = ly.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return paging.read_page(orders, ORDERS, 500, 250, "o_custkey")


@query("d3_all_pages", """SELECT o_orderkey, o_custkey, rn, (rn - 1) // 1000 AS page FROM (
    SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY o_custkey, o_orderkey) AS rn FROM orders)""")
def d3_all(spark, sf):
    orders = ly.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return paging.all_pages(orders, ORDERS, "o_custkey").select(
        "o_orderkey", "o_custkey", "rn", "page")


@query("d3_pages_of_a_box", f"""SELECT site_id, acctbal, rn, (rn - 1) // 100 AS page FROM (
    SELECT site_id, acctbal, row_number() OVER (ORDER BY acctbal, site_id) AS rn FROM ({SITES_SQL})
    WHERE lon BETWEEN -110.5 AND -80.5 AND lat BETWEEN 28.25 AND 41.75)""")
def d3_box(spark, sf):
    info = LayerInfo("site_id", kind="point", max_nrecords=100)
    inside = sel.features_by_box(ly.sites(spark, sf), info, (-110.5, 28.25, -80.5, 41.75))
    return paging.all_pages(inside.select("site_id", "acctbal"), info, "acctbal")


@query("d3_pages_of_ids", """SELECT o_orderkey, o_custkey, (row_number() OVER (ORDER BY o_custkey, o_orderkey) - 1)
    // 1000 AS page FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""")
def d3_ids(spark, sf):
    wanted = ly.table(spark, sf, "customer").where("c_acctbal < 0").select("c_custkey")
    found = sel.features_by_id(
        ly.table(spark, sf, "orders").select("o_orderkey", "o_custkey"), ORDERS, "o_custkey", wanted)
    return paging.all_pages(found, ORDERS, "o_custkey").select("o_orderkey", "o_custkey", "page")


@query("d4_row_number", """SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey,
    row_number() OVER (ORDER BY l_suppkey, l_orderkey, l_linenumber, l_partkey) AS rn FROM lineitem""")
def d4(spark, sf):
    rows = ly.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")
    return paging.with_row_number(rows, ["l_suppkey", "l_orderkey", "l_linenumber", "l_partkey"])


@query("d5_distinct_ids", "SELECT DISTINCT l_partkey FROM lineitem")
def d5(spark, sf):
    return paging.distinct_ids(ly.table(spark, sf, "lineitem"), "l_partkey")


@query("e1_get_features", f"""SELECT site_id, segment, radians(lon)*6378137.0 AS x,
    ln(tan(pi()/4 + radians(lat)/2))*6378137.0 AS y FROM (
    SELECT site_id, segment, lon, lat FROM ({SITES_SQL}) WHERE site_id IN (SELECT o_custkey FROM orders
    WHERE o_totalprice > 400000))""".replace("radians(lon)*6378137.0", "round(radians(lon)*6378137.0, 3)")
    .replace("ln(tan(pi()/4 + radians(lat)/2))*6378137.0",
             "round(ln(tan(pi()/4 + radians(lat)/2))*6378137.0, 3)"))
def e1(spark, sf):
    wanted = ly.table(spark, sf, "orders").where("o_totalprice > 400000").select("o_custkey")
    found = retrieve.get_features(
        ly.sites(spark, sf), SITES, wanted, ["site_id", "segment"], out_crs=3857)
    spot = F.col("geom.parts")[0][0]
    return found.select("site_id", "segment", F.round(spot.x, 3).alias("x"), F.round(spot.y, 3).alias("y"))


@query("e1_get_features_with_measure", f"""SELECT reach_id, ftype, x1 AS x, y1 AS y, 50.0::DOUBLE AS m
    FROM ({REACHES_SQL}) WHERE reach_id IN (SELECT l_partkey FROM lineitem WHERE l_quantity = 50)""")
def e1_measure(spark, sf):
    wanted = ly.table(spark, sf, "lineitem").where("l_quantity = 50").select("l_partkey")
    found = retrieve.get_features(
        ly.reaches(spark, sf), REACHES, wanted, ["reach_id", "ftype"], return_m=True)
    mid = F.col("geom.parts")[0][1]
    return found.select("reach_id", "ftype", mid.x.alias("x"), mid.y.alias("y"), mid.m.alias("m"))


@query("e2_select_fields", "SELECT c_acctbal, c_name FROM customer")
def e2(spark, sf):
    return retrieve.select_fields(ly.table(spark, sf, "customer"), ["Balance", "c_name"], CUSTOMER)


@query("e3_missing_ids", """SELECT DISTINCT l_suppkey + l_linenumber * 37 AS s_suppkey FROM lineitem
    WHERE l_suppkey + l_linenumber * 37 NOT IN (SELECT s_suppkey FROM supplier)""")
def e3(spark, sf):
    wanted = ly.table(spark, sf, "lineitem").select(
        (F.col("l_suppkey") + F.col("l_linenumber") * 37).alias("id"))
    return retrieve.missing_ids(wanted, ly.table(spark, sf, "supplier"), "s_suppkey")


@query("e3_missing_report", """SELECT count(*) AS n_requested, count(s_suppkey) AS n_found,
    count(*) - count(s_suppkey) AS n_missing FROM (SELECT DISTINCT l_suppkey + l_linenumber * 37 AS id
    FROM lineitem) LEFT JOIN supplier ON s_suppkey = id""")
def e3_report(spark, sf):
    wanted = ly.table(spark, sf, "lineitem").select(
        (F.col("l_suppkey") + F.col("l_linenumber") * 37).alias("id"))
    return retrieve.missing_report(wanted, ly.table(spark, sf, "supplier"), "s_suppkey")


@query("e4_split_responses", f"""SELECT request_id, request_id % 7 = 3 AS failed, CASE WHEN
    request_id % 7 = 3 THEN 'bad batch ' || request_id END AS message FROM (
    SELECT DISTINCT site_id // {PAGE} AS request_id FROM ({SITES_SQL}))""")
def e4(spark, sf):
    return retrieve.split_responses(json_pages(spark, sf)).select("request_id", "failed", "message")


@query("e4_first_error", f"""SELECT count(*) AS n_replies, count_if(request_id % 7 = 3) AS n_failed,
    'bad batch ' || min(CASE WHEN request_id % 7 = 3 THEN request_id END) AS message FROM (
    SELECT DISTINCT site_id // {PAGE} AS request_id FROM ({SITES_SQL}))""")
def e4_first(spark, sf):
    return retrieve.first_error(retrieve.split_responses(json_pages(spark, sf)))


@query("e5_failed_ids", f"SELECT site_id AS id FROM ({SITES_SQL}) WHERE (site_id // {PAGE}) % 7 = 3")
def e5(spark, sf):
    replies = json_pages(spark, sf)
    return retrieve.failed_ids(
        retrieve.split_responses(replies), replies.select("request_id", "object_ids"))


@query("e6_retry_plan", f"""SELECT round, size AS batch_size, batch, count(*) AS n, min(id) AS lo, max(id) AS hi
    FROM (SELECT id, r.round, r.size, (row_number() OVER (PARTITION BY r.round ORDER BY id) - 1) // r.size
    AS batch FROM (SELECT site_id AS id FROM ({SITES_SQL}) WHERE (site_id // {PAGE}) % 7 = 3),
    (VALUES (1, 50), (2, 33), (3, 17), (4, 1)) AS r(round, size)) GROUP BY 1, 2, 3""")
def e6(spark, sf):
    replies = json_pages(spark, sf)
    failed = retrieve.failed_ids(
        retrieve.split_responses(replies), replies.select("request_id", "object_ids"))
    ids = F.transform("ids", lambda i: i.cast("bigint"))
    return retrieve.retry_plan(failed, 100).select(
        "round", "batch_size", "batch", F.size("ids").cast("bigint").alias("n"),
        F.array_min(ids).alias("lo"), F.array_max(ids).alias("hi"))


@query("e7_fetch_features", f"""SELECT site_id, site_id % 97 <> 13 AND site_id % 89 <> 7 AS found,
    CASE WHEN site_id % 97 <> 13 AND site_id % 89 <> 7 THEN segment END AS segment FROM ({SITES_SQL})""")
def e7(spark, sf):
    """Sites asked for by id; some are not held, and some spoil the batch that asks for them."""
    spots = ly.sites(spark, sf)
    stored = spots.where("site_id % 89 <> 7").select(
        "site_id", F.to_json(F.struct(F.struct("site_id", "segment").alias("attributes"))).alias("feature"),
        F.when(F.col("site_id") % 97 == 13, "bad id in batch").alias("error"))
    good, missing = retrieve.fetch_features(
        spots.select(F.col("site_id").alias("id")), max_nrecords=100,
        replies=fetch.stored_features(stored, "site_id", error="error"),
        id_path=["features", "attributes", "site_id"])
    rows = pg.features_from_pages(good, "site_id:bigint,segment:string").select(
        "site_id", F.lit(True).alias("found"), "segment")
    return rows.unionByName(missing.select(
        F.col("id").alias("site_id"), F.lit(False).alias("found"), F.lit(None).cast("string").alias("segment")))
