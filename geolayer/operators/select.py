"""Selecting features by fields, clauses, boxes and geometry."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geolayer.errors import InputTypeError, InputValueError, ZeroMatchedError
from geolayer.functions import crs, pair_tests, relate
from geolayer.functions import geometry as g
from geolayer.functions.sql import each, keep, let, num, some, struct
from geolayer.layer import LayerInfo, geometry_column, resolve_field
from geolayer.plans.block_join import block_pairs
from geolayer.plans.bounded import Size, measure, spread
from geolayer.plans.long_rings import LONG_RING, WHOLE_RING, spots_in_areas, spots_in_rings
from geolayer.plans.spatial_join import FINEST, candidate_pairs, level_of

# Longest id list written into the filter itself; longer ones become a join table.
MAX_LITERAL_IDS = 1000
# Most query geometries for the relations whose answer is nearly every pair.
MAX_COMPLEMENT_QUERIES = 1000
# Longest query table tested row by row; longer ones meet the features block by block.
MAX_ROWWISE_QUERIES = 256
# Most of their vertices that are held as one value; the same pairs come back beyond it.
MAX_COMPLEMENT_VERTICES = 50_000

# Relation names of the id selection; the query geometry is the first operand.
SPATIAL_RELATIONS = (
    "esriSpatialRelIntersects", "esriSpatialRelContains", "esriSpatialRelCrosses",
    "esriSpatialRelEnvelopeIntersects", "esriSpatialRelIndexIntersects",
    "esriSpatialRelOverlaps", "esriSpatialRelTouches", "esriSpatialRelWithin",
    "esriSpatialRelRelation",
)
# Predicate names of the feature selection; the feature is the first operand.
PREDICATES = (
    "EQUALS", "DISJOINT", "INTERSECTS", "TOUCHES", "CROSSES", "WITHIN", "CONTAINS", "OVERLAPS",
    "RELATE", "BEYOND",
)

Relation = Callable[[str, str, float], str]
# A relation with the feature first, its pattern, and whether the pattern has the feature first.
Named = tuple[str, str | None, bool]


def matched(df: DataFrame, require_match: bool, detail: str | None = None) -> DataFrame:
    """``df`` as it is; with ``require_match`` an empty one is an error."""
    if require_match and not df.limit(1).count():
        raise ZeroMatchedError(detail)
    return df


def id_table(spark: SparkSession, ids: object, dtype: T.DataType, name: str) -> DataFrame:
    """Distinct ids as a one-column table, cast to the type of the column they select on."""
    if isinstance(ids, DataFrame):
        source = "feature_id" if "feature_id" in ids.columns else ids.columns[0]
        table = ids.select(F.col(source).try_cast(dtype).alias(name))
    else:
        listed = [ids] if isinstance(ids, (str, int)) else list(ids)
        table = spark.createDataFrame([(str(i),) for i in listed], f"{name} string").select(
            F.col(name).try_cast(dtype).alias(name))
    return table.where(F.col(name).isNotNull()).distinct()


def where_in(df: DataFrame, column: str, ids: object) -> DataFrame:
    """Rows whose ``column`` is among ``ids``: a literal list when short, else a semi join.

    However long the list, its values are read as text and cast to the column's type by Spark's
    ``try_cast``; what does not fit (``1_0``, too large a number, a bad date) selects nothing.
    """
    dtype = df.schema[column].dataType
    if not isinstance(ids, DataFrame):
        listed = [ids] if isinstance(ids, (str, int)) else list(dict.fromkeys(ids))
        if len(listed) <= MAX_LITERAL_IDS:
            return df.where(F.col(column).isin([F.lit(str(i)).try_cast(dtype) for i in listed]))
        ids = listed
    wanted = id_table(df.sparkSession, ids, dtype, "_wanted")
    return df.join(wanted, F.col(column) == F.col("_wanted"), "left_semi")


def ids_by_field(
    df: DataFrame, info: LayerInfo, field: str, ids: object, require_match: bool = False
) -> DataFrame:
    """Ids of the features whose field has one of the values."""
    column = resolve_field(df, field, info)
    return matched(where_in(df, column, ids).select(info.id_col), require_match)


def ids_by_sql(
    df: DataFrame, info: LayerInfo, clause: str, require_match: bool = False
) -> DataFrame:
    """Ids of the features fitting a SQL ``WHERE`` clause."""
    if not isinstance(clause, str):
        raise InputTypeError("clause", "a str")
    return matched(df.where(clause).select(info.id_col), require_match, clause)


def default_cell(epsg: int) -> float:
    """Side of the grid cell that levels are counted from: half a degree, or 50 km."""
    return 50_000.0 if crs.is_projected(epsg) else 0.5


def grid_of(epsg: int, cell: float | None) -> tuple[float, int]:
    """Side and finest level of the grid: levels go below the default cell as far as the geometries
    are small, but not below a cell given by the caller."""
    return (cell, 0) if cell else (default_cell(epsg), FINEST)


def as_queries(
    spark: SparkSession, geom: object, in_crs: int | str, out_crs: int | str
) -> DataFrame:
    """Query table ``(query_id, geom)`` in the layer CRS."""
    table = geom if isinstance(geom, DataFrame) else g.literal_table(spark, geom)
    moved = crs.reproject_geom("geom", in_crs, out_crs)
    return table.select("query_id", F.expr(moved).alias("geom"))


def _prepared(df: DataFrame, key: str, geom: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """Key, envelope, prepared geometry, vertex count and carried columns of a geometry table."""
    extra = [F.col(c).alias(f"c_{c}") for c in carry]
    env = [] if set(g.BBOX) <= set(df.columns) else [F.expr(g.envelope(geom)).alias("_env")]
    wide = df.select(F.col(key).alias("id"), F.col(geom).alias("_g"), *extra, *env,
                     *([] if env else g.BBOX))
    box = [F.col(f"_env.{b}").alias(b) for b in g.BBOX] if env else [F.col(b) for b in g.BBOX]
    return wide.select(
        "id", *[f"c_{c}" for c in carry], *box, F.expr(relate.prepare("_g")).alias("prep"),
        F.expr(g.n_vertices("_g")).alias("_nv"),
        F.xxhash64("id").alias("_salt"),
    )


def spatial_pairs(
    features: DataFrame,
    info: LayerInfo,
    queries: DataFrame,
    test: Callable[[str, str], str] | None,
    cell: float | None = None,
    query_size: Size | None = None,
    carry: tuple[str, ...] = (),
    spots: str | None = None,
    relation: Named | None = None,
) -> DataFrame:
    """``(query_id, feature_id)`` of the pairs whose envelopes meet and that pass ``test``.

    ``test`` writes the test of the prepared feature and query; ``None`` keeps envelope pairs.
    ``carry`` names feature columns to bring along, which saves a join on the id afterwards.
    ``spots`` says what ``test`` asks of a point and an area, ``meet`` or ``inside``: then query areas with
    long rings meet a point layer segment by segment. ``relation`` names ``test`` with the feature first; then a long
    query table meets the features block by block, and ``test`` only sees the pairs that are not plain.
    """
    cell, finest = grid_of(info.epsg, cell)
    left = _prepared(features, info.id_col, geometry_column(features, info), carry)
    pad = crs.tolerance(info.epsg)

    def asked(some: DataFrame) -> DataFrame:
        right = _prepared(some, "query_id", "geom")
        return right.drop("prep") if test is None else right.withColumns({
            "xmin": F.col("xmin") - pad, "ymin": F.col("ymin") - pad,
            "xmax": F.col("xmax") + pad, "ymax": F.col("ymax") + pad})

    if test is None:
        left = left.drop("prep")
    right = asked(queries)
    by_segment = None
    if test is not None:
        query_size = query_size or measure(right, "_nv", level_of(cell, finest))
    in_blocks = relation is not None and query_size.rows > MAX_ROWWISE_QUERIES
    if in_blocks:
        # A layer in a small file would be prepared, and listed by cell, in one task.
        left = _prepared(spread(features, info.id_col), info.id_col, geometry_column(features, info), carry)
    if spots and info.kind == "point":
        if query_size.most > LONG_RING:
            tol, bare, n = crs.tolerance(info.epsg), left.drop("prep", "_nv"), g.n_vertices("geom")
            areas = queries.where(g.is_area("geom"))
            rings = areas.where(f"{n} > {LONG_RING} AND {n} <= {WHOLE_RING}")
            found = []
            if query_size.most > WHOLE_RING:
                found.append(spots_in_areas(bare, areas.where(f"{n} > {WHOLE_RING}"), spots, tol, cell, finest))
            if not found or not rings.isEmpty():
                found.append(spots_in_rings(bare, rings, spots, tol, cell, finest))
            by_segment = _named(reduce(DataFrame.unionByName, found), carry)
            rest = queries.where(f"{n} > 0 AND NOT coalesce({g.is_area('geom')} AND {n} > {LONG_RING}, false)")
            if rest.isEmpty():
                return by_segment
            # Told by the geometries, so that no long ring is prepared to be left out.
            right, query_size = asked(rest), None
    if in_blocks:
        tol, (name, pattern, feature_first) = crs.tolerance(info.epsg), relation
        judge, judge_one = ((lambda a, ai, b, bi, say=say: say(name, a, ai, b, bi, tol, pattern, feature_first))
                            for say in (pair_tests.judge, pair_tests.judge_one))
        pairs = block_pairs(left, right, cell, judge, judge_one, test("l_prep", "r_prep"), carry, finest)
    else:
        pairs = candidate_pairs(left.drop("_nv"), right, cell, query_size, info.kind == "point", finest)
        if test is not None:
            pairs = pairs.where(test("l_prep", "r_prep"))
    pairs = _named(pairs, carry)
    return pairs if by_segment is None else pairs.unionByName(by_segment)


def _named(pairs: DataFrame, carry: tuple[str, ...]) -> DataFrame:
    return pairs.select(
        F.col("r_id").alias("query_id"), F.col("l_id").alias("feature_id"),
        *[F.col(f"l_c_{c}").alias(c) for c in carry])


def _mirrored(fn: Relation) -> Relation:
    return lambda f, q, tol: fn(q, f, tol)


def _relation_test(relation: str, tol: float, pattern: str | None) -> Callable | None:
    """Test of a spatial relation, query geometry first."""
    if relation not in SPATIAL_RELATIONS:
        raise InputValueError("relation", SPATIAL_RELATIONS, relation)
    name = relation.removeprefix("esriSpatialRel")
    if name in ("EnvelopeIntersects", "IndexIntersects"):
        return None
    if name == "Relation":
        if pattern is None:
            raise InputTypeError("pattern", "a relation pattern", "'T*F**F***'")
        relate.check_pattern(pattern)
        return lambda f, q: relate.relate(q, f, tol, pattern)
    tests: dict[str, Relation] = {
        "Intersects": relate.intersects,
        "Contains": relate.within,
        "Crosses": _mirrored(relate.crosses),
        "Overlaps": _mirrored(relate.overlaps),
        "Touches": _mirrored(relate.touches),
        "Within": _mirrored(relate.within),
    }
    return lambda f, q: tests[name](f, q, tol)


def ids_by_geom(
    df: DataFrame,
    info: LayerInfo,
    geom: object,
    geo_crs: int | str = 4326,
    relation: str = "esriSpatialRelIntersects",
    where: str | None = None,
    distance: float | None = None,
    pattern: str | None = None,
    cell: float | None = None,
    require_match: bool = False,
    outfields: list[str] | None = None,
) -> DataFrame:
    """Ids of the features in a relation to a geometry or to each of a table of geometries.

    ``outfields`` brings feature fields along, so that no second pass by id is needed.

    The query geometry is the first operand: ``Contains`` finds the features it contains,
    ``Within`` the features around it. ``where`` is AND-ed and reaches the scan. ``distance``
    in metres widens the query geometry for ``Intersects``; it is cut to whole metres and 0
    means none.
    """
    test = _relation_test(relation, crs.tolerance(info.epsg), pattern)
    queries = as_queries(df.sparkSession, geom, geo_crs, info.epsg)
    carry = _carried(df, info, outfields)
    if where:
        df = df.where(where)
    if distance and int(distance):
        if relation != SPATIAL_RELATIONS[0]:
            raise InputValueError("relation with a distance", SPATIAL_RELATIONS[:1], relation)
        pairs = within_distance(df, info, queries, int(distance), info.epsg, cell, outfields)
    else:
        spots = {"Intersects": "meet", "Contains": "inside"}.get(relation.removeprefix("esriSpatialRel"))
        name = relation.removeprefix("esriSpatialRel")
        first = {"Contains": "within", "Within": "contains", "Relation": "relate"}.get(name, name.lower())
        pairs = spatial_pairs(df, info, queries, test, cell, carry=carry, spots=spots,
                              relation=(first, pattern, False) if test else None)
    return matched(pairs, require_match)


def _carried(df: DataFrame, info: LayerInfo, outfields: list[str] | None) -> tuple[str, ...]:
    return tuple(dict.fromkeys(resolve_field(df, name, info) for name in outfields or ()))


def _spots_near(f: str, q: str, epsg: int, metres: int) -> str:
    """Whether a position of one and a position of the other are at most ``metres`` apart."""
    def lonlat(v: str, body: Callable[[str], str]) -> str:
        return body(v) if not crs.is_projected(epsg) else let(
            crs.project(f"{v}.x", f"{v}.y", epsg, 4326), body)

    return some(f"{f}.verts", lambda v: lonlat(v, lambda a: some(
        f"{q}.verts", lambda w: lonlat(w, lambda b: crs.nearer_than(
            f"{a}.x", f"{a}.y", f"{b}.x", f"{b}.y", metres)))))


def _local_metres(prep: str, origin: str) -> str:
    """Prepared geometry in metres around ``origin``: a local plane on the ellipsoid."""
    a, inv = crs.GRS80
    e2 = (2 - 1 / inv) / inv
    degree = 3.141592653589793 / 180 * a

    def scale(o: str) -> str:
        bend = f"(1.0D - {num(e2)} * sin(radians({o}.y)) * sin(radians({o}.y)))"
        return struct(
            x=f"{o}.x", y=f"{o}.y",
            kx=f"{num(degree)} * cos(radians({o}.y)) / sqrt({bend})",
            ky=f"{num(degree * (1 - e2))} / ({bend} * sqrt({bend}))")

    def moved(o: str) -> str:
        def spot(v: str) -> str:
            return struct(x=f"({v}.x - {o}.x) * {o}.kx", y=f"({v}.y - {o}.y) * {o}.ky")

        def seg(s: str) -> str:
            return struct(
                x1=f"({s}.x1 - {o}.x) * {o}.kx", y1=f"({s}.y1 - {o}.y) * {o}.ky",
                x2=f"({s}.x2 - {o}.x) * {o}.kx", y2=f"({s}.y2 - {o}.y) * {o}.ky")

        return struct(dim=f"{prep}.dim", verts=each(f"{prep}.verts", spot),
                      segs=each(f"{prep}.segs", seg), ends=each(f"{prep}.ends", spot))

    return let(let(origin, scale), moved)


def within_distance(
    df: DataFrame,
    info: LayerInfo,
    geom: object,
    metres: float,
    geo_crs: int | str = 4326,
    cell: float | None = None,
    outfields: list[str] | None = None,
) -> DataFrame:
    """``(query_id, feature_id)`` and ``outfields`` of the features at most ``metres`` away.

    Points are measured along the ellipsoid. Lines and areas of a geographic layer are
    measured in a local plane around the query, good to about one part in a thousand up to
    100 km; those of a projected layer in its own plane. Queries that reach across 180 degrees find the
    features beyond it.
    """
    if int(metres) <= 0:
        raise InputValueError("metres", ["whole metres above 0"], metres)
    metres = int(metres)
    queries = as_queries(df.sparkSession, geom, geo_crs, info.epsg)
    right = _reaching(queries, info.epsg, metres)
    carry = _carried(df, info, outfields)
    left = _prepared(df, info.id_col, geometry_column(df, info), carry)
    cell, finest = grid_of(info.epsg, cell)
    size = measure(right, "_nv", level_of(cell, finest))
    if (info.kind == "point" and size.most <= 1 and size.rows > MAX_ROWWISE_QUERIES
            and not crs.is_projected(info.epsg)):
        # Single points have no envelope of their own to turn or to measure from.
        left = _prepared(spread(df, info.id_col), info.id_col, geometry_column(df, info), carry)
        right = _reaching(spread(queries, "query_id"), info.epsg, metres)

        def judge(a, ai, b, bi):
            return pair_tests.near_spots(a, ai, b, bi, metres)

        return _named(block_pairs(left, right, cell, judge, judge, _spots_near(
            "l_prep", "r_prep", info.epsg, metres), carry, finest), carry)
    pairs = candidate_pairs(left.drop("_nv"), right, cell, size, info.kind == "point", finest)
    if not crs.is_projected(info.epsg):
        pairs = pairs.where("r__turned = 0 OR l_xmax - l_xmin < 180")
    return _named(pairs.where(_near_test("l_prep", "r_prep", "r_", info.epsg, metres)), carry)


def _reaching(queries: DataFrame, epsg: int, metres: int) -> DataFrame:
    """Prepared queries whose envelopes are widened by the distance.

    In degrees the envelope covers the distance anywhere on the query; near poles it gets the whole
    circle. A query that reaches across 180 degrees is listed a second time, a turn further
    (``_turned``), to meet the features on the other side. Envelopes half a turn wide or more are listed
    once, so that no feature below that width meets both.
    """
    if crs.is_projected(epsg):
        pad_x = pad_y = F.lit(metres * 1.02)
        right = _prepared(queries, "query_id", "geom").withColumn("_turned", F.lit(0))
    else:
        a, inv = crs.GRS80
        polar = a * (1 - 1 / inv)
        deg = 180.0 / 3.141592653589793 * metres / (polar * 0.99)
        pad_y = F.lit(deg)
        far = F.greatest(F.abs("ymin"), F.abs("ymax")) + deg
        pad_x = F.when(far < 89.9, F.lit(deg) / F.cos(F.radians(far))).otherwise(F.lit(360.0))
        env = queries.select("query_id", "geom", F.expr(g.envelope("geom")).alias("_env")).select(
            "query_id", "geom", "_env.*")
        wide = F.col("xmax") - F.col("xmin") + 2 * pad_x
        turns = F.when((wide < 180) & (F.col("xmin") - pad_x < -180), F.array(F.lit(0), F.lit(360))).when(
            (wide < 180) & (F.col("xmax") + pad_x > 180), F.array(F.lit(0), F.lit(-360))).otherwise(
            F.array(F.lit(0)))
        turned = env.select("query_id", "geom", F.explode(turns).alias("_turned")).select(
            "query_id", "_turned", F.expr("IF(_turned = 0, geom, " + g.map_vertices(
                "geom", lambda v: g.vertex_text(f"{v}.x + _turned", f"{v}.y", f"{v}.m")) + ")").alias("geom"))
        right = _prepared(turned, "query_id", "geom", ("_turned",)).withColumnRenamed("c__turned", "_turned")
    return right.select(
        "id", "prep", "_nv", "_salt", "_turned",
        (F.col("xmin") - pad_x).alias("xmin"), (F.col("ymin") - pad_y).alias("ymin"),
        (F.col("xmax") + pad_x).alias("xmax"), (F.col("ymax") + pad_y).alias("ymax"))


def _near_test(f: str, q: str, box: str, epsg: int, metres: int) -> str:
    """Whether two prepared geometries are at most ``metres`` apart; ``box`` prefixes the query's envelope."""
    if crs.is_projected(epsg):
        plane = relate.planar_distance(f, q)
    else:
        centre = struct(x=f"({box}xmin + {box}xmax) / 2", y=f"({box}ymin + {box}ymax) / 2")
        both = struct(f=_local_metres(f, centre), q=_local_metres(q, centre))
        plane = let(both, lambda p: relate.planar_distance(f"{p}.f", f"{p}.q"))
    return (f"CASE WHEN {f}.dim = 0 AND {q}.dim = 0 THEN {_spots_near(f, q, epsg, metres)} "
            f"ELSE {plane} <= {metres} END")


def features_by_box(
    df: DataFrame,
    info: LayerInfo,
    bbox: tuple[float, float, float, float],
    box_crs: int | str = 4326,
    always_xy: bool = True,
) -> DataFrame:
    """Features meeting a box ``(west, south, east, north)``.

    The box is rounded in its own CRS (6 decimals for degrees, 2 for metres) and then moved to
    the layer CRS. ``always_xy`` tells how a request would write its axes (``flip_axes``); the box
    is given in the same order either way and selects the same features. Envelope comparisons on
    plain columns reach the scan.
    """
    if not (isinstance(bbox, tuple) and len(bbox) == 4
            and all(isinstance(v, (int, float)) for v in bbox)):
        raise InputTypeError("bbox", "a tuple of four numbers", "(west, south, east, north)")
    w, s, e, n = (round(float(v), crs.grid_decimals(box_crs)) for v in bbox)
    if not {crs.parse_crs(box_crs), info.epsg} <= set(crs.GEOGRAPHIC) and (
            crs.parse_crs(box_crs) != info.epsg):
        w, s, e, n = crs.match_crs((w, s, e, n), box_crs, info.epsg)
    if not set(g.BBOX) <= set(df.columns):
        df = g.with_bbox(df, geometry_column(df, info))
    near = df.where((F.col("xmin") <= e) & (F.col("xmax") >= w)
                    & (F.col("ymin") <= n) & (F.col("ymax") >= s))
    inside = ((F.col("xmin") >= w) & (F.col("xmax") <= e)
              & (F.col("ymin") >= s) & (F.col("ymax") <= n))
    if info.kind == "point":
        return near.where(inside)
    kind, parts = g.as_geometry((w, s, e, n))
    ring = ", ".join(g.vertex_text(num(v[0]), num(v[1])) for v in parts[0])
    both = struct(
        f=relate.prepare(f"`{geometry_column(df, info)}`"),
        q=relate.prepare(struct(kind=f"'{kind}'", parts=f"array(array({ring}))")))
    exact = let(both, lambda p: relate.intersects(f"{p}.f", f"{p}.q", crs.tolerance(info.epsg)))
    return near.where(inside | F.expr(exact))


def _predicate_test(predicate: str, tol: float, pattern: str | None) -> Callable:
    """Test of a feature predicate, feature first."""
    if predicate == "RELATE":
        if pattern is None:
            raise InputTypeError("pattern", "a relation pattern", "'T*F**F***'")
        relate.check_pattern(pattern)
        return lambda f, q: relate.relate(f, q, tol, pattern)
    tests: dict[str, Relation] = {
        "EQUALS": relate.equals, "INTERSECTS": relate.intersects, "TOUCHES": relate.touches,
        "CROSSES": relate.crosses, "WITHIN": relate.within,
        "CONTAINS": _mirrored(relate.within), "OVERLAPS": relate.overlaps,
    }
    return lambda f, q: tests[predicate](f, q, tol)


def features_by_geom(
    df: DataFrame,
    info: LayerInfo,
    geom: object,
    geo_crs: int | str = 4326,
    predicate: str = "INTERSECTS",
    pattern: str | None = None,
    metres: float | None = None,
    cell: float | None = None,
    outfields: list[str] | None = None,
) -> DataFrame:
    """``(query_id, feature_id)`` and ``outfields`` for ``PREDICATE(feature, query)``.

    The feature is the first operand: ``WITHIN`` finds the features inside the query geometry,
    ``CONTAINS`` those around it. The query is snapped to the grid of the layer CRS. ``DISJOINT``
    and ``BEYOND`` list nearly every pair, so they take a short query table only; ``BEYOND``
    needs ``metres``, ``RELATE`` a ``pattern``.
    """
    predicate = predicate.upper()
    if predicate not in PREDICATES:
        raise InputValueError("predicate", PREDICATES, predicate)
    queries = as_queries(df.sparkSession, geom, geo_crs, info.epsg)
    decimals = crs.grid_decimals(info.epsg)
    queries = queries.select("query_id", F.expr(g.snap("geom", decimals)).alias("geom"))
    if predicate in ("DISJOINT", "BEYOND"):
        if predicate == "BEYOND" and not (metres and int(metres) > 0):
            raise InputTypeError("metres", "a distance of whole metres above 0 for BEYOND")
        reach = int(metres) if predicate == "BEYOND" else None
        return _all_but(df, info, queries, reach, _carried(df, info, outfields), cell)
    test = _predicate_test(predicate, crs.tolerance(info.epsg), pattern)
    spots = {"INTERSECTS": "meet", "WITHIN": "inside"}.get(predicate)
    return spatial_pairs(
        df, info, queries, test, cell, carry=_carried(df, info, outfields), spots=spots,
        relation=(predicate.lower(), pattern, True))


def _all_but(
    df: DataFrame, info: LayerInfo, queries: DataFrame, metres: int | None, carry: tuple[str, ...],
    cell: float | None,
) -> DataFrame:
    """Every (query, feature) pair but those that meet, or are at most ``metres`` apart.

    The query table must be short. Up to ``MAX_COMPLEMENT_VERTICES`` it is one value that the scan of the features is
    tested against, without a shuffle; beyond, the pairs that meet are taken out by an anti-join.
    """
    queries = queries.where("geom is not null")
    size = queries.agg(
        F.count_distinct("query_id").alias("n"), F.sum(F.expr(g.n_vertices("geom"))).alias("v")).first()
    if size.n > MAX_COMPLEMENT_QUERIES:
        raise InputValueError("geom", [f"at most {MAX_COMPLEMENT_QUERIES} query geometries"])
    geom = geometry_column(df, info)
    held = df.where(F.col(geom).isNotNull())
    if (size.v or 0) > MAX_COMPLEMENT_VERTICES:
        if metres:
            met = within_distance(df, info, queries, metres, info.epsg, cell)
        else:
            met = features_by_geom(df, info, queries, info.epsg, "INTERSECTS", cell=cell)
        asked = queries.select("query_id").distinct().agg(F.collect_list("query_id"))
        every = held.select(
            F.explode(asked.scalar()).alias("query_id"), F.col(info.id_col).alias("feature_id"),
            *[F.col(c).alias(c) for c in carry])
        return every.join(met, ["query_id", "feature_id"], "left_anti")
    tol = crs.tolerance(info.epsg)
    right = _reaching(queries, info.epsg, metres) if metres else _prepared(
        queries, "query_id", "geom").withColumn("_turned", F.lit(0))
    pad = 0.0 if metres else tol
    known = right.groupBy("id").agg(F.collect_list(F.struct("prep", "_turned", *g.BBOX)).alias("shapes")).agg(
        F.collect_list(F.struct("id", "shapes")))
    left = _prepared(held, info.id_col, geom, carry).withColumn("_queries", known.scalar())

    def meets(s: str) -> str:
        exact = _near_test("prep", f"{s}.prep", f"{s}.", info.epsg, metres) if metres else (
            relate.intersects("prep", f"{s}.prep", tol))
        return (f"xmin <= {s}.xmax + {num(pad)} AND xmax >= {s}.xmin - {num(pad)} "
                f"AND ymin <= {s}.ymax + {num(pad)} AND ymax >= {s}.ymin - {num(pad)} "
                f"AND ({s}._turned = 0 OR xmax - xmin < 180) AND {exact}")

    # A feature or query without a vertex has no envelope: it meets nothing.
    apart = keep("_queries", lambda q: f"NOT coalesce({some(f'{q}.shapes', meets)}, false)")
    return left.select(
        F.explode(F.expr(apart)).alias("_q"), F.col("id").alias("feature_id"),
        *[F.col(f"c_{c}").alias(c) for c in carry]).select(
        F.col("_q.id").alias("query_id"), "feature_id", *carry)


def features_by_id(
    df: DataFrame, info: LayerInfo, column: str, ids: object
) -> DataFrame:
    """Features whose ``column`` is among ``ids``, each once however often an id is given."""
    if column not in df.columns:
        raise InputValueError("column", df.columns, column)
    if not isinstance(ids, DataFrame) and not isinstance(ids, (str, int)):
        if not isinstance(ids, Iterable) or not list(ids):
            raise InputTypeError("ids", "an int, a str or a list of them")
    return where_in(df, column, ids)


def features_by_filter(df: DataFrame, clause: str) -> DataFrame:
    """Features fitting a filter text."""
    if not isinstance(clause, str):
        raise InputTypeError("clause", "a str")
    return df.where(clause)


def hits(df: DataFrame, clause: str | Column | None = None) -> DataFrame:
    """Number of features, without their rows."""
    chosen = df if clause is None else df.where(clause)
    return chosen.agg(F.count(F.lit(1)).alias("hits"))
