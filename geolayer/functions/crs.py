"""Coordinate systems: the supported codes, reprojection and geodesic length as column math.

Everything goes through longitude and latitude. WGS 84 and NAD 83 degrees are taken as equal,
3857 is spherical Mercator, transverse Mercator uses the Krueger series to order six, and
``projections`` holds the other families. ETRS 89 degrees are taken as equal as well.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geolayer.errors import InputTypeError
from geolayer.functions import geometry as g
from geolayer.functions import projections as pj
from geolayer.functions.sql import add, each, let, num, struct

# Ellipsoids (semi-major axis in metres, inverse flattening).
WGS84 = (6378137.0, 298.257223563)
GRS80 = (6378137.0, 298.257222101)

# Transverse Mercator scale and false origin of every UTM zone, in metres.
UTM_SCALE = 0.9996
FALSE_EASTING = 500000.0
FALSE_NORTHING_SOUTH = 10000000.0

GEOGRAPHIC = (4326, 4269)
MERCATOR = 3857
# Series of UTM codes as (first code, last zone, ellipsoid, southern half).
UTM_SERIES = ((32600, 60, WGS84, False), (32700, 60, WGS84, True), (26900, 23, GRS80, False))
# Single codes as code -> (zone, ellipsoid, southern half).
UTM_SINGLE = {2149: (18, GRS80, False)}

# Parameters of single codes (Conus Albers, Europe Lambert and equal area, World Mercator).
PROJECTED = {
    5070: pj.Projection("albers", GRS80, -96.0, 23.0, (29.5, 45.5)),
    3034: pj.Projection("lambert", GRS80, 10.0, 52.0, (35.0, 65.0), 4000000.0, 2800000.0),
    3035: pj.Projection("azimuthal", GRS80, 10.0, 52.0, east=4321000.0, north=3210000.0),
    3395: pj.Projection("mercator", WGS84, 0.0),
}


def utm_zone(epsg: int) -> tuple[int, tuple[float, float], bool] | None:
    """Zone, ellipsoid and hemisphere of a UTM code; ``None`` for other codes."""
    for first, last, ellipsoid, south in UTM_SERIES:
        if 1 <= epsg - first <= last:
            return epsg - first, ellipsoid, south
    return UTM_SINGLE.get(epsg)


def supported_codes() -> list[int]:
    """Every EPSG code the library can transform."""
    utm = [first + z for first, last, _, _ in UTM_SERIES for z in range(1, last + 1)]
    return sorted([*GEOGRAPHIC, MERCATOR, *UTM_SINGLE, *PROJECTED, *utm])


def parse_crs(crs: int | str) -> int:
    """EPSG number of a supported CRS given as a number or as text."""
    found = re.fullmatch(r"\s*(?:epsg:)?(\d+)\s*", str(crs), flags=re.IGNORECASE)
    code = int(found.group(1)) if found and not isinstance(crs, bool) else -1
    if code in GEOGRAPHIC or code == MERCATOR or code in PROJECTED or utm_zone(code):
        return code
    raise InputTypeError("crs", "a valid CRS", "4326 or 'epsg:3857'")


def validate_crs(crs: int | str) -> str:
    """Canonical text of a supported CRS."""
    return f"epsg:{parse_crs(crs)}"


def is_projected(crs: int | str) -> bool:
    """Whether coordinates are metres."""
    return parse_crs(crs) not in GEOGRAPHIC


def grid_decimals(crs: int | str) -> int:
    """Decimals that matter: 2 for metres, 6 for degrees."""
    return 2 if is_projected(crs) else 6


def tolerance(crs: int | str) -> float:
    """Distance under which two positions count as one: a thousandth of the snap grid."""
    return 10.0 ** -(grid_decimals(crs) + 3)


def check_crs(df: DataFrame, epsg_col: str) -> DataFrame:
    """Flag rows with a supported code (``crs_valid``) and add the canonical text (``crs``)."""
    spark: SparkSession = df.sparkSession
    codes = spark.createDataFrame([(c,) for c in supported_codes()], "_code int")
    code = code_number(F.col(epsg_col))
    return (
        df.withColumn("_want", code)
        .join(F.broadcast(codes), F.col("_want") == F.col("_code"), "left")
        .withColumn("crs_valid", F.col("_code").isNotNull())
        .withColumn("crs", F.concat(F.lit("epsg:"), F.col("_code").cast("string")))
        .drop("_want", "_code")
    )


def _poly(n: float, first: int, terms: tuple[float, ...]) -> float:
    return sum(c * n ** (first + i) for i, c in enumerate(terms))


# Krueger series coefficients by power of the third flattening, lowest power equal
# to the index of the term (published series, order six).
FORWARD = (
    (1 / 2, -2 / 3, 5 / 16, 41 / 180, -127 / 288, 7891 / 37800),
    (13 / 48, -3 / 5, 557 / 1440, 281 / 630, -1983433 / 1935360),
    (61 / 240, -103 / 140, 15061 / 26880, 167603 / 181440),
    (49561 / 161280, -179 / 168, 6601661 / 7257600),
    (34729 / 80640, -3418889 / 1995840),
    (212378941 / 319334400,),
)
INVERSE = (
    (1 / 2, -2 / 3, 37 / 96, -1 / 360, -81 / 512, 96199 / 604800),
    (1 / 48, 1 / 15, -437 / 1440, 46 / 105, -1118711 / 3870720),
    (17 / 480, -37 / 840, -209 / 4480, 5569 / 90720),
    (4397 / 161280, -11 / 504, -830251 / 7257600),
    (4583 / 161280, -108847 / 3991680),
    (20648693 / 638668800,),
)
LATITUDE = (
    (2, -2 / 3, -2, 116 / 45, 26 / 45, -2854 / 675),
    (7 / 3, -8 / 5, -227 / 45, 2704 / 315, 2323 / 945),
    (56 / 15, -136 / 35, -1262 / 105, 73814 / 2835),
    (4279 / 630, -332 / 35, -399572 / 14175),
    (4174 / 315, -144838 / 6237),
    (601676 / 22275,),
)


def series(ellipsoid: tuple[float, float]) -> dict[str, object]:
    """Rectifying radius, eccentricity and series of an ellipsoid."""
    a, inv = ellipsoid
    f = 1.0 / inv
    n = f / (2.0 - f)
    return {
        "radius": a / (1 + n) * (1 + n**2 / 4 + n**4 / 64 + n**6 / 256),
        "ecc": math.sqrt(f * (2 - f)),
        "fwd": [_poly(n, j + 1, t) for j, t in enumerate(FORWARD)],
        "inv": [_poly(n, j + 1, t) for j, t in enumerate(INVERSE)],
        "lat": [_poly(n, j + 1, t) for j, t in enumerate(LATITUDE)],
    }


def _xy(x: str, y: str) -> str:
    return struct(x=x, y=y)


UTM_TERMS = ("inv", "fwd", "lat")


def _utm_parameters(epsg: int) -> dict[str, str]:
    """Parameters of a zone as literals."""
    zone, ellipsoid, south = utm_zone(epsg)
    s = series(ellipsoid)
    return {
        "lon0": num(zone * 6 - 183), "y0": num(FALSE_NORTHING_SOUTH if south else 0.0),
        "scale": num(UTM_SCALE * s["radius"]), "ecc": num(s["ecc"]),
        **{f"{t}{j}": num(v) for t in UTM_TERMS for j, v in enumerate(s[t], 1)},
    }


def _utm_by_code(code: str) -> str:
    """The same parameters as a struct that follows a column of codes; null for other codes."""
    zone = "CASE " + " ".join(
        f"WHEN {code} BETWEEN {first + 1} AND {first + last} THEN {code} - {first}"
        for first, last, _, _ in UTM_SERIES) + " " + " ".join(
        f"WHEN {code} = {c} THEN {z}" for c, (z, _, _) in UTM_SINGLE.items()) + " END"
    south = " OR ".join(f"{code} BETWEEN {first + 1} AND {first + last}"
                        for first, last, _, south in UTM_SERIES if south)
    wgs = " OR ".join(f"{code} BETWEEN {first + 1} AND {first + last}"
                      for first, last, ellipsoid, _ in UTM_SERIES if ellipsoid == WGS84)
    north, other = _utm_parameters(UTM_SERIES[0][0] + 1), _utm_parameters(UTM_SERIES[2][0] + 1)
    shared = {k: f"IF({wgs}, {v}, {other[k]})" for k, v in north.items() if k not in ("lon0", "y0")}
    return struct(
        lon0=f"double(({zone}) * 6 - 183)", y0=f"IF({south}, {num(FALSE_NORTHING_SOUTH)}, 0.0D)", **shared)


def _from_utm(x: str, y: str, p: dict[str, str]) -> str:
    def terms(name: str) -> list[tuple[int, str]]:
        return [(j, p[f"{name}{j}"]) for j in range(1, len(INVERSE) + 1)]

    start = _xy(f"({x} - {num(FALSE_EASTING)}) / {p['scale']}", f"({y} - {p['y0']}) / {p['scale']}")

    def sphere(q: str) -> str:
        xi = add([f"{b} * sin({2 * j} * {q}.y) * cosh({2 * j} * {q}.x)" for j, b in terms("inv")])
        eta = add([f"{b} * cos({2 * j} * {q}.y) * sinh({2 * j} * {q}.x)" for j, b in terms("inv")])
        return struct(xi=f"{q}.y - {xi}", eta=f"{q}.x - {eta}")

    def conformal(q: str) -> str:
        return struct(chi=f"asin(sin({q}.xi) / cosh({q}.eta))",
                      lam=f"atan2(sinh({q}.eta), cos({q}.xi))")

    def degrees(c: str) -> str:
        phi = add([f"{c}.chi", *[f"{d} * sin({2 * j} * {c}.chi)" for j, d in terms("lat")]])
        return _xy(f"degrees({c}.lam) + {p['lon0']}", f"degrees({phi})")

    return let(let(let(start, sphere), conformal), degrees)


def _to_utm(lon: str, lat: str, p: dict[str, str]) -> str:
    def terms(name: str) -> list[tuple[int, str]]:
        return [(j, p[f"{name}{j}"]) for j in range(1, len(FORWARD) + 1)]

    ecc = p["ecc"]
    start = struct(lam=f"radians({lon} - {p['lon0']})", sn=f"sin(radians({lat}))")

    def conformal(q: str) -> str:
        return struct(t=f"sinh(atanh({q}.sn) - {ecc} * atanh({ecc} * {q}.sn))", lam=f"{q}.lam")

    def sphere(q: str) -> str:
        return struct(
            xi=f"atan2({q}.t, cos({q}.lam))",
            eta=f"asinh(sin({q}.lam) / sqrt({q}.t * {q}.t + cos({q}.lam) * cos({q}.lam)))")

    def metres(c: str) -> str:
        xi = add([f"{c}.xi", *[f"{a} * sin({2 * j} * {c}.xi) * cosh({2 * j} * {c}.eta)"
                               for j, a in terms("fwd")]])
        eta = add([f"{c}.eta", *[f"{a} * cos({2 * j} * {c}.xi) * sinh({2 * j} * {c}.eta)"
                                 for j, a in terms("fwd")]])
        return _xy(f"{eta} * {p['scale']} + {num(FALSE_EASTING)}", f"{xi} * {p['scale']} + {p['y0']}")

    return let(let(let(start, conformal), sphere), metres)


def _to_degrees(x: str, y: str, src: int) -> str:
    """Longitude and latitude of a position in a CRS."""
    a = num(WGS84[0])
    if src in GEOGRAPHIC:
        return _xy(x, y)
    if src == MERCATOR:
        return _xy(f"degrees({x} / {a})", f"degrees({num(math.pi / 2)} - 2 * atan(exp(-{y} / {a})))")
    if src in PROJECTED:
        p = PROJECTED[src]
        return pj.inverse(x, y, p, series(p.ellipsoid)["lat"])
    return _from_utm(x, y, _utm_parameters(src))


def _from_degrees(here: str, dst: int) -> str:
    """A position, given as a struct in degrees, in a CRS."""
    if dst in GEOGRAPHIC:
        return here
    a = num(WGS84[0])
    if dst == MERCATOR:
        return let(here, lambda p: _xy(
            f"radians({p}.x) * {a}", f"ln(tan({num(math.pi / 4)} + radians({p}.y) / 2)) * {a}"))
    if dst in PROJECTED:
        return let(here, lambda p: pj.forward(f"{p}.x", f"{p}.y", PROJECTED[dst]))
    return let(here, lambda p: _to_utm(f"{p}.x", f"{p}.y", _utm_parameters(dst)))


def project(x: str, y: str, in_crs: int | str, out_crs: int | str) -> str:
    """Struct ``(x, y)`` of a position in another CRS, always in x, y order."""
    src, dst = parse_crs(in_crs), parse_crs(out_crs)
    if src == dst or {src, dst} <= set(GEOGRAPHIC):
        return _xy(x, y)
    return _from_degrees(_to_degrees(x, y, src), dst)


def code_number(code: Column) -> Column:
    """EPSG number of a column of numbers or texts such as ``epsg:4326``; null for other texts."""
    return F.regexp_extract(
        F.trim(code.cast("string")), r"^(?i:epsg:)?(\d+)$", 1).try_cast("int")


def reproject_by_code(geom: str, code: str, out_crs: int | str) -> str:
    """Geometry in another CRS where each row names its own; null for rows with another code.

    One branch per family; the parameters of a UTM zone follow the code, so nothing about the rows
    has to be known beforehand.
    """
    dst = parse_crs(out_crs)

    def moved(to_degrees: Callable[[str, str], str]) -> str:
        return g.map_vertices(geom, lambda v: let(
            _from_degrees(to_degrees(f"{v}.x", f"{v}.y"), dst),
            lambda p: g.vertex_text(f"{p}.x", f"{p}.y", f"{v}.m")))

    same = ", ".join(map(str, GEOGRAPHIC if dst in GEOGRAPHIC else (dst,)))
    singles = [c for c in (GEOGRAPHIC[0], MERCATOR, *PROJECTED) if not same_crs(c, dst)]
    branches = []
    for c in singles:
        test = one_code(code, GEOGRAPHIC if c in GEOGRAPHIC else (c,))
        branches.append(f"WHEN {test} THEN {moved(lambda x, y, c=c: _to_degrees(x, y, c))}")
    fields = _utm_parameters(UTM_SERIES[0][0] + 1)
    zone = let(_utm_by_code(code), lambda p: moved(
        lambda x, y: _from_utm(x, y, {k: f"{p}.{k}" for k in fields})))
    ranges = " OR ".join([*[f"{code} BETWEEN {first + 1} AND {first + last}"
                            for first, last, _, _ in UTM_SERIES], one_code(code, tuple(UTM_SINGLE))])
    return (f"CASE WHEN {code} IN ({same}) THEN {geom} " + " ".join(branches)
            + f" WHEN {ranges} THEN {zone} END")


def one_code(code: str, codes: tuple[int, ...]) -> str:
    """Test of a code."""
    return f"{code} IN ({', '.join(map(str, codes))})"


def same_crs(in_crs: int | str, out_crs: int | str) -> bool:
    """Whether nothing moves between the two."""
    src, dst = parse_crs(in_crs), parse_crs(out_crs)
    return src == dst or {src, dst} <= set(GEOGRAPHIC)


def reproject_geom(geom: str, in_crs: int | str, out_crs: int | str) -> str:
    """Geometry in another CRS; the same text if nothing changes."""
    if same_crs(in_crs, out_crs):
        return geom
    return g.map_vertices(geom, lambda v: let(
        project(f"{v}.x", f"{v}.y", in_crs, out_crs),
        lambda p: g.vertex_text(f"{p}.x", f"{p}.y", f"{v}.m")))


def reproject_box(
    w: str, s: str, e: str, n: str, in_crs: int | str, out_crs: int | str
) -> str:
    """Envelope of the four transformed corners as a struct ``west, south, east, north``."""
    if same_crs(in_crs, out_crs):
        return struct(west=f"double({w})", south=f"double({s})",
                      east=f"double({e})", north=f"double({n})")
    corners = f"array({_xy(w, s)}, {_xy(e, s)}, {_xy(e, n)}, {_xy(w, n)})"
    moved = each(corners, lambda c: project(f"{c}.x", f"{c}.y", in_crs, out_crs))
    return let(moved, lambda c: struct(
        west=f"array_min({c}.x)", south=f"array_min({c}.y)",
        east=f"array_max({c}.x)", north=f"array_max({c}.y)"))


def match_crs(value: object, in_crs: int | str, out_crs: int | str) -> object:
    """Reproject one Python geometry, box or coordinate list; see :func:`reproject_geom` for tables.

    A box stays a box, a list stays a list, and a lone ``(x, y)`` comes back as a one-item list.
    """
    spark = SparkSession.active()
    nested = isinstance(value, tuple) and bool(value) and isinstance(value[0], (tuple, list))
    if isinstance(value, tuple) and len(value) == 4 and not nested:
        _, ring = g.as_geometry(value)
        (w, s, _), (e, n, _) = ring[0][0], ring[0][2]
        text = reproject_box(num(w), num(s), num(e), num(n), in_crs, out_crs)
        return tuple(spark.range(1).select(F.expr(text).alias("b")).first().b)
    moved = g.literal_table(spark, list(value) if nested else value).select(
        F.expr(reproject_geom("geom", in_crs, out_crs)).alias("geom")).first().geom
    if isinstance(value, dict):
        keep_m = any(v.m is not None for part in moved.parts for v in part)
        return {"kind": moved.kind, "parts": [
            [(v.x, v.y, v.m) if keep_m else (v.x, v.y) for v in part] for part in moved.parts]}
    return [(part[0].x, part[0].y) for part in moved.parts]


def geodesic(lon1: str, lat1: str, lon2: str, lat2: str, steps: int = 5) -> str:
    """Metres between two positions on GRS80 by Vincenty's inverse method, fixed steps.

    Null where the steps do not settle, which happens only for nearly antipodal pairs.
    """
    a, inv = GRS80
    f = 1.0 / inv
    b = a * (1 - f)

    def state(c: str, lam: str, body: Callable[[str, str, str, str], str]) -> str:
        """Bind the auxiliary angles of one step for ``body``."""
        side = f"({c}.c2 * sin({lam}))"
        cross = f"({c}.c1 * {c}.s2 - {c}.s1 * {c}.c2 * cos({lam}))"
        arc = struct(ss=f"sqrt({side} * {side} + {cross} * {cross})",
                     cs=f"{c}.s1 * {c}.s2 + {c}.c1 * {c}.c2 * cos({lam})")

        def turned(g1: str) -> str:
            sa = f"IF({g1}.ss = 0, 0.0D, {c}.c1 * {c}.c2 * sin({lam}) / {g1}.ss)"
            return let(sa, lambda s: let(f"1.0D - {s} * {s}", lambda q: let(
                struct(sig=f"atan2({g1}.ss, {g1}.cs)",
                       cm=f"IF({q} = 0, 0.0D, {g1}.cs - 2 * {c}.s1 * {c}.s2 / {q})",
                       cc=f"{num(f / 16)} * {q} * (4.0D + {num(f)} * (4.0D - 3 * {q}))"),
                lambda m: body(g1, s, q, m))))

        return let(arc, turned)

    def step(c: str, lam: str) -> str:
        return state(c, lam, lambda g1, s, q, m: (
            f"{c}.L + (1.0D - {m}.cc) * {num(f)} * {s} * ({m}.sig + {m}.cc * {g1}.ss * "
            f"({m}.cm + {m}.cc * {g1}.cs * (2 * {m}.cm * {m}.cm - 1)))"))

    def length(c: str, lam: str, prev: str) -> str:
        def metres(g1: str, s: str, q: str, m: str) -> str:
            u = f"{q} * {num((a * a - b * b) / (b * b))}"
            return let(u, lambda k: let(
                struct(A=f"1.0D + {k} / 16384 * (4096.0D + {k} * (-768.0D + {k} * (320.0D - 175 * {k})))",
                       B=f"{k} / 1024 * (256.0D + {k} * (-128.0D + {k} * (74.0D - 47 * {k})))"),
                lambda w: (
                    f"IF(abs({lam} - {prev}) < 1e-9D, {num(b)} * {w}.A * ({m}.sig - {w}.B * {g1}.ss * "
                    f"({m}.cm + {w}.B / 4 * ({g1}.cs * (2 * {m}.cm * {m}.cm - 1) - {w}.B / 6 * {m}.cm * "
                    f"(4 * {g1}.ss * {g1}.ss - 3) * (4 * {m}.cm * {m}.cm - 3)))), NULL)")))

        return state(c, lam, metres)

    def iterate(c: str, lam: str, prev: str, left: int) -> str:
        if left == 0:
            return length(c, lam, prev)
        return let(step(c, lam), lambda new: iterate(c, new, lam, left - 1), "lam")

    reduced = struct(u1=f"atan({num(1 - f)} * tan(radians({lat1})))",
                     u2=f"atan({num(1 - f)} * tan(radians({lat2})))")
    constants = let(reduced, lambda u: struct(
        L=f"radians({lon2} - {lon1})", s1=f"sin({u}.u1)", c1=f"cos({u}.u1)",
        s2=f"sin({u}.u2)", c2=f"cos({u}.u2)"))
    return let(constants, lambda c: iterate(c, f"{c}.L", f"{c}.L", steps), "c")


# Fixed value: mean radius in metres. Lengths on this sphere are within 0.6 % of the ellipsoid's.
MEAN_RADIUS = 6371008.8


def spherical(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    """Metres between two positions on the sphere, cheap enough to sort out the clear cases."""
    dlat, dlon = f"sin(radians({lat2} - {lat1}) / 2)", f"sin(radians({lon2} - {lon1}) / 2)"
    h = f"{dlat} * {dlat} + cos(radians({lat1})) * cos(radians({lat2})) * {dlon} * {dlon}"
    return f"{num(2 * MEAN_RADIUS)} * asin(least(1.0D, sqrt({h})))"


def nearer_than(lon1: str, lat1: str, lon2: str, lat2: str, metres: float) -> str:
    """Whether the geodesic length is at most ``metres``; the ellipsoid decides near the limit."""
    return let(spherical(lon1, lat1, lon2, lat2), lambda d: (
        f"CASE WHEN {d} < {num(metres * 0.99)} THEN true WHEN {d} > {num(metres * 1.01)} THEN false "
        f"ELSE {geodesic(lon1, lat1, lon2, lat2)} <= {num(metres)} END"))
