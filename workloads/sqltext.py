"""Shared pieces of the DuckDB comparison SQL."""

from __future__ import annotations

import math

from geolayer.functions.crs import (
    FALSE_EASTING, FALSE_NORTHING_SOUTH, GRS80, UTM_SCALE, series, utm_zone,
)


def geodesic_sql(lon1: str, lat1: str, lon2: str, lat2: str, source: str, steps: int = 6) -> str:
    """The same length as plain SQL over ``source``: all its columns plus ``metres``."""
    a, inv = GRS80
    f = 1.0 / inv
    b = a * (1 - f)
    sql = (f"SELECT *, radians({lon2} - ({lon1})) AS bl, atan({1 - f!r}*tan(radians({lat1}))) AS u1, "
           f"atan({1 - f!r}*tan(radians({lat2}))) AS u2 FROM ({source})")
    sql = f"SELECT *, sin(u1) s1, cos(u1) c1, sin(u2) s2, cos(u2) c2, bl AS lam0 FROM ({sql})"
    for i in range(steps + 1):
        p = f"lam{i}"
        sql = (f"SELECT *, sqrt((c2*sin({p}))*(c2*sin({p})) + (c1*s2-s1*c2*cos({p}))*(c1*s2-s1*c2*cos({p}))) ss{i},"
               f" s1*s2+c1*c2*cos({p}) cs{i} FROM ({sql})")
        sql = (f"SELECT *, atan2(ss{i},cs{i}) sig{i}, CASE WHEN ss{i}=0 THEN 0.0 ELSE "
               f"c1*c2*sin({p})/ss{i} END sa{i} FROM ({sql})")
        sql = f"SELECT *, 1.0-sa{i}*sa{i} AS q{i} FROM ({sql})"
        sql = (f"SELECT *, CASE WHEN q{i}=0 THEN 0.0 ELSE cs{i}-2*s1*s2/q{i} END cm{i},"
               f" {f / 16!r}*q{i}*(4.0+{f!r}*(4.0-3*q{i})) cc{i} FROM ({sql})")
        sql = (f"SELECT *, bl+(1.0-cc{i})*{f!r}*sa{i}*(sig{i}+cc{i}*ss{i}*(cm{i}+cc{i}*cs{i}*"
               f"(2*cm{i}*cm{i}-1))) lam{i + 1} FROM ({sql})")
    k = steps
    sql = f"SELECT *, q{k}*{(a * a - b * b) / (b * b)!r} uu FROM ({sql})"
    sql = (f"SELECT *, 1.0+uu/16384*(4096.0+uu*(-768.0+uu*(320.0-175*uu))) aa,"
           f" uu/1024*(256.0+uu*(-128.0+uu*(74.0-47*uu))) bb FROM ({sql})")
    return (f"SELECT *, {b!r}*aa*(sig{k}-bb*ss{k}*(cm{k}+bb/4*(cs{k}*(2*cm{k}*cm{k}-1)-bb/6*cm{k}"
            f"*(4*ss{k}*ss{k}-3)*(4*cm{k}*cm{k}-3)))) metres FROM ({sql})")


def points_in_sql(points: str, edges: str) -> str:
    """Pairs ``(gid, pid)`` of points in polygons by ray casting over their edges."""
    return f"""SELECT gid, pid FROM ({points}) p JOIN ({edges}) e ON (y1 > y) <> (y2 > y)
        AND x < (x2 - x1) * (y - y1) / (y2 - y1) + x1 GROUP BY gid, pid HAVING count(*) % 2 = 1"""


def crossing_sql(a: str, b: str, a_id: str, b_id: str) -> str:
    """Pairs ``(aid, bid)`` with two edges that cross at a position inside both."""
    def side(p: str, q: str, s: str) -> str:
        return (f"sign(({p}.x2-{p}.x1)*({q}.y{s}-{p}.y1)-({p}.y2-{p}.y1)*({q}.x{s}-{p}.x1))")

    return f"""SELECT DISTINCT a.{a_id} AS aid, b.{b_id} AS bid FROM ({a}) a JOIN ({b}) b ON
        least(a.x1,a.x2) <= greatest(b.x1,b.x2) AND least(b.x1,b.x2) <= greatest(a.x1,a.x2) AND
        {side('a', 'b', '1')}*{side('a', 'b', '2')} < 0 AND
        {side('b', 'a', '1')}*{side('b', 'a', '2')} < 0"""


def clipped_sql(segments: str, boxes: str) -> str:
    """Pairs ``(bid, lid)`` of segments with a stretch inside a box, by clipping."""
    def bound(lo: str, d: str, low: str, high: str, fn: str) -> str:
        ends = f"({low}-{lo})/{d}, ({high}-{lo})/{d}"
        pick = "least" if fn == "low" else "greatest"
        flat = (f"CASE WHEN {lo} > {low} AND {lo} < {high} THEN {0.0 if fn == 'low' else 1.0} "
                f"ELSE {2.0 if fn == 'low' else -1.0} END")
        return f"CASE WHEN {d} = 0 THEN {flat} ELSE {pick}({ends}) END"

    return f"""SELECT DISTINCT bid, lid FROM (SELECT bid, lid,
        greatest(0.0, {bound('x1', '(x2-x1)', 'west', 'east', 'low')},
                 {bound('y1', '(y2-y1)', 'south', 'north', 'low')}) AS t0,
        least(1.0, {bound('x1', '(x2-x1)', 'west', 'east', 'high')},
              {bound('y1', '(y2-y1)', 'south', 'north', 'high')}) AS t1
        FROM ({segments}) JOIN ({boxes}) ON true) WHERE t0 < t1"""


def utm_sql(lon: str, lat: str, epsg: int, source: str) -> str:
    """All columns of ``source`` plus ``easting`` and ``northing``."""
    zone, ellipsoid, south = utm_zone(epsg)
    s = series(ellipsoid)
    e, scale = s["ecc"], UTM_SCALE * s["radius"]
    sql = (f"SELECT *, radians({lon} - ({zone * 6 - 183}.0::DOUBLE)) AS lam, "
           f"sin(radians({lat})) AS sn FROM ({source})")
    sql = (f"SELECT *, sinh(atanh(sn) - {e!r}::DOUBLE*atanh({e!r}::DOUBLE*sn)) AS tt FROM ({sql})")
    sql = (f"SELECT *, atan2(tt, cos(lam)) AS xi, asinh(sin(lam)/sqrt(tt*tt + cos(lam)*cos(lam))) AS eta "
           f"FROM ({sql})")
    north = " + ".join(f"({a!r})*sin({2 * j}*xi)*cosh({2 * j}*eta)" for j, a in enumerate(s["fwd"], 1))
    east = " + ".join(f"({a!r})*cos({2 * j}*xi)*sinh({2 * j}*eta)" for j, a in enumerate(s["fwd"], 1))
    y0 = FALSE_NORTHING_SOUTH if south else 0.0
    return (f"SELECT *, (eta + {east})*{scale!r} + {FALSE_EASTING} AS easting, "
            f"(xi + {north})*{scale!r} + {y0} AS northing FROM ({sql})")


def albers_sql(lon: str, lat: str, source: str) -> str:
    """``source`` with ``easting, northing`` of the Conus Albers projection (EPSG:5070)."""
    a, f = 6378137.0, 1 / 298.257222101
    e2 = f * (2 - f)
    e = math.sqrt(e2)

    def m(deg: float) -> float:
        s = math.sin(math.radians(deg))
        return math.cos(math.radians(deg)) / math.sqrt(1 - e2 * s * s)

    def q(deg: float) -> float:
        s = math.sin(math.radians(deg))
        return (1 - e2) * (s / (1 - e2 * s * s) - math.log((1 - e * s) / (1 + e * s)) / (2 * e))

    n = (m(29.5) ** 2 - m(45.5) ** 2) / (q(45.5) - q(29.5))
    c = m(29.5) ** 2 + n * q(29.5)
    rho0 = a * math.sqrt(c - n * q(23.0)) / n
    sql = f"SELECT *, sin(radians({lat})) AS sn, {n!r}*radians({lon} + 96.0) AS theta FROM ({source})"
    sql = (f"SELECT *, {1 - e2!r}*(sn/(1 - {e2!r}*sn*sn) - ln((1 - {e!r}*sn)/(1 + {e!r}*sn))/{2 * e!r}) AS qq "
           f"FROM ({sql})")
    sql = f"SELECT *, {a!r}*sqrt({c!r} - {n!r}*qq)/{n!r} AS rho FROM ({sql})"
    return f"SELECT *, rho*sin(theta) AS easting, {rho0!r} - rho*cos(theta) AS northing FROM ({sql})"
