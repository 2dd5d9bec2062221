"""Conic, azimuthal and ellipsoidal Mercator projections as column math.

Each family is one pair of formulas over the sine of the latitude; the constants of a CRS are worked
out here once and written into the text. Angles are degrees outside, radians inside. Formulas are
the published ones for the ellipsoid (Snyder, "Map Projections: A Working Manual").
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from geolayer.functions.sql import add, let, num, struct


@dataclass(frozen=True)
class Projection:
    """A CRS of one of the families: angles in degrees, offsets in metres."""

    family: str
    ellipsoid: tuple[float, float]
    lon0: float
    lat0: float = 0.0
    parallels: tuple[float, float] = (0.0, 0.0)
    east: float = 0.0
    north: float = 0.0

    @property
    def a(self) -> float:
        return self.ellipsoid[0]

    @property
    def ecc(self) -> float:
        f = 1.0 / self.ellipsoid[1]
        return math.sqrt(f * (2 - f))

    def scale(self, degrees: float) -> float:
        """Radius of a parallel over the semi-major axis."""
        s = math.sin(math.radians(degrees))
        return math.cos(math.radians(degrees)) / math.sqrt(1 - (self.ecc * s) ** 2)

    def isometric(self, degrees: float) -> float:
        s = math.sin(math.radians(degrees))
        return math.atanh(s) - self.ecc * math.atanh(self.ecc * s)

    def authalic(self, s: float) -> float:
        """Twice the area between equator and parallel over a turn and a squared axis."""
        return (1 - self.ecc**2) * (s / (1 - (self.ecc * s) ** 2) + math.atanh(self.ecc * s) / self.ecc)

    def area_of(self, degrees: float) -> float:
        return self.authalic(math.sin(math.radians(degrees)))


def _xy(x: str, y: str) -> str:
    return struct(x=x, y=y)


def _isometric(p: Projection, s: str) -> str:
    return f"(atanh({s}) - {num(p.ecc)} * atanh({num(p.ecc)} * {s}))"


def _authalic(p: Projection, s: str) -> str:
    e = num(p.ecc)
    return (f"({num(1 - p.ecc**2)} * ({s} / (1 - {e} * {s} * {e} * {s}) + atanh({e} * {s}) / {e}))")


def _from_isometric(psi: str, terms: list[float]) -> str:
    """Latitude in degrees by the series over the conformal latitude."""
    return let(f"atan(sinh({psi}))", lambda chi: "degrees(" + add(
        [chi, *[f"{num(c)} * sin({2 * j} * {chi})" for j, c in enumerate(terms, 1)]]) + ")")


def _from_authalic(p: Projection, q: str) -> str:
    """Latitude in degrees: a series to the sixth power, then two Newton steps off the poles."""
    e2, e = p.ecc**2, num(p.ecc)
    # Published series from authalic to geodetic latitude.
    terms = (e2 / 3 + 31 * e2**2 / 180 + 517 * e2**3 / 5040, 23 * e2**2 / 360 + 251 * e2**3 / 3780,
             761 * e2**3 / 45360)

    def refined(phi: str, area: str, left: int) -> str:
        if not left:
            return f"degrees({phi})"
        step = let(f"sin({phi})", lambda s: (
            f"IF(cos({phi}) < 1e-6D, {phi}, {phi} + power(1 - {e} * {s} * {e} * {s}, 2) / (2 * cos({phi})) "
            f"* ({area} - {_authalic(p, s)}) / {num(1 - e2)})"))
        return let(step, lambda new: refined(new, area, left - 1))

    def started(area: str) -> str:
        beta = f"asin(greatest(-1.0D, least(1.0D, {area} / {num(p.authalic(1.0))})))"
        return let(beta, lambda b: let(add(
            [b, *[f"{num(c)} * sin({2 * j} * {b})" for j, c in enumerate(terms, 1)]]),
            lambda phi: refined(phi, area, 2)))

    return let(q, started)


def _turned(lon: str, p: Projection) -> str:
    """Longitude from the central meridian in radians, within half a turn."""
    return f"radians(pmod({lon} - {num(p.lon0)} + 180.0D, 360.0D) - 180.0D)"


def _cone(p: Projection) -> tuple[float, float, float]:
    """Constant of the cone, its second constant, and the radius at the origin."""
    lat1, lat2 = p.parallels
    if p.family == "albers":
        m1, q1 = p.scale(lat1), p.area_of(lat1)
        n = (m1**2 - p.scale(lat2)**2) / (p.area_of(lat2) - q1) if lat1 != lat2 else (
            math.sin(math.radians(lat1)))
        c = m1**2 + n * q1
        return n, c, p.a * math.sqrt(c - n * p.area_of(p.lat0)) / n
    psi1 = p.isometric(lat1)
    n = (math.log(p.scale(lat1) / p.scale(lat2)) / (p.isometric(lat2) - psi1) if lat1 != lat2 else
         math.sin(math.radians(lat1)))
    c = p.scale(lat1) / n * math.exp(n * psi1)
    return n, c, p.a * c * math.exp(-n * p.isometric(p.lat0))


def _sphere(p: Projection) -> tuple[float, float, float, float]:
    """Sine and cosine of the authalic latitude of the origin, radius, stretch."""
    sin1 = p.area_of(p.lat0) / p.authalic(1.0)
    cos1 = math.sqrt(1 - sin1**2)
    radius = p.a * math.sqrt(p.authalic(1.0) / 2)
    return sin1, cos1, radius, p.a * p.scale(p.lat0) / (radius * cos1)


def forward(lon: str, lat: str, p: Projection) -> str:
    """Struct ``(x, y)`` in metres of a position in degrees."""
    a, east, north = num(p.a), num(p.east), num(p.north)
    start = struct(s=f"sin(radians({lat}))", lam=_turned(lon, p))
    if p.family == "mercator":
        return let(start, lambda q: _xy(
            f"{east} + {a} * {q}.lam", f"{north} + {a} * {_isometric(p, f'{q}.s')}"))
    if p.family == "azimuthal":
        sin1, cos1, radius, stretch = _sphere(p)

        def flat(b: str) -> str:
            k = (f"{num(radius)} * sqrt(2 / (1 + {num(sin1)} * {b}.sb + {num(cos1)} * {b}.cb * cos({b}.lam)))")
            return let(k, lambda k: _xy(
                f"{east} + {k} * {num(stretch)} * {b}.cb * sin({b}.lam)",
                f"{north} + {k} / {num(stretch)} * ({num(cos1)} * {b}.sb - {num(sin1)} * {b}.cb * cos({b}.lam))"))

        share = let(start, lambda q: struct(
            sb=f"greatest(-1.0D, least(1.0D, {_authalic(p, f'{q}.s')} / {num(p.authalic(1.0))}))",
            lam=f"{q}.lam"))
        return let(let(share, lambda b: struct(
            sb=f"{b}.sb", cb=f"sqrt(1 - {b}.sb * {b}.sb)", lam=f"{b}.lam")), flat)
    n, c, rho0 = _cone(p)
    rho = (lambda s: f"{num(p.a / n)} * sqrt({num(c)} - {num(n)} * {_authalic(p, s)})") if (
        p.family == "albers") else (lambda s: f"{num(p.a * c)} * exp({num(-n)} * {_isometric(p, s)})")
    polar = let(start, lambda q: struct(rho=rho(f"{q}.s"), theta=f"{num(n)} * {q}.lam"))
    return let(polar, lambda r: _xy(
        f"{east} + {r}.rho * sin({r}.theta)", f"{north} + {num(rho0)} - {r}.rho * cos({r}.theta)"))


def inverse(x: str, y: str, p: Projection, latitude: list[float]) -> str:
    """Struct ``(x, y)`` in degrees of a position in metres.

    ``latitude`` is the series of the ellipsoid from conformal to geodetic latitude.
    """
    def lon(radians: str) -> str:
        return f"pmod(degrees({radians}) + {num(p.lon0)} + 180.0D, 360.0D) - 180.0D"

    here = _xy(f"{x} - {num(p.east)}", f"{y} - {num(p.north)}")
    if p.family == "mercator":
        return let(here, lambda v: _xy(
            lon(f"{v}.x / {num(p.a)}"), _from_isometric(f"{v}.y / {num(p.a)}", latitude)))
    if p.family == "azimuthal":
        sin1, cos1, radius, stretch = _sphere(p)

        def turned(v: str) -> str:
            size = struct(u=f"{v}.x / {num(stretch)}", w=f"{v}.y * {num(stretch)}")
            arc = let(size, lambda z: struct(u=f"{z}.u", w=f"{z}.w", r=f"sqrt({z}.u * {z}.u + {z}.w * {z}.w)"))
            return let(let(arc, lambda z: struct(
                u=f"{z}.u", w=f"{z}.w", r=f"{z}.r", c=f"2 * asin({z}.r / {num(2 * radius)})")), lambda z: _xy(
                    lon(f"IF({z}.r = 0, 0.0D, atan2({z}.u * sin({z}.c), {z}.r * {num(cos1)} * cos({z}.c) "
                        f"- {z}.w * {num(sin1)} * sin({z}.c)))"),
                    _from_authalic(p, f"{num(p.authalic(1.0))} * (cos({z}.c) * {num(sin1)} + "
                                      f"IF({z}.r = 0, 0.0D, {z}.w * sin({z}.c) * {num(cos1)} / {z}.r))")))

        return let(here, turned)
    n, c, rho0 = _cone(p)
    sign = num(math.copysign(1.0, n))
    polar = let(here, lambda v: struct(
        rho=f"{sign} * sqrt({v}.x * {v}.x + ({num(rho0)} - {v}.y) * ({num(rho0)} - {v}.y))",
        theta=f"atan2({sign} * {v}.x, {sign} * ({num(rho0)} - {v}.y))"))

    def degrees(r: str) -> str:
        if p.family == "albers":
            lat = _from_authalic(p, f"({num(c)} - power({r}.rho * {num(n / p.a)}, 2)) / {num(n)}")
        else:
            lat = _from_isometric(f"(-ln({r}.rho / {num(p.a * c)}) / {num(n)})", latitude)
        return _xy(lon(f"{r}.theta / {num(n)}"), lat)

    return let(polar, degrees)
