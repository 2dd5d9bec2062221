"""Shells and holes of a polygon held as a list of rings.

A ring lies in another if its envelope does and one of its positions does, so each pair of rings
costs an envelope comparison and only nested envelopes a ring test. Rings at even depth are
shells, those at odd depth holes of the smallest ring around them. All of it is array functions on
one row; rings may touch, but crossing rings have no nesting and are taken as given.
"""

from __future__ import annotations

from geolayer.functions.sql import each, each_indexed, keep, let, num, some, struct

# Positions closer to an edge than this share of its length count as on it.
ON_EDGE = 1e-12


def twice_area(ring: str) -> str:
    """Twice the signed area of a closed ring, positive if it runs counterclockwise."""
    def term(v: str, i: str) -> str:
        return let(f"get({ring}, {i} + 1)", lambda w: let(f"get({ring}, 0)", lambda o: (
            f"coalesce(({v}.x - {o}.x) * ({w}.y - {o}.y) - ({w}.x - {o}.x) * ({v}.y - {o}.y), 0.0D)")))

    return f"aggregate({each_indexed(ring, term)}, 0.0D, (total, term) -> total + term)"


def oriented(ring: str, clockwise: bool) -> str:
    """The ring in the asked direction; its first position stays first."""
    wrong = ">" if clockwise else "<"
    return f"IF({twice_area(ring)} {wrong} 0, reverse({ring}), {ring})"


def _edges(ring: str, test: str) -> str:
    """Edges ``a`` to ``b`` of a ring that pass a test."""
    return f"filter({ring}, (b, i) -> i > 0 AND {test.replace('a.', f'get({ring}, i - 1).')})"


def _odd(x: str, y: str, ring: str) -> str:
    crossed = (f"(a.y > {y}) != (b.y > {y}) AND "
               f"{x} < (a.x - b.x) * ({y} - b.y) / (a.y - b.y) + b.x")
    return f"size({_edges(ring, crossed)}) % 2 = 1"


def _on(x: str, y: str, ring: str) -> str:
    dx, dy = "(b.x - a.x)", "(b.y - a.y)"
    near = (f"abs({dx} * ({y} - a.y) - {dy} * ({x} - a.x)) <= {num(ON_EDGE)} * ({dx} * {dx} + {dy} * {dy}) "
            f"AND {x} BETWEEN least(a.x, b.x) AND greatest(a.x, b.x) "
            f"AND {y} BETWEEN least(a.y, b.y) AND greatest(a.y, b.y)")
    return f"size({_edges(ring, near)}) > 0"


def _inside(ring: str, around: str) -> str:
    """Whether a ring lies in another; positions on the other one do not tell."""
    middles = each_indexed(f"slice({ring}, 1, size({ring}) - 1)", lambda v, i: let(
        f"get({ring}, {i} + 1)", lambda w: struct(x=f"({v}.x + {w}.x) / 2", y=f"({v}.y + {w}.y) / 2")))
    spots = f"concat({each(ring, lambda v: struct(x=f'{v}.x', y=f'{v}.y'))}, {middles})"
    search = some(spots, lambda p: (
        f"{_odd(f'{p}.x', f'{p}.y', around)} AND NOT {_on(f'{p}.x', f'{p}.y', around)}"))
    return let(f"get({ring}, 0)", lambda p: (
        f"IF({_on(f'{p}.x', f'{p}.y', around)}, {search}, {_odd(f'{p}.x', f'{p}.y', around)})"))


def _described(parts: str) -> str:
    return each_indexed(parts, lambda r, i: struct(
        no=i, ring=r, area=f"abs({twice_area(r)})", w=f"array_min({r}.x)", e=f"array_max({r}.x)",
        s=f"array_min({r}.y)", n=f"array_max({r}.y)"))


def _nested(rings: str) -> str:
    """Rings with their depth and the number of the smallest ring around them."""
    def placed(r: str) -> str:
        around = keep(rings, lambda o: (
            f"{o}.area > {r}.area AND {o}.w <= {r}.w AND {o}.e >= {r}.e AND {o}.s <= {r}.s "
            f"AND {o}.n >= {r}.n AND {_inside(f'{r}.ring', f'{o}.ring')}"))
        return let(around, lambda a: struct(
            no=f"{r}.no", ring=f"{r}.ring", depth=f"size({a})",
            holder=f"array_min({each(a, lambda o: struct(area=f'{o}.area', no=f'{o}.no'))}).no"))

    return each(rings, placed)


def polygons(parts: str) -> str:
    """Rings grouped to polygons, each a shell and then its holes, in the order given."""
    def grouped(rings: str) -> str:
        shells = keep(rings, lambda r: f"{r}.depth % 2 = 0")
        return each(shells, lambda s: "concat(array({0}.ring), {1})".format(s, each(
            keep(rings, lambda h: f"{h}.depth % 2 = 1 AND {h}.holder = {s}.no"), lambda h: f"{h}.ring")))

    nested = let(let(_described(parts), _nested), grouped)
    return f"IF(size({parts}) <= 1, array({parts}), {nested})"
