"""Relations of many pairs at once: numpy over the edges of the shapes of two sides.

Most pairs of a join are plain: a point well inside, edges that cross or stay apart. These are answered here
by the formulas of ``relate``; pairs whose boundaries come within ``CLOSE`` tolerances of each other, and kinds of shapes
that no rule names, are ``UNSURE`` and left to ``relate`` itself. So both ways find the same pairs.

A query with many features in reach is tested against all of them at once (``judge_one``): its edges are single numbers
then, and nothing is gathered for a pair but the feature's positions.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa

from geolayer.functions import crs
from geolayer.functions.relate import pattern_regex

NO, YES, UNSURE = 0, 1, 2
#: Left to ``judge``, by ``judge_one``: it is told of many pairs at once.
LATER = 3
#: Boundaries nearer than so many tolerances are left to the exact test.
CLOSE = 1000.0
#: Most pairs of edges of two shapes that are tested here.
MAX_EDGE_PAIRS = 4096
#: Lines of at most so many edges are crossed with one query by products of matrices.
SHORT_LINE = 16
#: Positions and edges of one query tested in one go.
EDGE_STEP = 1 << 15
#: Distances up to here are told by chords, but for those within ``CHORD_MARGIN`` metres of the limit.
MAX_CHORD = 1_000_000
CHORD_MARGIN = 0.01


class Shapes:
    """Prepared geometries (``relate.prepare``) as flat arrays."""

    def __init__(self, prep: pa.StructArray) -> None:
        dim, verts, segs, ends = (prep.field(n) for n in ("dim", "verts", "segs", "ends"))
        self.dim = dim.to_numpy(zero_copy_only=False)
        self.n_verts, self.vert_at, (self.vx, self.vy) = _flat(verts, ("x", "y"))
        self.n_segs, self.seg_at, (self.x1, self.y1, self.x2, self.y2) = _flat(segs, ("x1", "y1", "x2", "y2"))
        self.n_ends, self.end_at, (self.ex, self.ey) = _flat(ends, ("x", "y"))
        self.spot = (self.dim == 0) & (self.n_verts == 1)
        self.all_spots = bool(self.spot.all())
        self.all_lines = bool((self.dim == 1).all())

    @cached_property
    def space(self) -> np.ndarray:
        """Places of the vertices of a geographic layer on the ellipsoid, in metres from its centre."""
        a, inv = crs.GRS80
        e2 = (2 - 1 / inv) / inv
        lon, lat = np.radians(self.vx), np.radians(self.vy)
        n = a / np.sqrt(1 - e2 * np.sin(lat) ** 2)
        return np.array([n * np.cos(lat) * np.cos(lon), n * np.cos(lat) * np.sin(lon), n * (1 - e2) * np.sin(lat)])

    @cached_property
    def tracks(self) -> Tracks:
        return Tracks(self)

    def edges_of(self, one: int) -> np.ndarray:
        """Ends of the edges of one shape: four rows, a column for an edge."""
        at = slice(self.seg_at[one], self.seg_at[one] + self.n_segs[one])
        return np.array([v[at] for v in (self.x1, self.y1, self.x2, self.y2)])

    def corners_of(self, one: int) -> np.ndarray:
        at = slice(self.vert_at[one], self.vert_at[one] + self.n_verts[one])
        return np.array([self.vx[at], self.vy[at]])

    def edges(self, at: np.ndarray) -> Iterator:
        """The first edges of the shapes ``at``, then the second ones, and so on, with the places that have one."""
        return _turns(self.n_segs[at], self.seg_at[at])

    def corners(self, at: np.ndarray) -> Iterator:
        return _turns(self.n_verts[at], self.vert_at[at])

    def box(self, at: np.ndarray) -> tuple[np.ndarray, ...]:
        """Envelopes of the shapes ``at``, and whether each is a rectangle along the axes."""
        low_x, low_y = np.full(len(at), np.inf), np.full(len(at), np.inf)
        high_x, high_y = -low_x, -low_y
        for live, i in self.corners(at):
            low_x[live] = np.minimum(low_x[live], self.vx[i])
            low_y[live] = np.minimum(low_y[live], self.vy[i])
            high_x[live] = np.maximum(high_x[live], self.vx[i])
            high_y[live] = np.maximum(high_y[live], self.vy[i])
        plain = (self.dim[at] == 2) & (self.n_verts[at] == 4) & (self.n_segs[at] == 4)
        for live, i in self.edges(at):
            plain[live] &= (self.x1[i] == self.x2[i]) | (self.y1[i] == self.y2[i])
        for live, i in self.corners(at):
            x, y = self.vx[i], self.vy[i]
            plain[live] &= ((x == low_x[live]) | (x == high_x[live])) & ((y == low_y[live]) | (y == high_y[live]))
        return low_x, low_y, high_x, high_y, plain


class Tracks:
    """The first ``SHORT_LINE`` edges of lines, laid out for ``_lines_cross``: by number of the edge, with a column for a line.

    A line with fewer edges than others has its last one again. ``edges`` are the starts, then the ends ``(x, y, 1)``, then
    the sides ``(a, b, c)``: ``a x + b y + c`` tells the side of a position, and no more than how far it is.
    """

    def __init__(self, lines: Shapes) -> None:
        n = int(np.clip(lines.n_segs.max(initial=0), 1, SHORT_LINE))
        at = lines.seg_at + np.minimum(np.arange(n)[:, None], np.maximum(lines.n_segs - 1, 0))
        at[:, lines.n_segs == 0] = 0
        x1, y1, x2, y2 = (v[at] if len(v) else np.zeros(at.shape) for v in (lines.x1, lines.y1, lines.x2, lines.y2))
        dx, dy, one = x2 - x1, y2 - y1, np.ones(at.shape)
        with np.errstate(divide="ignore", invalid="ignore"):
            long = np.abs(dx) + np.abs(dy)
            a, b = -dy / long, dx / long
        self.edges = np.concatenate([np.stack(v, axis=1) for v in (
            (x1, y1, one), (x2, y2, one), (a, b, -(a * x1 + b * y1)))])
        #: The lines this is all of.
        self.whole = (lines.n_segs > 0) & (lines.n_segs <= SHORT_LINE)
        #: Longer sides of their envelopes.
        self.size = np.maximum(*(
            np.maximum(v, w).max(axis=0) - np.minimum(v, w).min(axis=0) for v, w in ((x1, x2), (y1, y2))))

    def ends_and_sides(self, one: int) -> tuple[np.ndarray, np.ndarray]:
        """Ends of the edges of one line, starts first, and their sides: a row for each."""
        rows = self.edges[:, :, one]
        n = len(rows) // 3
        return rows[:2 * n], rows[2 * n:]


def _flat(lists: pa.ListArray, names: tuple[str, ...]) -> tuple:
    n = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = lists.flatten()
    columns = dict(zip([f.name for f in values.type], values.flatten()))
    return n, np.cumsum(n) - n, [columns[c].to_numpy(zero_copy_only=False) for c in names]


def _turns(n: np.ndarray, start: np.ndarray) -> Iterator:
    if not len(n):
        return
    least = int(n.min())
    for k in range(int(n.max())):
        if k < least:
            yield slice(None), start + k
        else:
            live = np.flatnonzero(n > k)
            yield live, start[live] + k


def _near(x: np.ndarray, y: np.ndarray, s: tuple, tol: float) -> np.ndarray:
    """``relate.near_segment``."""
    x1, y1, x2, y2 = s
    cross = (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1)
    len2 = (x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)
    near = cross * cross <= (tol * tol) * len2
    at = np.flatnonzero(near)
    if len(at):
        x, y, x1, y1, x2, y2 = (v[at] for v in (x, y, x1, y1, x2, y2))
        near[at] = ((x >= np.minimum(x1, x2) - tol) & (x <= np.maximum(x1, x2) + tol)
                    & (y >= np.minimum(y1, y2) - tol) & (y <= np.maximum(y1, y2) + tol))
    return near


def locate(x: np.ndarray, y: np.ndarray, b: Shapes, at: np.ndarray, tol: float) -> np.ndarray:
    """``relate.locate`` of a position in a line or area: interior 0, boundary 1, exterior 2."""
    on, odd = np.zeros(len(at), bool), np.zeros(len(at), bool)
    for live, i in b.edges(at):
        x1, y1, x2, y2 = b.x1[i], b.y1[i], b.x2[i], b.y2[i]
        px, py = x[live], y[live]
        on[live] |= _near(px, py, (x1, y1, x2, y2), tol)
        turn = (x2 - x1) * (py - y1) - (px - x1) * (y2 - y1)
        odd[live] ^= ((y1 > py) != (y2 > py)) & ((turn > 0) == (y2 > y1))
    area = b.dim[at] == 2
    place = np.where(area, np.where(on, 1, np.where(odd, 0, 2)), np.where(on, 0, 2))
    if not area.all():
        for live, i in _turns(b.n_ends[at], b.end_at[at]):
            end = ~area[live] & (np.abs(b.ex[i] - x[live]) <= tol) & (np.abs(b.ey[i] - y[live]) <= tol)
            place[live] = np.where(end, 1, place[live])
    return place


def _meetings(a: Shapes, ai: np.ndarray, b: Shapes, bi: np.ndarray, tol: float, contacts: bool) -> Meetings:
    """Where edges of the pairs cross (``relate._crossing``) and, with ``contacts``, where they come ``CLOSE``."""
    found = Meetings(len(ai))
    reach = CLOSE * tol
    for live, i in a.edges(ai):
        s = a.x1[i], a.y1[i], a.x2[i], a.y2[i]
        where = np.arange(len(ai)) if isinstance(live, slice) else live
        sx, sy = s[2] - s[0], s[3] - s[1]
        s_long = np.abs(sx) + np.abs(sy)
        for sub, j in b.edges(bi[where]):
            o = b.x1[j], b.y1[j], b.x2[j], b.y2[j]
            t = s if isinstance(sub, slice) else tuple(v[sub] for v in s)
            tx, ty, t_long = sx[sub], sy[sub], s_long[sub]
            ox, oy = o[2] - o[0], o[3] - o[1]
            o_long = np.abs(ox) + np.abs(oy)
            t1, t2 = tx * (o[1] - t[1]) - ty * (o[0] - t[0]), tx * (o[3] - t[1]) - ty * (o[2] - t[0])
            o1, o2 = ox * (t[1] - o[1]) - oy * (t[0] - o[0]), ox * (t[3] - o[1]) - oy * (t[2] - o[0])
            least_t, least_o = np.minimum(np.abs(t1), np.abs(t2)), np.minimum(np.abs(o1), np.abs(o2))
            hit = np.flatnonzero(
                (t1 * t2 < 0) & (o1 * o2 < 0) & (least_t > tol * t_long) & (least_o > tol * o_long))
            at = where[sub][hit]
            found.crossed[at] = True
            found.a_edge[at], found.b_edge[at] = i[sub][hit], j[hit]
            if contacts:
                # An end near the other edge's line is looked at again, with the edge's ends.
                at = np.flatnonzero((least_t <= reach * t_long) | (least_o <= reach * o_long))
                if len(at):
                    found.contact(where[sub][at], tuple(v[at] for v in t), tuple(v[at] for v in o), tol)
    return found


class Meetings:
    """What edges of pairs of shapes do to each other."""

    def __init__(self, n: int) -> None:
        self.crossed = np.zeros(n, bool)
        #: Edges come within ``CLOSE`` tolerances and do not just cross.
        self.close = np.zeros(n, bool)
        #: They do so without a clear contact: an end nearly on the other edge, or edges nearly parallel.
        self.vague = np.zeros(n, bool)
        #: Edges run along each other for a while.
        self.shared = np.zeros(n, bool)
        #: A crossing of each pair.
        self.a_edge, self.b_edge = np.zeros(n, np.int64), np.zeros(n, np.int64)

    def of(self, at: np.ndarray) -> Meetings:
        """Those of some pairs."""
        part = Meetings(0)
        for name, values in vars(self).items():
            setattr(part, name, values[at])
        return part

    def contact(self, at: np.ndarray, p: tuple, q: tuple, tol: float) -> None:
        """Note for the pairs ``at`` how their edges ``p`` and ``q`` come close."""
        reach, exact = CLOSE * tol, tol / 100
        near, vague = np.zeros(len(at), bool), np.zeros(len(at), bool)
        for s, o in ((p, q), (q, p)):
            for k in (0, 2):
                end = _near(o[k], o[k + 1], s, reach)
                near |= end
                vague[end] |= ~_near(o[k][end], o[k + 1][end], tuple(v[end] for v in s), exact)
        at, vague = at[near], vague[near]
        (px1, py1, px2, py2), (qx1, qy1, qx2, qy2) = (tuple(v[near] for v in e) for e in (p, q))
        dx, dy, ex, ey = px2 - px1, py2 - py1, qx2 - qx1, qy2 - qy1
        long_p, long_q = np.hypot(dx, dy), np.hypot(ex, ey)
        along = np.abs(dx * ey - dy * ex) <= 0.05 * long_p * long_q
        # Ends of one along the other: they share a stretch if both lie on its line.
        t1, t2 = (((x - px1) * dx + (y - py1) * dy) / long_p for x, y in ((qx1, qy1), (qx2, qy2)))
        off = np.maximum(*(np.abs(dx * (y - py1) - dy * (x - px1)) / long_p for x, y in ((qx1, qy1), (qx2, qy2))))
        both = np.minimum(np.maximum(t1, t2), long_p) - np.maximum(np.minimum(t1, t2), 0)
        self.shared[at[along & (off <= exact) & (both > reach)]] = True
        self.close[at] = True
        self.vague[at[vague | along]] = True


def _flips(p: Shapes, edge: np.ndarray, q: Shapes, at: np.ndarray, x: np.ndarray, y: np.ndarray,
           tol: float) -> np.ndarray:
    """Whether an edge of ``p`` goes from the inside to the outside of ``q`` at a position."""
    dx, dy = p.x2[edge] - p.x1[edge], p.y2[edge] - p.y1[edge]
    step = 100 * tol / np.hypot(dx, dy)
    before = locate(x - dx * step, y - dy * step, q, at, tol)
    return before + locate(x + dx * step, y + dy * step, q, at, tol) == 2 * (before != 1)


def _cut(a: Shapes, ai: np.ndarray, b: Shapes, bi: np.ndarray, met: Meetings, tol: float) -> np.ndarray:
    """Whether the boundaries of the pairs cross for sure: with two areas, each boundary goes from the inside to the
    outside of the other one there; with a line and an area, the line does."""
    at = np.flatnonzero(met.crossed)
    i, j = met.a_edge[at], met.b_edge[at]
    dx, dy, ex, ey = a.x2[i] - a.x1[i], a.y2[i] - a.y1[i], b.x2[j] - b.x1[j], b.y2[j] - b.y1[j]
    with np.errstate(divide="ignore", invalid="ignore"):
        t = ((b.x1[j] - a.x1[i]) * ey - (b.y1[j] - a.y1[i]) * ex) / (dx * ey - dy * ex)
    x, y = a.x1[i] + t * dx, a.y1[i] + t * dy
    good = np.isfinite(t)
    for p, pi, edge, q, qi in ((a, ai, i, b, bi), (b, bi, j, a, ai)):
        area = np.flatnonzero(good & (q.dim[qi[at]] == 2))
        good[area] = _flips(p, edge[area], q, qi[at[area]], x[area], y[area], tol)
    sure = np.zeros(len(ai), bool)
    sure[at[good]] = True
    return sure


def _corners_inside(a: Shapes, ai: np.ndarray, b: Shapes, bi: np.ndarray, tol: float, edge: bool) -> np.ndarray:
    """How many corners of each ``a`` lie in the interior of ``b``, with ``edge`` or on its boundary."""
    found = np.zeros(len(ai), np.int64)
    for live, i in a.corners(ai):
        at = bi[live]
        place = locate(a.vx[i], a.vy[i], b, at, tol)
        found[live] += (place != 2) if edge else (place == 0) & (b.dim[at] == 2)
    return found


def _spots(relation: str, place: np.ndarray, feature: bool, first: bool, pattern: str | None) -> np.ndarray:
    """What a single point and an area are to each other; ``feature`` if the point is the feature, ``first`` if
    it is the first operand of a pattern."""
    inside, edge = place == 0, place == 1
    if relation == "intersects":
        return inside | edge
    if relation == "touches":
        return edge
    if relation == ("within" if feature else "contains"):
        return inside
    if relation != "relate":
        return np.zeros(len(place), bool)
    def fits(matrix: str) -> bool:
        turned = matrix if first else "".join(matrix[j * 3 + i] for i in range(3) for j in range(3))
        return bool(re.match(pattern_regex(pattern), turned))

    return (inside & fits("0FFFFF212")) | (edge & fits("F0FFFF212"))


def _boxes_touch(a: tuple, b: tuple, tol: float) -> np.ndarray:
    """Whether rectangles along the axes only touch; ``UNSURE`` where they nearly do."""
    gaps = [np.minimum(a[2 + k], b[2 + k]) - np.maximum(a[k], b[k]) for k in (0, 1)]
    says = np.full(len(gaps[0]), UNSURE, np.int8)
    wide = np.ones(len(says), bool)
    for s in (a, b):
        wide &= (s[2] - s[0] > CLOSE * tol) & (s[3] - s[1] > CLOSE * tol)
    deep = [gap > CLOSE * tol / 2 for gap in gaps]
    even = [np.abs(gap) <= tol / 2 for gap in gaps]
    says[wide & ((gaps[0] < -2 * tol) | (gaps[1] < -2 * tol))] = NO
    says[wide & deep[0] & deep[1]] = NO
    says[wide & ((even[0] & (even[1] | deep[1])) | (deep[0] & even[1]))] = YES
    return says


def _extents_say(relation: str, a: Shapes, ai: np.ndarray, b: Shapes, bi: np.ndarray, tol: float) -> np.ndarray:
    """Pairs of lines and areas."""
    if relation == "intersects":
        found = np.zeros(len(ai), bool)
        for p, pi, q, qi in ((a, ai, b, bi), (b, bi, a, ai)):
            rest = np.flatnonzero(~found)
            found[rest] = _corners_inside(p, pi[rest], q, qi[rest], tol, True) > 0
        rest = np.flatnonzero(~found)
        found[rest] = _meetings(a, ai[rest], b, bi[rest], tol, False).crossed
        return found.astype(np.int8)
    met = _meetings(a, ai, b, bi, tol, True)
    says = np.full(len(ai), UNSURE, np.int8)
    dims = a.dim[ai] + b.dim[bi]
    if relation != "relate":
        says[met.crossed & ~met.close & (dims == 2)] = YES if relation == "crosses" else NO
        areas = np.flatnonzero(met.crossed & (dims > 2))
        cut = areas[_cut(a, ai[areas], b, bi[areas], met.of(areas), tol)]
        yes = {"crosses": dims == 3, "overlaps": dims == 4}.get(relation, np.zeros(len(ai), bool))
        says[cut] = yes[cut]
    if relation == "crosses":
        says[met.shared & (dims == 2)] = NO
        at = np.flatnonzero(met.close & ~met.vague & (dims == 2))
        hold = met.crossed[at]
        for p, pi, q, qi in ((a, ai, b, bi), (b, bi, a, ai)):
            hold = hold | _inner_corners_meet(p, pi[at], q, qi[at], tol)
        says[at] = hold
    free = ~met.crossed & ~met.close
    says[free & (dims == 2)] = NO
    free = np.flatnonzero(free & (dims > 2))
    ai, bi = ai[free], bi[free]
    a_in, b_in = _corners_inside(a, ai, b, bi, tol, False), _corners_inside(b, bi, a, ai, tol, False)
    says[free[(a_in == 0) & (b_in == 0)]] = NO
    if relation != "relate":
        says[free[(a_in == a.n_verts[ai]) & (b_in == 0)]] = YES if relation == "within" else NO
        says[free[(b_in == b.n_verts[bi]) & (a_in == 0)]] = YES if relation == "contains" else NO
    return says


def _inner_corners_meet(p: Shapes, pi: np.ndarray, q: Shapes, qi: np.ndarray, tol: float) -> np.ndarray:
    """Whether a corner of the line ``p`` lies in the interior of both lines."""
    found = np.zeros(len(pi), bool)
    for live, i in p.corners(pi):
        x, y = p.vx[i], p.vy[i]
        found[live] |= (locate(x, y, q, qi[live], tol) == 0) & (locate(x, y, p, pi[live], tol) == 0)
    return found


def judge(
    relation: str, a: Shapes, ai: np.ndarray, b: Shapes, bi: np.ndarray, tol: float,
    pattern: str | None = None, feature_first: bool = True,
) -> np.ndarray:
    """``NO``, ``YES`` or ``UNSURE`` for ``relation(feature, query)`` of the pairs ``(ai, bi)``."""
    says = np.full(len(ai), UNSURE, np.int8)
    da, db = a.dim[ai], b.dim[bi]
    for p, pi, q, qi, mine in ((a, ai, b, bi, True), (b, bi, a, ai, False)):
        at = np.flatnonzero(p.spot[pi] & (q.dim[qi] == 2))
        if not len(at):
            continue
        spot, area = p.vert_at[pi[at]], qi[at]
        answer = _spots(relation, locate(p.vx[spot], p.vy[spot], q, area, tol), mine,
                        mine == feature_first, pattern).astype(np.int8)
        if relation == "relate":
            low_x, low_y, high_x, high_y, _ = q.box(area)
            tiny = np.maximum(high_x - low_x, high_y - low_y) <= 20 * tol * q.n_segs[area]
            answer[tiny] = UNSURE
        says[at] = answer
    at = np.flatnonzero((da > 0) & (db > 0) & (a.n_segs[ai] * b.n_segs[bi] <= MAX_EDGE_PAIRS))
    if len(at) and relation == "equals":
        # Equal shapes reach equally far, and the exact test is left to say the rest.
        one, two = a.box(ai[at]), b.box(bi[at])
        apart = np.zeros(len(at), bool)
        for k in range(4):
            apart |= np.abs(one[k] - two[k]) > 4 * tol
        says[at[apart]] = NO
        return says
    if len(at) and relation == "touches":
        one, two = a.box(ai[at]), b.box(bi[at])
        both = one[4] & two[4]
        says[at[both]] = _boxes_touch(
            tuple(v[both] for v in one[:4]), tuple(v[both] for v in two[:4]), tol)
        at = at[~both]
    if len(at):
        says[at] = _extents_say(relation, a, ai[at], b, bi[at], tol)
    return says


def _inside(x: np.ndarray, y: np.ndarray, edges: np.ndarray, tol: float) -> tuple[np.ndarray, np.ndarray]:
    """Whether positions lie inside an area by its edges, and whether they lie on one (``locate``)."""
    on, odd = np.zeros(len(x), bool), np.zeros(len(x), bool)
    x1, y1, x2, y2 = edges[:, :, None]
    dx, dy, up = x2 - x1, y2 - y1, y2 > y1
    reach = (tol * tol) * (dx * dx + dy * dy)
    for at in _slices(len(x), len(x1)):
        px, py = x[at], y[at]
        turn = dx * (py - y1) - (px - x1) * dy
        e, i = np.nonzero(turn * turn <= reach)
        if len(e):
            qx, qy, (ax, ay, bx, by) = px[i], py[i], edges[:, e]
            hold = ((qx >= np.minimum(ax, bx) - tol) & (qx <= np.maximum(ax, bx) + tol)
                    & (qy >= np.minimum(ay, by) - tol) & (qy <= np.maximum(ay, by) + tol))
            on[at.start + i[hold]] = True
        odd[at] = np.bitwise_xor.reduce(((y1 > py) != (y2 > py)) & ((turn > 0) == up), axis=0)
    return odd, on


def _slices(n: int, edges: int) -> Iterator[slice]:
    """Parts of ``n`` positions whose pairs with ``edges`` are few enough to be at hand."""
    step = max(EDGE_STEP // edges, 1)
    return (slice(s, min(s + step, n)) for s in range(0, n, step))


def _lines_meet(a: Shapes, at: np.ndarray, b: Shapes, q: int, tol: float) -> np.ndarray:
    """Which of the lines ``at`` meet the area ``q``: what ``_extents_say`` finds, in the order of what is cheap."""
    edges, corners = b.edges_of(q), b.corners_of(q)
    found, close = np.zeros(len(at), bool), np.zeros(len(at), bool)
    rest = np.arange(len(at))
    for k in range(int(a.n_verts[at].max())):
        live = rest[a.n_verts[at[rest]] > k]
        i = a.vert_at[at[live]] + k
        odd, on = _inside(a.vx[i], a.vy[i], edges, tol)
        found[live[odd | on]] = True
        rest = rest[~found[rest]]
    p1, q1, p2, q2 = edges[:, :, None]
    ox, oy = p2 - p1, q2 - q1
    o_long = tol * (np.abs(ox) + np.abs(oy))[:, 0]
    for k in range(int(a.n_segs[at[rest]].max(initial=0))):
        live = rest[a.n_segs[at[rest]] > k]
        for part in _slices(len(live), edges.shape[1]):
            here = live[part]
            i = a.seg_at[at[here]] + k
            x1, y1, x2, y2 = a.x1[i], a.y1[i], a.x2[i], a.y2[i]
            tx, ty = x2 - x1, y2 - y1
            t_long = tol * (np.abs(tx) + np.abs(ty))
            # A corner of the area is on a line only if it is near the line's edge.
            far = np.abs(tx * (corners[1][:, None] - y1) - ty * (corners[0][:, None] - x1))
            close[here[(far <= 4 * t_long).any(axis=0)]] = True
            o1, o2 = ox * (y1 - q1) - oy * (x1 - p1), ox * (y2 - q1) - oy * (x2 - p1)
            e, i = np.nonzero(o1 * o2 < 0)
            (ax, ay, bx, by), sx, sy, x, y = edges[:, e], tx[i], ty[i], x1[i], y1[i]
            t1, t2 = sx * (ay - y) - sy * (ax - x), sx * (by - y) - sy * (bx - x)
            hit = ((t1 * t2 < 0) & (np.minimum(np.abs(t1), np.abs(t2)) > t_long[i])
                   & (np.minimum(np.abs(o1[e, i]), np.abs(o2[e, i])) > o_long[e]))
            found[here[i[hit]]] = True
        rest = rest[~found[rest]]
    check = np.flatnonzero(close & ~found)
    if len(check):
        found[check] = _corners_inside(b, np.full(len(check), q), a, at[check], tol, True) > 0
    return found


def _lines_cross(a: Shapes, at: np.ndarray, b: Shapes, q: int, tol: float) -> np.ndarray:
    """Whether the lines ``at`` and the line ``q``, whose envelopes meet, cross; ``LATER`` where an end of an edge comes
    close to the line of another one, and for long lines.

    Ends that are not close are on a side for sure, and edges cross where each has its ends on two sides of the other:
    what ``_extents_say`` finds. The product of the distances of two ends is small if one of them is.
    """
    ends, sides = b.tracks.ends_and_sides(q)
    says = np.empty(len(at), np.int8)
    k, n = len(a.tracks.edges) // 3, len(sides)
    for part in _slices(len(at), k * n):
        edges = a.tracks.edges.take(at[part], axis=2)
        mine, theirs = sides @ edges[:2 * k], ends @ edges[2 * k:]
        mine, theirs = mine[:k] * mine[k:], theirs[:, :n] * theirs[:, n:]
        crossed = np.maximum(mine, theirs).min(axis=(0, 1)) < 0
        clear = np.minimum(np.abs(mine, out=mine), np.abs(theirs, out=theirs)).min(axis=(0, 1))
        # No distance is longer than both sizes together, so a product above this has no small factor.
        clear = clear > 2 * CLOSE * tol * (a.tracks.size[at[part]] + b.tracks.size[q] + CLOSE * tol)
        # Not a number is not clear either.
        says[part] = np.where(clear & a.tracks.whole[at[part]], crossed, LATER)
    return says


def judge_one(
    relation: str, a: Shapes, at: np.ndarray, b: Shapes, q: int, tol: float,
    pattern: str | None = None, feature_first: bool = True,
) -> np.ndarray:
    """``judge`` of the features ``at`` and one query; ``LATER`` where it takes ``judge``."""
    area = b.dim[q] == 2 and b.n_segs[q] > 0
    if area and a.all_spots and relation != "relate":
        odd, on = _inside(a.vx[at], a.vy[at], b.edges_of(q), tol)
        return _spots(relation, np.where(on, 1, np.where(odd, 0, 2)), True, feature_first, pattern).astype(np.int8)
    if (area and a.all_lines and relation == "intersects"
            and a.n_segs[at].max(initial=0) * b.n_segs[q] <= MAX_EDGE_PAIRS):
        return _lines_meet(a, at, b, q, tol).astype(np.int8)
    if relation == "crosses" and a.all_lines and b.dim[q] == 1 and 0 < b.n_segs[q] <= SHORT_LINE:
        return _lines_cross(a, at, b, q, tol)
    return judge(relation, a, at, b, np.full(len(at), q), tol, pattern, feature_first)


def near_spots(a: Shapes, ai: np.ndarray, b: Shapes, bi: np.ndarray | int, metres: float) -> np.ndarray:
    """Whether single points of a geographic layer are at most ``metres`` apart (``crs.nearer_than``); ``bi`` may be
    one query for all."""
    says = np.full(len(ai), UNSURE, np.int8)
    spots = a.spot[ai] & b.spot[bi]
    at = slice(None) if spots.all() else np.flatnonzero(spots)
    pa_, pb = a.vert_at[ai[at]], b.vert_at[bi if np.ndim(bi) == 0 else bi[at]]

    def lonlat(near: np.ndarray | slice) -> list[np.ndarray]:
        i, j = pa_[near], np.broadcast_to(pb, pa_.shape)[near]
        return [np.radians(v) for v in (a.vx[i], a.vy[i], b.vx[j], b.vy[j])]

    if metres <= MAX_CHORD:
        # A geodesic is no shorter than its chord, and no longer than the arc of the smallest radius of curvature on it.
        major, inv = crs.GRS80
        radius = major * (1 - 1 / inv) ** 2
        least = 2 * radius * math.sin(max(metres - CHORD_MARGIN, 0) / (2 * radius))
        d = 0.0
        for u, v in zip(a.space, b.space):
            step = u[pa_] - v[pb]
            d = d + step * step
        found = (d < least * least).astype(np.int8)
        edge = np.flatnonzero((d >= least * least) & (d <= (metres + CHORD_MARGIN) ** 2))
    else:
        lon1, lat1, lon2, lat2 = lonlat(slice(None))
        dlat, dlon = np.sin((lat2 - lat1) / 2), np.sin((lon2 - lon1) / 2)
        h = dlat * dlat + np.cos(lat1) * np.cos(lat2) * dlon * dlon
        d = 2 * crs.MEAN_RADIUS * np.arcsin(np.minimum(1.0, np.sqrt(h)))
        found = np.where(d < metres * 0.99, YES, NO).astype(np.int8)
        edge = np.flatnonzero((d >= metres * 0.99) & (d <= metres * 1.01))
    if len(edge):
        exact = _geodesic(*lonlat(edge))
        found[edge] = np.where(exact < metres - 1e-5, YES, np.where(exact > metres + 1e-5, NO, UNSURE))
    says[at] = found
    return says


def _geodesic(lon1: np.ndarray, lat1: np.ndarray, lon2: np.ndarray, lat2: np.ndarray) -> np.ndarray:
    """``crs.geodesic`` of positions in radians; not a number where the steps do not settle."""
    a, inv = crs.GRS80
    f = 1 / inv
    b = a * (1 - f)
    u1, u2, away = np.arctan((1 - f) * np.tan(lat1)), np.arctan((1 - f) * np.tan(lat2)), lon2 - lon1
    s1, c1, s2, c2 = np.sin(u1), np.cos(u1), np.sin(u2), np.cos(u2)
    lam = last = away
    with np.errstate(divide="ignore", invalid="ignore"):
        for turn in range(7):
            side, cross = c2 * np.sin(lam), c1 * s2 - s1 * c2 * np.cos(lam)
            ss, cs = np.sqrt(side * side + cross * cross), s1 * s2 + c1 * c2 * np.cos(lam)
            sa = np.where(ss == 0, 0.0, c1 * c2 * np.sin(lam) / ss)
            q = 1 - sa * sa
            sig = np.arctan2(ss, cs)
            cm = np.where(q == 0, 0.0, cs - 2 * s1 * s2 / q)
            cc = f / 16 * q * (4 + f * (4 - 3 * q))
            if turn < 6:
                last = lam
                lam = away + (1 - cc) * f * sa * (sig + cc * ss * (cm + cc * cs * (2 * cm * cm - 1)))
        k = q * (a * a - b * b) / (b * b)
        big = 1 + k / 16384 * (4096 + k * (-768 + k * (320 - 175 * k)))
        small = k / 1024 * (256 + k * (-128 + k * (74 - 47 * k)))
        bend = small * ss * (cm + small / 4 * (cs * (2 * cm * cm - 1) - small / 6 * cm * (
            4 * ss * ss - 3) * (4 * cm * cm - 3)))
    return np.where(np.abs(lam - last) < 1e-9, b * big * (sig - bend), np.nan)
