"""Points in areas of many edges: the edges of an area by horizontal band."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from geolayer.functions.pair_tests import _near

#: Edges a band should hold.
PER_BAND = 4
#: Points and edges tested in one go.
STEP = 1 << 20


class Rings:
    """Edges of the areas of a table with the coordinates of their rings (``xs, ys``)."""

    def __init__(self, areas: pa.Table) -> None:
        xs, ys = (areas.column(c).combine_chunks() for c in ("xs", "ys"))
        n_parts = xs.value_lengths().to_numpy(zero_copy_only=False)
        n = xs.flatten().value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        self.x, self.y = (v.flatten().flatten().to_numpy(zero_copy_only=False) for v in (xs, ys))
        #: The last position of a ring starts no edge.
        self.last = np.zeros(len(self.x), bool)
        self.last[np.cumsum(n)[n > 0] - 1] = True
        ends = np.concatenate(([0], np.cumsum(n)))[np.cumsum(n_parts)]
        self.start, self.stop = np.concatenate(([0], ends[:-1])), ends

    def _edges(self, area: int) -> tuple[np.ndarray, ...]:
        s, e = self.start[area], self.stop[area]
        x, y, here = self.x[s:e], self.y[s:e], ~self.last[s:e][:-1]
        x1, y1, x2, y2 = x[:-1][here], y[:-1][here], x[1:][here], y[1:][here]
        long = (x1 != x2) | (y1 != y2)
        return x1[long], y1[long], x2[long], y2[long]

    def hold(self, area: int, x: np.ndarray, y: np.ndarray, tol: float, meet: bool) -> np.ndarray:
        """Which positions lie in the interior of an area or, with ``meet``, on its boundary (``relate.locate``)."""
        x1, y1, x2, y2 = self._edges(area)
        n = len(x1)
        if not n:
            return np.zeros(len(x), bool)
        low, high = np.minimum(y1, y2) - 2 * tol, np.maximum(y1, y2) + 2 * tol
        base = low.min()
        # No lower than that the listed edges stay a few for each edge.
        height = max((high.max() - base) * PER_BAND / n, (high - low).sum() / (PER_BAND * n))
        first, last = (np.floor((v - base) / height).astype(np.int64) for v in (low, high))
        times = last - first + 1
        edge = np.repeat(np.arange(n), times)
        band = np.arange(len(edge)) - np.repeat(np.cumsum(times) - times - first, times)
        edge = edge[np.argsort(band, kind="stable")]
        bands = int(last.max()) + 1
        start = np.concatenate(([0], np.cumsum(np.bincount(band, minlength=bands))))
        at = np.floor((y - base) / height).astype(np.int64)
        known = (at >= 0) & (at < bands)
        at = np.where(known, at, 0)
        met = np.where(known, start[at + 1] - start[at], 0)
        total = np.cumsum(met)
        odd, on = np.zeros(len(x), bool), np.zeros(len(x), bool)
        s = 0
        while s < len(x):
            before = total[s - 1] if s else 0
            e = max(int(np.searchsorted(total, before + STEP, "right")), s + 1)
            m = met[s:e]
            p = np.repeat(np.arange(s, e), m)
            j = edge[np.arange(len(p)) + np.repeat(start[at[s:e]] - (np.cumsum(m) - m), m)]
            qx, qy, ax, ay, bx, by = x[p], y[p], x1[j], y1[j], x2[j], y2[j]
            turn = (bx - ax) * (qy - ay) - (qx - ax) * (by - ay)
            right = ((ay > qy) != (by > qy)) & ((turn > 0) == (by > ay))
            odd[s:e] = np.bincount(p[right] - s, minlength=e - s) % 2 == 1
            on[p[_near(qx, qy, (ax, ay, bx, by), tol)]] = True
            s = e
        return odd | on if meet else odd & ~on
