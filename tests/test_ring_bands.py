"""Edges by band against all edges of an area."""

import numpy as np
import pyarrow as pa

from geolayer.functions.pair_tests import Shapes, locate
from geolayer.functions.ring_bands import Rings


def test_bands_find_what_all_edges_find():
    rng = np.random.default_rng(7)
    turn = np.linspace(0, 2 * np.pi, 301)
    far = 1 + rng.integers(0, 5, 301) / 8
    outer = np.round(np.column_stack([far * np.cos(turn), far * np.sin(turn)]) * 16) / 16
    outer[-1] = outer[0]
    hole = np.array([(-.5, -.5), (.5, -.5), (.5, .5), (.5, .5), (-.5, .5), (-.5, -.5)])
    square = [np.array([(3, 0), (4, 0), (4, 1), (3, 1), (3, 0)], float)]
    areas = [square, [outer, hole], square]
    table = pa.table({c: pa.array([[r[:, k].tolist() for r in rings] for rings in areas]) for k, c in enumerate(("xs", "ys"))})
    segs = [[dict(x1=a[0], y1=a[1], x2=b[0], y2=b[1]) for r in rings for a, b in zip(r, r[1:]) if tuple(a) != tuple(b)]
            for rings in areas]
    none = pa.array([[]] * 3, pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))
    shapes = Shapes(pa.StructArray.from_arrays(
        [pa.array([2, 2, 2]), none, pa.array(segs), none], names=["dim", "verts", "segs", "ends"]))
    spots = np.concatenate([np.round(rng.uniform(-2, 5, (3000, 2)) * 16) / 16, outer, hole])
    x, y = spots[:, 0].copy(), spots[:, 1].copy()
    for area in range(3):
        place = locate(x, y, shapes, np.full(len(x), area), 1e-9)
        rings = Rings(table)
        assert (rings.hold(area, x, y, 1e-9, True) == (place != 2)).all()
        assert (rings.hold(area, x, y, 1e-9, False) == (place == 0)).all()
        assert len(set(place)) == 3
