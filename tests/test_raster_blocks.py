"""Points counted where the points of a box come together, against the shuffled count."""

import pytest

from geolayer.operators import tiles as tl
from geolayer.plans import block_join
from workloads import layers as ly
from workloads.coordinates import plots


@pytest.mark.parametrize("most", [block_join.BLOCK_POINTS, 3])
def test_pixels_counted_in_blocks(spark, monkeypatch, most):
    sf = "/root/testdata/sf0.01"
    monkeypatch.setattr(block_join, "BLOCK_POINTS", most)
    monkeypatch.setattr(block_join, "BLOCK_BOXES", 4)
    points, boxes = ly.sites(spark, sf), plots(spark, sf)
    placed = tl.points_to_tiles(points, ly.SITES, boxes, 20_000.0, 100, values=("acctbal",))
    want = tl.rasterize(placed, "acctbal")
    got = tl.rasterize_points(points, ly.SITES, boxes, 20_000.0, 100, "acctbal")

    # Counted twice only where boxes are summed up from several blocks.
    text = got._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("FlatMapGroupsInArrow") == (2 if most == 3 else 1)

    def rows(df):
        return sorted((r.box_id, r.tile_no, r.px, r.py, r.n, round(r["mean"], 6)) for r in df.collect())

    assert rows(got) == rows(want) and max(r[4] for r in rows(got)) > 1
