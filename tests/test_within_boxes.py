"""Areas in rectangles: sides are compared as they are."""

from geolayer.layer import LayerInfo
from geolayer.functions import geometry as g
from geolayer.operators import select as sel

WEST, EAST = -125.0005, -113.40050000000001


def test_an_area_beyond_a_box_by_a_rounding_is_not_in_it(spark):
    shapes = [("beyond", (-115.9005, 26.7535, -113.4005, 29.2535)), ("even", (-115.9005, 26.7535, EAST, 29.2535)),
              ("inside", (-115.9, 26.7, -113.5, 29.2))]
    layer = spark.createDataFrame(
        [(name, g.as_geometry(box)) for name, box in shapes], f"id string, geom {g.GEOMETRY}")
    found = sel.ids_by_geom(
        layer, LayerInfo("id", kind="polygon"), (WEST, 25.0005, EAST, 29.8005), relation="esriSpatialRelContains")
    assert sorted(r.feature_id for r in found.collect()) == ["even", "inside"]
