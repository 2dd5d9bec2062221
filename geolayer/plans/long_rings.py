"""Points against areas with long rings, segment by segment.

An area is cut into its segments, flat rows of four numbers. A segment is listed in the horizontal bands
of its area it reaches, at a band height that fits it, so in two bands at most; heights double from level to
level, the lowest holds about ``PER_BAND`` segments a band. A point meets, at each level its area uses, the
segments of one band. Those to its right are counted, an odd number is inside, and one that it lies on
is noted: the rules of ``relate.locate``, summed over rows. No row holds a ring, and a point near a
ring of n short segments meets some ``PER_BAND`` of them and not n.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geolayer.functions import geometry as g
from geolayer.functions import relate
from geolayer.functions.ring_bands import Rings
from geolayer.functions.sql import num
from geolayer.plans.block_join import points_by_box
from geolayer.plans.bounded import MAX_BROADCAST_ROWS, small_rows
from geolayer.plans.spatial_join import candidate_pairs, split_hot
from geolayer.session import written

#: Areas with more vertices are cut into segments; the rows found are the same either way.
LONG_RING = 2000
#: Areas up to here are sent whole (``spots_in_rings``).
WHOLE_RING = 50_000
#: Vertices of the areas of a block.
BLOCK_RING_VERTICES = 4_000_000
PER_BAND = 64
MAX_LEVEL = 24
#: A band no segment is in: one row for each area, which counts how often a point comes.
COMING = -1


def _segments(areas: DataFrame) -> DataFrame:
    """Segments of ``(query_id, geom)``, with a number for the area they are from.

    Written, since the numbers must stay as they are when a task runs again.
    """
    # Numbered before the segments are taken apart, so that those of an area share its number.
    rows = areas.select("*", F.monotonically_increasing_id().alias("_area")).select(
        "_area", "query_id", F.explode(F.expr(relate.segments("geom.parts"))).alias("s"))
    return written(rows.select("_area", "query_id", "s.*"), "segments")


def _frames(segments: DataFrame, tol: float) -> DataFrame:
    """One row per area: id, envelope, lowest band height and levels in use."""
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    frames = segments.groupBy("_area").agg(
        F.first("query_id").alias("id"), F.count(F.lit(1)).alias("_n"),
        F.min(F.least("x1", "x2")).alias("xmin"), F.min(low).alias("ymin"),
        F.max(F.greatest("x1", "x2")).alias("xmax"), F.max(high).alias("ymax"))
    bands = F.greatest(F.lit(1.0), F.col("_n") / PER_BAND)
    return frames.withColumn(
        "_high", F.greatest((F.col("ymax") - F.col("ymin")) / bands, F.lit(16 * tol))).drop("_n")


def _banded(segments: DataFrame, frames: DataFrame, tol: float) -> DataFrame:
    """Segments by level and band of their area (``_lv, _cx, _cy``)."""
    pad = num(2 * tol)
    tall = f"(abs(y2 - y1) + 2 * {pad})"
    at = segments.join(frames.select("_area", "_high", F.col("ymin").alias("_y0")), "_area")
    level = f"least(greatest(int(ceil(log2({tall} / _high))), 0), {MAX_LEVEL})"
    side = "(_high * pow(2.0D, _lv))"
    return at.selectExpr("*", f"{level} AS _lv").selectExpr(
        "_area AS _cy", "_lv", "x1", "y1", "x2", "y2",
        f"explode(sequence(floor((least(y1, y2) - {pad} - _y0) / {side}), "
        f"floor((greatest(y1, y2) + {pad} - _y0) / {side}))) AS _cx")


def spots_in_areas(
    points: DataFrame, areas: DataFrame, spots: str, tol: float, cell: float, finest: int
) -> DataFrame:
    """Pairs ``(l_id, r_id)``, with the ``l_c_`` columns of the points, that ``meet`` or are ``inside``.

    ``points`` has ``id``, the four envelope columns, ``_salt`` and any ``c_`` columns; ``areas`` has ``query_id,
    geom``. Repeated points and areas give repeated pairs. Segments are broadcast if they are few and
    joined by shuffle otherwise, with bands that many points or segments share cut into blocks.
    """
    segments = _segments(areas)
    frames = written(_frames(segments, tol), "frames")
    banded = written(_banded(segments, frames, tol), "banded")
    levels = banded.groupBy("_cy").agg(F.collect_set("_lv").alias("_levels"))
    boxes = frames.join(levels.withColumnRenamed("_cy", "_area"), "_area").select(
        "id", "_area", "_high", F.col("ymin").alias("_y0"), "_levels", F.lit(1).alias("_nv"),
        F.xxhash64("_area").alias("_salt"),
        *[(F.col(b) + (2 * tol if b.endswith("max") else -2 * tol)).alias(b) for b in g.BBOX])
    near = candidate_pairs(points, boxes, cell, None, True, finest)
    carried = [c for c in near.columns if c.startswith("l_c_")]
    asked = near.selectExpr(
        "l_id", "r_id", "l_xmin AS x", "l_ymin AS y", *[f"`{c}`" for c in carried], "r__area AS _cy",
        "r__y0", "r__high", f"explode(concat(r__levels, array({COMING}))) AS _lv",
    ).withColumn("_cx", F.expr(
        f"IF(_lv = {COMING}, 0L, floor((y - r__y0) / (r__high * pow(2.0D, _lv))))")).drop(
        "r__y0", "r__high")
    nothing = F.lit(None).cast("double")
    coming = frames.select(
        F.col("_area").alias("_cy"), F.lit(COMING).alias("_lv"),
        *[nothing.alias(c) for c in ("x1", "y1", "x2", "y2")], F.lit(0).cast("bigint").alias("_cx"))
    listed = banded.unionByName(coming)
    on = ["_lv", "_cx", "_cy"]
    if small_rows(listed, MAX_BROADCAST_ROWS):
        listed = F.broadcast(listed)
    else:
        asked, listed = split_hot(asked, listed, ("l_id", "x", "y"), ("x1", "y1", "x2", "y2"))
        on += ["_block_l", "_block_r"]
    met = asked.join(listed.alias("s"), on)
    keys = ["_cy", "r_id", "l_id", "x", "y", *carried]
    counted = met.groupBy(*keys).agg(
        F.sum(F.expr(f"IF({relate.right_of('x', 'y', 's')}, 1L, 0L)")).alias("_right"),
        F.max(F.expr(f"IF({relate.near_segment('x', 'y', 's', tol)}, 1, 0)")).alias("_on"),
        F.sum(F.expr(f"IF(_lv = {COMING}, 1L, 0L)")).alias("_times"))
    odd = "(_right div _times) % 2 = 1"
    return counted.where(f"{odd} OR _on = 1" if spots == "meet" else f"{odd} AND _on = 0").selectExpr(
        "l_id", "r_id", *[f"`{c}`" for c in carried], "explode(sequence(1L, _times)) AS _time").drop("_time")


def spots_in_rings(
    points: DataFrame, areas: DataFrame, spots: str, tol: float, cell: float, finest: int
) -> DataFrame:
    """``spots_in_areas`` for areas that are sent whole, once each, to the block their points come to.

    Within a block the edges of an area are listed by horizontal band, and a point meets those of its band.
    """
    carried = [c for c in points.columns if c.startswith("c_")]
    left = points.select(F.col("id").alias("l_id"), *carried, *g.BBOX, "_salt", F.lit(1).alias("_nv"))
    framed = areas.select("query_id", "geom", F.expr(g.envelope("geom")).alias("_e"))
    box = [(F.col(f"_e.{b}") + (2 * tol if b.endswith("max") else -2 * tol)).alias(b) for b in g.BBOX]
    n = F.expr(g.n_vertices("geom")).alias("_nv")
    right = framed.select(
        F.col("query_id").alias("r_id"), F.expr("transform(geom.parts, p -> p.x)").alias("xs"),
        F.expr("transform(geom.parts, p -> p.y)").alias("ys"), n, F.xxhash64("query_id").alias("_salt"), *box)
    # The rings themselves are read once more only, to be sent.
    sizes = written(framed.select(n, *box), "ring-sizes")
    schema = T.StructType([
        T.StructField("l_id", left.schema["l_id"].dataType), T.StructField("r_id", right.schema["r_id"].dataType),
        *[T.StructField(f"l_{c}", left.schema[c].dataType) for c in carried]])

    def work(spot: pa.Table, area: pa.Table, pairs: Iterator) -> Iterator[list[pa.Array]]:
        x, y = (spot.column(b).to_numpy() for b in ("xmin", "ymin"))
        ids, queries = (t.column(c).combine_chunks() for t, c in ((spot, "l_id"), (area, "r_id")))
        rings = Rings(area)
        for li, box in pairs:
            new = np.flatnonzero(np.diff(box, prepend=-1))
            hold = np.concatenate([
                rings.hold(int(box[s]), x[li[s:e]], y[li[s:e]], tol, spots == "meet")
                for s, e in zip(new, np.append(new[1:], len(box)))])
            at = pa.array(li[hold])
            yield [ids.take(at), queries.take(pa.array(box[hold])),
                   *[spot.column(c).combine_chunks().take(at) for c in carried]]

    return points_by_box(left, right, cell, finest, work, schema, BLOCK_RING_VERTICES, sizes)[0].drop("_split")
