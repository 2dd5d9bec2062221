"""Pairs of two geometry tables found block by block.

Both sides are listed by grid cell (``spatial_join``) and shuffled by it, at a grid coarse enough that a cell is worth a
call. A cell with too many rows or vertices is split into blocks of both sides. Within a block, envelopes are
swept along x and the pairs that meet are tested together (``functions.pair_tests``), so a geometry is sent once for a
cell and not once for a pair, and only results leave the block: a query with the list of its features, which Spark
explodes. Queries with a crowd of features in reach are tested one by one against all of them, the others
together. Pairs that need the exact test come back with their shapes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geolayer.functions.geometry import BBOX
from geolayer.functions.pair_tests import LATER, NO, YES, Shapes
from geolayer.plans.bounded import measure
from geolayer.plans.spatial_join import (
    COARSEST, FINEST, LEVEL_RATIO, _at, _size, chosen_levels, crowding, hot_cells, level_of, split_hot, with_cells,
)
from geolayer.session import ship_packages

#: Features a cell should hold, so that the call for it is worth its while.
CELL_ROWS = 250
#: Cells a small table is still dealt to.
LEAST_CELLS = 64
#: Vertices of one side of a block.
BLOCK_VERTICES = 1_000_000
#: Points and boxes of a block, where all points of a box are wanted together.
BLOCK_POINTS = 1_000_000
BLOCK_BOXES = 4_000
#: Envelope pairs looked at in one go.
STEP = 1 << 17
#: A query with more features in reach is tested on its own.
CROWD = 256
#: Pairs of a batch of results.
RESULT_PAIRS = 1 << 18
#: A candidate within a block costs this part of a shuffled row.
CANDIDATE_COST = 0.02
KEY = ("_lv", "_cx", "_cy", "_block_l", "_block_r")

Judge = Callable[[Shapes, np.ndarray, Shapes, np.ndarray], np.ndarray]
JudgeOne = Callable[[Shapes, np.ndarray, Shapes, int], np.ndarray]


def _grid(left: DataFrame, cell: float, finest: int) -> tuple[dict[int, float], int]:
    """Crowding of the features, and the finest level with enough of them in a cell."""
    crowd = crowding(left, cell, finest)
    if not crowd:
        return crowd, finest
    enough = min(CELL_ROWS, max(crowd.values()) / LEAST_CELLS)
    return crowd, min((k for k, n in crowd.items() if n >= enough), default=COARSEST)


def block_pairs(
    left: DataFrame, right: DataFrame, cell: float, judge: Judge, judge_one: JudgeOne, exact: str,
    carry: tuple[str, ...] = (), finest: int = FINEST,
) -> DataFrame:
    """``l_id, r_id`` and carried ``l_c_`` columns of the pairs whose envelopes meet and that ``judge``, or
    ``judge_one`` for a single query, says to hold; ``exact`` tests ``l_prep`` and ``r_prep`` where it can not tell.

    Both tables have ``id``, envelope, ``prep``, ``_nv`` and ``_salt``, the left one also ``c_`` columns to carry.
    """
    spark = left.sparkSession
    ship_packages(spark)
    crowd, finest = _grid(left, cell, finest)
    own = level_of(cell, finest)
    left_size, right_size = measure(left, "_nv", own), measure(right, "_nv", own)
    chosen = chosen_levels(left_size, right_size, crowd, CANDIDATE_COST)
    cells_l = with_cells(left, cell, _at(right_size, chosen), finest, chosen)
    cells_r = with_cells(right, cell, _at(left_size, chosen), finest, chosen)
    cells_l, cells_r = split_hot(cells_l, cells_r, vertices=BLOCK_VERTICES)
    shared = [*KEY, "_own", *BBOX, "prep"]
    carried = [f"c_{c}" for c in carry]
    listed = cells_l.select(*shared, F.col("id").alias("l_id"), *carried, F.lit(True).alias("_left")).unionByName(
        cells_r.select(*shared, F.col("id").alias("r_id"), F.lit(False).alias("_left")), allowMissingColumns=True)
    # A number of its own, since what a task has to do does not follow from its bytes.
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 8 * spark.sparkContext.defaultParallelism)
    types = listed.schema
    schema = T.StructType([
        T.StructField("l_id", T.ArrayType(types["l_id"].dataType)), T.StructField("r_id", types["r_id"].dataType),
        *[T.StructField(f"l_{c}", T.ArrayType(types[c].dataType)) for c in carried],
        T.StructField("_sure", T.BooleanType()),
        T.StructField("l_prep", types["prep"].dataType), T.StructField("r_prep", types["prep"].dataType)])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)).combine_chunks()
        yield from _block(table, cell, judge, judge_one, carried)

    found = listed.repartition(tasks, *KEY).groupBy(*KEY).applyInArrow(find, schema).where(
        f"CASE WHEN _sure THEN true ELSE {exact} END")
    if not carried:
        return found.selectExpr("r_id", "explode(l_id) AS l_id")
    return found.selectExpr("r_id", f"inline(arrays_zip({', '.join(['l_id', *[f'`l_{c}`' for c in carried]])}))")


def _column(table: pa.Table, name: str) -> pa.Array:
    column = table.column(name)
    return column.chunk(0) if column.num_chunks == 1 else pa.concat_arrays(column.chunks)


def _sides(table: pa.Table) -> tuple[pa.Table, pa.Table]:
    """Features, sorted by their west sides, and queries of a block."""
    side = _column(table, "_left")
    left, right = table.filter(side), table.filter(pc.invert(side))
    if left.num_rows:
        left = left.take(pa.array(np.argsort(_column(left, "xmin").to_numpy(), kind="stable")))
    return left, right


def _in_reach(l_env: list[np.ndarray], r_env: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """For each query the first of the features that may meet it by their sides along x, and the one after the last."""
    widest = (l_env[2] - l_env[0]).max()
    first = np.searchsorted(l_env[0], r_env[0] - widest * (1 + 1e-9) - (1e-9 if widest else 0.0), "left")
    return first, np.maximum(np.searchsorted(l_env[0], r_env[2], "right"), first)


def _meeting(
    l_env: list[np.ndarray], r_env: list[np.ndarray], queries: np.ndarray | None = None,
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the features and queries whose envelopes meet, all of a query together; features are sorted by
    their west sides. ``queries`` are the places of those to look at, all if not given."""
    first, last = _in_reach(l_env, r_env)
    queries = np.arange(len(first)) if queries is None else queries
    ends = np.cumsum((last - first)[queries])
    start = 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        stop = max(int(np.searchsorted(ends, before + STEP, "right")), start + 1)
        rows = queries[start:stop]
        n = last[rows] - first[rows]
        r = np.repeat(rows, n)
        li = np.arange(len(r)) + np.repeat(first[rows] - (np.cumsum(n) - n), n)
        start = stop
        met = (l_env[1][li] <= r_env[3][r]) & (l_env[3][li] >= r_env[1][r]) & (l_env[2][li] >= r_env[0][r])
        if met.any():
            yield li[met], r[met]


def _block(
    table: pa.Table, cell: float, judge: Judge, judge_one: JudgeOne, carried: list[str],
) -> Iterator[pa.RecordBatch]:
    """The pairs of one block."""
    left, right = _sides(table)
    if not left.num_rows or not right.num_rows:
        return
    lv, cx, cy = (table.column(c)[0].as_py() for c in KEY[:3])
    size = cell * LEVEL_RATIO ** lv
    l_env, r_env = ([_column(t, b).to_numpy() for b in BBOX] for t in (left, right))
    # What is left of the cell, below it or finer in both has met in another one. Nothing is right of it or above.
    l_home, r_home = ([np.floor(env[0] / size) == cx, np.floor(env[1] / size) == cy, _column(t, "_own").to_numpy() == lv]
                      for t, env in ((left, l_env), (right, r_env)))
    l_prep, r_prep = _column(left, "prep"), _column(right, "prep")
    a, b = Shapes(l_prep), Shapes(r_prep)
    l_ids, r_ids = _column(left, "l_id"), _column(right, "r_id")
    extra = [_column(left, c) for c in carried]
    names = ["l_id", "r_id", *[f"l_{c}" for c in carried], "_sure", "l_prep", "r_prep"]

    def rows(li: np.ndarray, r: np.ndarray, sure: bool) -> pa.RecordBatch:
        """A row for each run of a query, or for each pair that is not sure."""
        i = pa.array(li)
        start = np.flatnonzero(np.diff(r, prepend=-1)) if sure else np.arange(len(r))
        j, ends = pa.array(r[start]), pa.array(np.append(start, len(r)).astype(np.int32))
        shapes = ([pa.nulls(len(start), p.type) for p in (l_prep, r_prep)] if sure
                  else [l_prep.take(i), r_prep.take(j)])
        lists = [pa.ListArray.from_arrays(ends, c.take(i)) for c in (l_ids, *extra)]
        return pa.RecordBatch.from_arrays(
            [lists[0], r_ids.take(j), *lists[1:], pa.array(np.full(len(start), sure)), *shapes], names=names)

    def results(found: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for li, r, says in found:
            yes, unsure = says == YES, (says != YES) & (says != NO)
            if unsure.any():
                yield rows(li[unsure], r[unsure], False)
            if yes.any():
                held.append((li[yes], r[yes]))
                n += len(held[-1][0])
            if n > RESULT_PAIRS:
                yield rows(*map(np.concatenate, zip(*held)), True)
                held, n = [], 0
        if held:
            yield rows(*map(np.concatenate, zip(*held)), True)

    first, last = _in_reach(l_env, r_env)
    crowded = last - first > CROWD

    def together() -> Iterator:
        for li, r in _meeting(l_env, r_env, np.flatnonzero(~crowded)):
            here = np.ones(len(li), bool)
            for mine, theirs in zip(l_home, r_home):
                here &= mine[li] | theirs[r]
            li, r = li[here], r[here]
            if len(li):
                yield li, r, judge(a, li, b, r)

    def one_by_one() -> Iterator:
        left_over, n = [], 0
        for q in np.flatnonzero(crowded).tolist():
            at = slice(first[q], last[q])
            west, south, _, north = (v[q] for v in r_env)
            met = (l_env[1][at] <= north) & (l_env[3][at] >= south) & (l_env[2][at] >= west)
            for mine, theirs in zip(l_home, r_home):
                if not theirs[q]:
                    met &= mine[at]
            li = np.flatnonzero(met) + first[q]
            if not len(li):
                continue
            says = judge_one(a, li, b, q)
            later = np.flatnonzero(says == LATER)
            if len(later):
                left_over.append((li[later], np.full(len(later), q)))
                n += len(later)
                says[later] = NO
            yield li, np.full(len(li), q), says
            if n > STEP:
                yield judged(left_over)
                left_over, n = [], 0
        if left_over:
            yield judged(left_over)

    def judged(some: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        li, r = map(np.concatenate, zip(*some))
        return li, r, judge(a, li, b, r)

    yield from results(together())
    yield from results(one_by_one())


def points_by_box(
    points: DataFrame, boxes: DataFrame, cell: float, finest: int, work: Callable, schema: T.StructType,
    vertices: int | None = None, sizes: DataFrame | None = None,
) -> tuple[DataFrame, bool]:
    """What ``work`` makes of the points of each box, with ``_split`` where a box had them in several blocks, and
    whether there is such a box.

    A box is listed in the cell of its lower left corner only, at a level that is larger than it, and a point in that cell
    and the ones left of and below it. So all points of a box come together, unless a cell holds more than
    ``BLOCK_POINTS``. ``work(points, boxes, pairs)`` gets the two sides of a block and the pairs that meet, all of a
    box at once, and yields arrays of ``schema``. ``vertices`` (``_nv``) bound the blocks as well, if given.
    ``sizes`` are the boxes without what is wide in them, to be counted in their place.
    """
    seen = "xmin + ymin + xmax + ymax IS NOT NULL AND NOT isnan(xmin + ymin + xmax + ymax)"
    sizes = boxes if sizes is None else sizes
    points, boxes, sizes = points.where(seen), boxes.where(seen), sizes.where(seen)
    spark = points.sparkSession
    ship_packages(spark)
    crowd, finest = _grid(points, cell, finest)
    own = level_of(cell, finest, "(greatest(xmax - xmin, ymax - ymin) * 1.000001D)")
    left_size, right_size = measure(points, "1", str(finest)), measure(sizes, "1", own)
    chosen = chosen_levels(left_size, right_size, crowd, CANDIDATE_COST)
    at = _at(right_size, chosen)
    levels = ", ".join(map(str, at)) or "NULL"
    size = _size("_lv", cell)
    placed = ["*", f"floor(xmin / {size}) AS _cx", f"floor(ymin / {size}) AS _cy"]
    cells_l = points.selectExpr("*", f"explode(CAST(array({levels}) AS array<int>)) AS _lv").selectExpr(*placed)
    for c in ("_cx", "_cy"):
        cells_l = cells_l.withColumn(c, F.explode(F.array(F.col(c), F.col(c) - 1)))
    own_cell = f"element_at(filter(CAST(array({levels}) AS array<int>), k -> k >= {own}), 1) AS _lv"
    cells_r, counted = (df.selectExpr("*", own_cell).selectExpr(*placed) for df in (boxes, sizes))
    blocks = hot_cells(cells_l, counted, vertices, (BLOCK_POINTS, BLOCK_BOXES))
    any_split = not counted.join(blocks, list(KEY[:3])).where("_nl > 1").isEmpty()
    cells_l, cells_r = split_hot(cells_l, cells_r, told=True, blocks=blocks)
    listed = cells_l.drop("_salt").withColumn("_left", F.lit(True)).unionByName(
        cells_r.drop("_salt").withColumn("_left", F.lit(False)), allowMissingColumns=True)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 8 * spark.sparkContext.defaultParallelism)
    names = [*schema.names, "_split"]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = _sides(pa.Table.from_batches(list(batches)).combine_chunks())
        if not left.num_rows or not right.num_rows:
            return
        split = _column(right, "_split")[0].as_py()
        met = _meeting(*([_column(t, b).to_numpy() for b in BBOX] for t in (left, right)))
        for arrays in work(left, right, met):
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(np.full(len(arrays[0]), split))], names=names)

    return listed.repartition(tasks, *KEY).groupBy(*KEY).applyInArrow(
        find, T.StructType([*schema, T.StructField("_split", T.BooleanType())])), any_split
