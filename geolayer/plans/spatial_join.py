"""Candidate pairs of two geometry tables by an equi-join on grid cells.

Each geometry gets a grid level by its size, finer or coarser than the given cell, so that its
envelope covers at most two cells a side there. A pair meets at the coarser of its two levels: a
geometry is listed at the levels of the other table from its own one up, never at finer ones. So the
features a query meets are those in a few cells of its own size, however dense they lie. A pair that
shares several cells is kept only in the cell with the lower-left corner of the envelopes' overlap,
so no distinct is needed.

A query table measured to be small, with all its cell entries, is broadcast. Otherwise both sides
are shuffled by cell, and each level costs another copy of the features. Then the crowding of the
features is measured (how many share a cell, level by level), and levels are joined with coarser ones
as long as the copies saved outweigh the further candidates: sparse tables use few levels, dense ones
all. Cells with more entries than a block are split: a row of one side goes to one of its side's blocks and
to all blocks of the other side, so no task holds a hot cell whole, whatever the size of the tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geolayer.functions.geometry import BBOX
from geolayer.functions.sql import num
from geolayer.plans.bounded import Size, measure, small_rows, spread_small
from geolayer.session import written

#: Levels around the given cell, level 0: each has twice the side of the one below.
FINEST, COARSEST = -20, 24
LEVEL_RATIO = 2.0
#: Entries of one cell and side that meet in one task.
BLOCK_ROWS = 20_000
#: A longer list of split cells is joined by shuffle.
MAX_SENT_CELLS = 200_000
#: Counters for each level when crowding is measured.
COUNTERS = 4096
CROWD_STEP = 2


def level_of(
    cell: float, finest: int = FINEST, side: str = "greatest(xmax - xmin, ymax - ymin)"
) -> str:
    """Grid level by the longer side of the envelope."""
    least = num(cell * LEVEL_RATIO ** finest)
    up = f"int(ceil(log({num(LEVEL_RATIO)}, {side} / {num(cell)})))"
    return f"IF({side} <= {least}, {finest}, least(greatest({up}, {finest}), {COARSEST}))"


def _size(level: str, cell: float) -> str:
    return f"({num(cell)} * pow({num(LEVEL_RATIO)}, {level}))"


def _levels(levels: tuple[int, ...]) -> str:
    return "CAST(array(" + ", ".join(map(str, sorted(levels))) + ") AS array<int>)"


def with_cells(
    df: DataFrame, cell: float, levels: tuple[int, ...], finest: int = FINEST,
    chosen: tuple[int, ...] | None = None,
) -> DataFrame:
    """One row per grid cell a geometry is listed in (``_lv, _cx, _cy``).

    ``levels`` are those of the other table. With ``chosen`` a geometry takes the first of these levels
    that is not below its own. A null or NaN envelope is in no cell.
    """
    others, size = _levels(levels), _size("_lv", cell)
    own = level_of(cell, finest)
    if chosen:
        own = f"element_at(filter({_levels(chosen)}, k -> k >= {own}), 1)"

    def span(low: str, high: str) -> str:
        cells = f"sequence(floor({low} / {size}), floor({high} / {size}))"
        return f"explode(IF(isnan({low} + {high}), NULL, {cells}))"

    # Its own level is only met by what is smaller.
    up = f"filter({others}, k -> k >= _own)"
    listed = f"IF(array_min({others}) < _own, array_union({up}, array(_own)), {up})"
    return (
        df.selectExpr("*", f"{own} AS _own")
        .selectExpr("*", f"explode({listed}) AS _lv")
        .selectExpr("*", f"{span('xmin', 'xmax')} AS _cx")
        .selectExpr("*", f"{span('ymin', 'ymax')} AS _cy")
    )


def crowding(df: DataFrame, cell: float, finest: int = FINEST) -> dict[int, float]:
    """For every second level, how many rows lie in the cell of a row, on average.

    That is the second moment of the counts by cell over the number of rows. Cells are dealt
    to a fixed number of counters for each level, and what the counters mix is taken off again, so
    the pass needs the same memory for any table and yields one number a level.
    """
    size = _size("_k", cell)
    placed = df.selectExpr(
        "xmin", "ymin", f"explode(sequence({finest}, {COARSEST}, {CROWD_STEP})) AS _k").selectExpr(
        "_k", f"pmod(xxhash64(_k, floor(xmin / {size}), floor(ymin / {size})), {COUNTERS}) AS _b")
    rows = placed.groupBy("_k", "_b").agg(F.count(F.lit(1)).cast("double").alias("n")).groupBy(
        "_k").agg(F.sum(F.col("n") * F.col("n")).alias("n2"), F.sum("n").alias("n")).collect()
    share = 1 / COUNTERS
    return {r["_k"]: max((r["n2"] - r["n"] ** 2 * share) / (1 - share) / r["n"], 1.0) for r in rows}


def chosen_levels(
    left: Size, right: Size, crowd: dict[int, float], candidate: float = 1.0
) -> tuple[int, ...]:
    """The levels to use, of those the tables have: fewest entries and candidates together.

    Rows whose level is not chosen go up to the next one that is. A candidate costs ``candidate``
    entries; a geometry meets what lies in about four cells.
    """
    levels = sorted({*left.levels, *right.levels})
    if not levels or not left.rows:
        return tuple(levels)

    def upto(size: Size, level: int) -> int:
        return sum(n for k, n in zip(size.levels, size.counts) if k <= level)

    def crowd_at(level: int) -> float:
        return crowd.get(level) or crowd.get(level + 1) or max(crowd.values())

    left_n, right_n = dict(zip(left.levels, left.counts)), dict(zip(right.levels, right.counts))
    meets = [(right_n.get(k, 0) * upto(left, k) + left_n.get(k, 0) * upto(right, k)) / left.rows
             for k in levels]
    best: list[tuple[float, tuple[int, ...]]] = [(0.0, ())]
    for j, level in enumerate(levels):
        best.append(min(
            (best[i][0] + left.rows + right.rows + 4 * candidate * crowd_at(level) * sum(meets[i:j + 1]),
             (*best[i][1], level)) for i in range(j + 1)))
    return best[-1][1]


def _at(size: Size, chosen: tuple[int, ...]) -> tuple[int, ...]:
    """The chosen levels that the rows of a table go to."""
    return tuple(sorted({min(c for c in chosen if c >= k) for k in size.levels}))


def _side(df: DataFrame, prefix: str) -> DataFrame:
    keep = ("_lv", "_cx", "_cy", "_block_l", "_block_r")
    return df.toDF(*[c if c in keep else prefix + c for c in df.columns])


def hot_cells(
    left: DataFrame, right: DataFrame, vertices: int | None = None, rows: tuple[int, int] | None = None,
) -> DataFrame:
    """The cells with more than ``BLOCK_ROWS`` entries of a side, or ``vertices`` (``_nv``) if given, and the number of
    blocks of each side (``_nl, _nr``).

    The list of these cells is sent if it is short, and joined by shuffle if not. ``rows`` are other bounds for
    the two sides.
    """
    key = ["_lv", "_cx", "_cy"]
    most = rows or (BLOCK_ROWS, BLOCK_ROWS)

    def hot(df: DataFrame, name: str, bound: int) -> DataFrame:
        blocks = F.ceil(F.count(F.lit(1)) / F.lit(bound))
        if vertices:
            blocks = F.greatest(blocks, F.ceil(F.sum("_nv") / F.lit(vertices)))
        return df.groupBy(*key).agg(blocks.cast("int").alias(name)).where(F.col(name) > 1)

    # Written, so that both sides are counted once and not once for each use of the list.
    blocks = written(
        hot(left, "_nl", most[0]).join(hot(right, "_nr", most[1]), key, "full"), "hot-cells")
    return F.broadcast(blocks) if small_rows(blocks, MAX_SENT_CELLS) else blocks


def split_hot(
    left: DataFrame, right: DataFrame, by: tuple[str, ...] = (*BBOX, "_salt"),
    by_right: tuple[str, ...] | None = None, vertices: int | None = None, told: bool = False,
    blocks: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Blocks for the cells with many entries of a side (``hot_cells``, if not given as ``blocks``).

    The bound does not move with the tables, so two blocks never make more pairs than its square. ``by`` names the
    columns that deal the rows of a side to its blocks. With ``told`` a row says
    whether the other side of its cell is in several blocks (``_split``).
    """
    key = ["_lv", "_cx", "_cy"]
    blocks = hot_cells(left, right, vertices) if blocks is None else blocks

    def assign(
        df: DataFrame, mine: str, n_mine: str, other: str, n_other: str, by: tuple[str, ...]
    ) -> DataFrame:
        n1, n2 = F.coalesce(F.col(n_mine), F.lit(1)), F.coalesce(F.col(n_other), F.lit(1))
        spread = F.pmod(F.xxhash64(*[F.col(b) for b in by]), n1).cast("int")
        dealt = df.join(blocks, key, "left")
        if told:
            dealt = dealt.withColumn("_split", n2 > 1)
        return (
            dealt
            .withColumn(mine, spread)
            .withColumn(other, F.explode(F.sequence(F.lit(0), n2 - 1)))
            .drop("_nl", "_nr")
        )

    return (
        assign(left, "_block_l", "_nl", "_block_r", "_nr", by),
        assign(right, "_block_r", "_nr", "_block_l", "_nl", by_right or by),
    )


@dataclass(frozen=True)
class Cells:
    """Both sides listed by cell, the columns they meet on, and whether the right one is sent."""

    left: DataFrame
    right: DataFrame
    on: list[str]
    send: bool

    def joined(self) -> DataFrame:
        """Rows that meet in a cell, before any test."""
        return self.left.join(F.broadcast(self.right) if self.send else self.right, self.on)


def cells_of(
    left: DataFrame, right: DataFrame, cell: float, right_size: Size | None = None,
    left_points: bool = False, finest: int = FINEST,
) -> Cells:
    """The two tables by cell; see ``candidate_pairs``."""
    own = level_of(cell, finest)
    if right_size is None:
        right_size = measure(right, "_nv", own)
    right = right.drop("_nv")
    left_levels = (finest,) if left_points else tuple(range(finest, COARSEST + 1))
    right_levels, chosen = right_size.levels, None
    send = right_size.fits(len(left_levels))
    if not send:
        left_size = measure(left, "0", own)
        chosen = chosen_levels(left_size, right_size, crowding(left, cell, finest))
        left_levels, right_levels = _at(left_size, chosen), _at(right_size, chosen)
        send = right_size.fits(len(left_levels))
    cells_l = with_cells(spread_small(left, "id"), cell, right_levels, finest, chosen)
    cells_r = with_cells(right, cell, left_levels, finest, chosen)
    on = ["_lv", "_cx", "_cy"]
    if not send:
        cells_l, cells_r = split_hot(cells_l, cells_r)
        on += ["_block_l", "_block_r"]
    return Cells(_side(cells_l, "l_"), _side(cells_r, "r_"), on, send)


def candidate_pairs(
    left: DataFrame,
    right: DataFrame,
    cell: float,
    right_size: Size | None = None,
    left_points: bool = False,
    finest: int = FINEST,
) -> DataFrame:
    """Pairs whose envelopes meet, columns prefixed ``l_`` and ``r_``.

    Both tables carry the four envelope columns and ``_salt``, any value that spreads rows, and
    ``right`` also ``_nv``, its vertex count. ``right`` is the smaller one, the queries. ``cell`` is
    the side at level 0, and ``finest`` the lowest level.
    """
    size = _size("_lv", cell)
    return cells_of(left, right, cell, right_size, left_points, finest).joined().where(f"""
        _lv = greatest(l__own, r__own)
        AND l_xmin <= r_xmax AND r_xmin <= l_xmax AND l_ymin <= r_ymax AND r_ymin <= l_ymax
        AND floor(greatest(l_xmin, r_xmin) / {size}) = _cx
        AND floor(greatest(l_ymin, r_ymin) / {size}) = _cy""")
