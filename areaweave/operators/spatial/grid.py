"""Bounding-box matching as an equi-join on grid cells.

Boxes go into a grid whose cells are powers of two, at the level where a cell is
at least half the box's longer side: at most three cells each way, whatever
the size.  The other input is looked up on every level in use, so small and
very large shapes share one join without large ones flooding fine cells.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areaweave.sources.steps import step_table

# Smallest cells: 2 to this power, fine enough for points and small enough that a
# cell number fits 64 bits.
MIN_LEVEL = -30

# Exponent of a box's cell side, and a coordinate's cell on the row's level.
LEVEL = f"cast(ceil(log2(greatest(maxx - minx, maxy - miny, {2.0 ** MIN_LEVEL!r}D))) as int) - 1"
CELL = "cast(floor({} / pow(2D, level)) as bigint)"
BOX = ["minx", "miny", "maxx", "maxy"]


def _levels(boxes: DataFrame, flat: str) -> Column:
    """The levels present, as a scalar subquery: a handful of exponents."""
    return boxes.agg(F.expr(f"collect_set(struct({LEVEL} as level, {flat} as _flat)) as levels")).scalar()


def spread(boxes: DataFrame) -> DataFrame:
    """One row per cell a box meets on its row's level."""
    for cell, low, high in (("gx", "minx", "maxx"), ("gy", "miny", "maxy")):
        boxes = boxes.withColumn(cell, F.expr(f"explode(sequence({CELL.format(low)}, {CELL.format(high)}))"))
    return boxes


def points_in_boxes(points: DataFrame, boxes: DataFrame, x: str, y: str, on: Sequence[str] = (),
                    flat: str = "0") -> DataFrame:
    """Every point with every box it lies in, edges included.

    A point has one cell per level and a box is on one level, so no pair can
    come up twice.  ``on`` names key columns of both that must be equal besides.
    ``flat`` is SQL for how many times the cells of a box are halved in y: many flat boxes
    above each other then do not meet every point of a square cell.
    """
    cell_y = "cast(floor({} / pow(2D, level - _flat)) as bigint)"
    looked_up = (points.withColumn("_levels", _levels(boxes, flat)).withColumn("_at", F.explode("_levels"))
                 .withColumns({"level": F.col("_at.level"), "_flat": F.col("_at._flat")}).drop("_levels", "_at")
                 .withColumns({"gx": F.expr(CELL.format(x)), "gy": F.expr(cell_y.format(y))}))
    celled = boxes.withColumns({"level": F.expr(LEVEL), "_flat": F.expr(flat)})
    for cell, low, high in (("gx", CELL.format("minx"), CELL.format("maxx")),
                            ("gy", cell_y.format("miny"), cell_y.format("maxy"))):
        celled = celled.withColumn(cell, F.expr(f"explode(sequence({low}, {high}))"))
    return (looked_up.join(celled, [*on, "level", "_flat", "gx", "gy"])
            .filter(f"{x} between minx and maxx and {y} between miny and maxy").drop("level", "_flat", "gx", "gy"))


def boxes_in_boxes(a: DataFrame, b: DataFrame, a_key: Sequence[str], b_key: Sequence[str],
                   on: Sequence[str] = ()) -> DataFrame:
    """Pairs of boxes that touch or overlap, with their common box.

    Inputs have ``minx, miny, maxx, maxy``; keys must not share names.  ``on``
    names key columns of both sides that must be equal besides; boxes under one
    such key meet by cell like any others.

    One of the two is on its own level: small boxes never meet other small ones
    in the large cells that only a large box uses.  ``role`` says which one.
    """
    left, right = _celled_sides(a, b, a_key, b_key, on)
    return _common(left.join(right, [*on, *CELLS]), [*on, *a_key, *b_key])


#: What tells a cell: which side is on its own level, the level, and the place.
CELLS = ["role", "level", "gx", "gy"]


def _common(met: DataFrame, kept: Sequence[str]) -> DataFrame:
    """Of rows that share a cell, those whose boxes touch or overlap, once, with their common box."""
    common = {c: F.expr(f"{'greatest' if c.startswith('min') else 'least'}(a_{c}, b_{c})") for c in BOX}
    # Boxes share many cells; the one holding the corner of their common box
    # reports the pair.
    once = f"gx = {CELL.format('minx')} and gy = {CELL.format('miny')}"
    return met.withColumns(common).filter(f"minx <= maxx and miny <= maxy and {once}").select(*kept, *BOX)


def _celled_sides(a: DataFrame, b: DataFrame, a_key: Sequence[str], b_key: Sequence[str],
                  on: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Both sides of ``boxes_in_boxes``, a row for each cell."""
    def celled(side: DataFrame, key: Sequence[str], name: str, other: list[int], own: int) -> DataFrame:
        # The first box is on its own level against boxes as fine or finer, the second against finer ones.
        levels = f"filter(_all, l -> l {'>' if own == 0 else '>='} _own)"
        # Its own level is of use only if the other side looks it up there.
        met = f"exists(_all, l -> l {'<=' if own == 0 else '<'} _own)"
        places = (f"concat(if({met}, array(named_struct('role', {own}, 'level', _own)), array()), "
                  f"transform({levels}, l -> named_struct('role', {1 - own}, 'level', l)))")
        known = f"cast(array({', '.join(map(str, other))}) as array<int>)"
        return (spread(side.selectExpr(*on, *key, *BOX, f"{LEVEL} as _own").withColumn("_all", F.expr(known))
                        .withColumn("_at", F.expr(f"explode({places})"))
                        .withColumns({"role": F.col("_at.role"), "level": F.col("_at.level")}))
                .selectExpr(*on, *key, "role", "level", "gx", "gy", *[f"{c} as {name}_{c}" for c in BOX]))

    # Asked for at once: a handful of numbers that would else bring each side's whole plan in once more.
    a_levels, b_levels = (side.agg(F.expr(f"collect_set({LEVEL}) as levels")).first()["levels"] for side in (a, b))
    return celled(a, a_key, "a", b_levels, 0), celled(b, b_key, "b", a_levels, 1)


# Rows of one cell that meet in one task, as pairs, about.
PAIRS_AT_ONCE = 4_000_000


def boxes_by_cell(a: DataFrame, b: DataFrame, a_key: Sequence[str], b_key: Sequence[str], tasks: int) -> tuple[DataFrame, list[str]]:
    """As ``boxes_in_boxes``, in ``tasks`` tasks at least, each with a bounded number of pairs, and the columns by which the
    pairs lie together: what is grouped by these and more is not moved again.

    Pairs are counted by cell before; rows of a crowded cell are dealt to several slices, each of which has all rows of the
    other side.
    """
    left, right = _celled_sides(a, b, a_key, b_key)
    both = left.groupBy(*CELLS).agg(F.count("*").alias("n_a")).join(right.groupBy(*CELLS).agg(F.count("*").alias("n_b")), CELLS)
    counts = step_table(both.selectExpr(*CELLS, "n_a * n_b as n", f"cast(ceil(n_a * n_b / {PAIRS_AT_ONCE}) as int) as slices"), "cells")
    tasks = int(max(tasks, (counts.agg(F.sum("n")).first()[0] or 0) // PAIRS_AT_ONCE))
    dealt = [*CELLS, "slice"]
    left = left.join(counts, CELLS).withColumn("slice", F.expr(f"cast(pmod(xxhash64({', '.join(a_key)}), slices) as int)"))
    right = right.join(counts, CELLS).withColumn("slice", F.expr("explode(sequence(0, slices - 1))"))
    met = left.drop("n", "slices").repartition(tasks, *dealt).join(right.drop("n", "slices").repartition(tasks, *dealt), dealt)
    return _common(met, [*dealt, *a_key, *b_key]), dealt


def spans_meet(a: DataFrame, b: DataFrame, on: Sequence[str], top: str) -> DataFrame:
    """Rows of both with equal ``on`` whose spans of whole numbers share one.

    Spans are ``a_first`` to ``a_last`` and ``b_first`` to ``b_last``, from 0 to
    less than 2 to the power of column ``top``, which both have and which ``on`` determines.
    A span is kept on the level where at most two cells hold it, so a long one has
    no more copies than a short one; the other side is looked up there and on
    each coarser level.
    """
    def celled(side: DataFrame, name: str) -> DataFrame:
        first, last = f"{name}_first", f"{name}_last"
        own = f"cast(ceil(log2({last} - {first} + 1)) as int)"
        # As in boxes_in_boxes; a second span on the finest level is met by nothing finer.
        if name == "a":
            levels, role, level = f"sequence({own}, {top})", f"int(l > {own})", "l"
        else:
            levels, role, level = f"sequence({own} - int({own} > 0), {top})", f"int(l < {own})", f"greatest(l, {own})"
        cells = (f"transform({levels}, l -> transform(sequence(shiftright({first}, {level}), shiftright({last}, {level})), "
                 f"c -> named_struct('role', {role}, 'level', {level}, 'cell', c)))")
        # Where one cell holds everything there is nothing to work out.
        only = "array(named_struct('role', 0, 'level', 0, 'cell', 0L))"
        return side.selectExpr("*", f"inline(if({top} = 0, {only}, flatten({cells}))) as (role, level, cell)")

    met = celled(a, "a").join(celled(b, "b").drop(top), [*on, "role", "level", "cell"])
    # A coarse cell may hold both without a common number.
    return met.filter("a_first <= b_last and b_first <= a_last and cell = shiftright(greatest(a_first, b_first), level)").drop(
        "role", "level", "cell")
