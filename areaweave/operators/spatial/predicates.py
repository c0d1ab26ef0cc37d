"""Point in polygon, edges that meet, and a point inside each polygon."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from areaweave.operators.spatial.chains import cut_at_corners
from areaweave.operators.spatial.cover import CELL, OWN, cells_of, cover, depth_for, points_in_cover, united
from areaweave.operators.spatial.exact import side_of, sides_of
from areaweave.operators.spatial.grid import BOX, boxes_by_cell, boxes_in_boxes, points_in_boxes, spans_meet
from areaweave.operators.spatial.layers import BDY, PART, parts
from areaweave.sources.steps import step_table

# Edges per horizontal strip of a polygon.  Fewer means more strips, less work
# per point and more copies of edges that span several strips.
EDGES_PER_STRIP = 16


# Strips to cut a part into: in proportion to its edges, but no more than keeps
# the copies of edges crossing several strips to one per edge.
STRIPS = (f"cast(greatest(1, least(ceil(edge_count / {EDGES_PER_STRIP}), "
          "coalesce(floor(try_divide(edge_count * (maxy - miny), climb)), 1))) as bigint)")


def _strip(value: str, start: str) -> str:
    """Strip a coordinate falls in.  Never decreases with the coordinate, so an
    edge's strips cover every point between its ends."""
    return f"cast(greatest(0, least(floor(({value} - {start}) * per_unit), strips - 1)) as bigint)"


#: A strip's box may be this much flatter than its cells are wide, in halvings.
FLAT = ("if(strips = 1 or maxy <= miny, 0, "
        "least(24, 4 * cast(floor(greatest(log2((maxx - minx) / (maxy - miny)), 0D) / 4) as int)))")

# A strip's edges go along in one row up to this many edges of a part; those of larger parts meet points in a join.
EDGES_IN_ROW = 2 ** 16

# What one edge does to a point's state: bit 0 turns where it is crossed on the way to the right, bit 1 is set by a point on it.
# An edge wholly to the right needs no side.  Half-open in y, so that a vertex counts for one of its two edges.
_SHAPE = ("struct(greatest(x1, x2) as r, least(y1, y2) as lo, greatest(y1, y2) as hi, least(x1, x2) as l, "
          "x1, y1, x2, y2)")
_EDGE = tuple((f"e.x{n}", f"e.y{n}") for n in (1, 2))


def _judged(shape: str, x: str, y: str, start: str = "0") -> str:
    """SQL for a point's state after all edges of a shape: 0 outside."""
    return (f"aggregate({shape}, {start}, (s, e) -> case when e.r < {x} or e.lo > {y} or e.hi < {y} then s "
            f"when {x} < e.l then if({y} < e.hi, s ^ 1, s) "
            f"else get(transform(array({side_of(*_EDGE, (x, y))}), v -> case when v = 0 then s | 2 "
            f"when {y} < e.hi and (v > 0) = (e.y2 > e.y1) then s ^ 1 else s end), 0) end)")



def _crossings(x1: str, y1: str, x2: str, y2: str) -> str:
    """How often an edge held in columns is crossed on the way to the right of ``px, py``, 0 or 1; 4 if they lie on it."""
    turns = f"array(int(py < greatest({y1}, {y2}) and {y2} < {y1}), 4, int(py < greatest({y1}, {y2}) and {y2} > {y1}))"
    return (f"case when greatest({x1}, {x2}) < px or least({y1}, {y2}) > py or greatest({y1}, {y2}) < py then 0 "
            f"when px < least({x1}, {x2}) then int(py < greatest({y1}, {y2})) "
            f"else get({turns}, {side_of((x1, y1), (x2, y2), ('px', 'py'))} + 1) end")


# After the edges of a cell that are columns, which spares most points the arrays: an even number of crossings is outside.
_FEW = (f"base + if(held > 0, {_crossings(*OWN[0])}, 0) + if(held > 1, {_crossings(*OWN[1])}, 0) not in (0, 2)")
# Whether a point that has met a cell of a strip is in or on the part.
_IN_CELL = (f"clear or (px between minx and maxx and py between miny and maxy and {_strip('py', 'foot')} = strip "
            f"and if(held >= 0, {_FEW}, {_judged('shape', 'px', 'py', 'base')} > 0))")


def _strips_with_edges(boxes: DataFrame, edges: DataFrame) -> DataFrame:
    """A row per strip of a part with its edges as an array, and the box that holds every point it can tell anything of."""
    strips = f"sequence({_strip('least(y1, y2)', 'foot')}, {_strip('greatest(y1, y2)', 'foot')})"
    keys = [*PART, "bdy_name", "foot", "top", "per_unit", "strips", "strip"]
    shapes = (edges.select(*PART, "x1", "y1", "x2", "y2")
              .join(boxes.selectExpr(*PART, "bdy_name", "miny as foot", "maxy as top", "per_unit", "strips"), PART)
              .withColumn("strip", F.expr(f"explode({strips})")).groupBy(*keys)
              .agg(F.expr(f"collect_list({_SHAPE}) as shape"),
                   F.expr("min(least(x1, x2)) as minx"), F.expr("max(greatest(x1, x2)) as maxx")))
    # Wider than the strip by more than rounding can move its ends.
    slack = f"(abs(foot) + abs(top)) * {2.0 ** -50!r}D"
    return shapes.withColumns({
        "miny": F.expr(f"if(strip = 0, foot, foot + (strip - 0.01D) / per_unit - {slack})"),
        "maxy": F.expr(f"if(strip = strips - 1, top, foot + (strip + 1.01D) / per_unit + {slack})")})


def _covered(boxes: DataFrame, edges: DataFrame, depth: int) -> DataFrame:
    """The cells of parts, by strip, with the edges that matter there."""
    return cover(_strips_with_edges(boxes, edges), depth, FLAT)


def _hits_by_edge(places: DataFrame, boxes: DataFrame, edges: DataFrame) -> DataFrame:
    """As ``_hits_by_strip``, for parts of any size: a candidate meets the edges of its strip in an
    equi-join, and an aggregate counts crossings to the right."""
    candidates = points_in_boxes(places, boxes, "px", "py").select(
        *places.columns, *PART, "bdy_name", F.expr(f"{_strip('py', 'miny')} as strip"))
    strips = f"sequence({_strip('least(y1, y2)', 'miny')}, {_strip('greatest(y1, y2)', 'miny')})"
    stripped = (edges.select(*PART, "x1", "y1", "x2", "y2")
                .join(boxes.select(*PART, "miny", "per_unit", "strips"), PART)
                .withColumn("strip", F.expr(f"explode({strips})"))
                .select(*PART, "strip", "x1", "y1", "x2", "y2"))
    near = "py between least(y1, y2) and greatest(y1, y2) and px <= greatest(x1, x2)"
    side = side_of(("x1", "y1"), ("x2", "y2"), ("px", "py"))
    on_edge = "side = 0 and px >= least(x1, x2)"
    crosses = "(y1 > py) <> (y2 > py) and (side > 0) = (y2 > y1)"
    judged = (candidates.join(stripped, [*PART, "strip"]).filter(near).withColumn("side", F.expr(side))
              .groupBy(*places.columns, *PART, "bdy_name")
              .agg(F.expr(f"bit_xor(int({crosses})) as odd"), F.expr(f"max(int({on_edge})) as edge")))
    return judged.filter("odd = 1 or edge = 1").select(*places.columns, *BDY, "bdy_name")


def _stripped_parts(edges: DataFrame) -> DataFrame:
    """The rows of ``parts`` as a table, with the strips of each."""
    return step_table(parts(edges).withColumn("strips", F.expr(STRIPS)).withColumn(
        "per_unit", F.expr("coalesce(try_divide(double(strips), maxy - miny), 0D)")), "parts")


def _hits_by_cell(places: DataFrame, covered: DataFrame, pairs: float) -> DataFrame:
    """``places`` with the boundaries they lie in or on, a row per part: judged where a point meets a cell, so pairs
    of points and parts are neither moved nor stored."""
    return points_in_cover(places, covered, pairs).filter(_IN_CELL).select(*places.columns, *BDY, "bdy_name")


def _sums_by_cell(places: DataFrame, covered: DataFrame, sums: Sequence[str], pairs: float) -> DataFrame:
    """As ``_hits_by_cell``, with sums of ``places`` instead of them: a cell inside a part brings one row for all its points."""
    added = [F.sum(c).alias(c) for c in sums]
    clear, touched = covered.filter("clear"), covered.filter("not clear")
    inside = cells_of(places, clear).groupBy(*CELL).agg(*added).join(clear.select(*CELL, *BDY, "bdy_name"), CELL)
    # Values of one place are added up before it meets any edge.
    together = places.groupBy("px", "py").agg(*added)
    return inside.select(*sums, *BDY, "bdy_name").union(
        _hits_by_cell(together, touched, pairs / 2).select(*sums, *BDY, "bdy_name"))


def hits(points: DataFrame, edges: DataFrame, point_id: str, x: str = "px", y: str = "py",
         sums: Sequence[str] = ()) -> DataFrame:
    """As ``point_in_polygon_join``, with the id as ``point_id``.  With ``sums``, without ids: rows that add up to
    the sums of these columns, over all rows of each id, by boundary.

    A pair can only come up twice where a boundary has several parts or an id several places; only
    such pairs are made distinct, the others are ready where they are found.
    """
    place = f"if({x} is null or {y} is null, null, struct(double({x}) as px, double({y}) as py))"
    ids = step_table(points.groupBy(F.col(point_id).alias("point_id")).agg(
        F.expr(f"min({place}) as place"), F.expr(f"max({place}) as last"), *[F.sum(c).alias(c) for c in sums]), "points")
    once = ids.filter("place = last").select("point_id", *sums, "place.px", "place.py")
    several = ids.filter("place <> last").select("point_id", *sums)
    boxes = _stripped_parts(edges)
    shared = boxes.groupBy(*BDY).count().filter("count > 1").select(*BDY)
    large, small = boxes.filter(f"edge_count > {EDGES_IN_ROW}"), boxes.filter(f"edge_count <= {EDGES_IN_ROW}")
    # Sums are judged by place, all others by point.
    depth, pairs = depth_for(once.select("px", "py").distinct() if sums else once, boxes)
    places, again, every = once, [], []
    if shared.isEmpty():
        every.append(_covered(small, edges, depth))
    else:
        every.append(_covered(small.join(shared, BDY, "left_anti"), edges, depth))
        every.append(united(_covered(small.join(shared, BDY, "left_semi"), edges, depth)))
        again.append(_hits_by_cell(once, every[1], pairs))
    if not several.isEmpty():
        rows = points.selectExpr(f"{point_id} as _id", f"double({x}) as px", f"double({y}) as py").distinct()
        moved = rows.join(several, F.col("_id").eqNullSafe(F.col("point_id"))).select(*once.columns)
        again += [_hits_by_cell(moved, covered, pairs) for covered in every]
        places = once.union(moved)
    if not large.isEmpty():
        again.append(_hits_by_edge(places, large, edges))
    kept = [*sums, *BDY, "bdy_name"] if sums else ["point_id", *BDY, "bdy_name"]
    found = (_sums_by_cell(once, every[0], sums, pairs) if sums else _hits_by_cell(once, every[0], pairs)).select(*kept)
    if again:
        found = found.union(reduce(DataFrame.union, again).drop("px", "py").distinct().select(*kept))
    return found


# A boundary's edges go along with its point up to this many.
EDGES_WITH_POINT = 2 ** 10


def lone_parts(edges: DataFrame) -> DataFrame:
    """Parts that are all there is under their id, with few edges: such boundaries meet others once at most."""
    boxes = _stripped_parts(edges)
    once = boxes.groupBy("bdy_id").count().filter("count = 1").select("bdy_id")
    known = f"edge_count <= {EDGES_WITH_POINT} and layer is not null and part_id is not null and bdy_name is not null"
    return step_table(boxes.filter(known).join(once, "bdy_id", "left_semi"), "lone")


def lone_matches(a: tuple[DataFrame, ...], b: tuple[DataFrame, ...]) -> DataFrame:
    """Pairs of boundaries of ``lone_parts`` where the point of one lies in the other: ids, names, and ``match_count``, 2 when
    it holds both ways.

    Each side is its lone parts, its edges and the points of its boundaries.  A point brings its boundary's
    edges along and a strip its boundary's point, so both ways are judged where a point meets a strip, and no pair is shuffled.
    """
    def carried(lone: DataFrame, edges: DataFrame, points: DataFrame) -> DataFrame:
        shapes = edges.join(lone, BDY, "left_semi").groupBy("bdy_id").agg(F.expr(f"collect_list({_SHAPE}) as own"))
        box = lone.selectExpr("bdy_id", *[f"{c} as own_{c}" for c in BOX])
        return points.join(shapes, "bdy_id").join(box, "bdy_id").withColumnsRenamed({"bdy_id": "p_id", "bdy_name": "p_name"}).drop("layer")

    def found(side: tuple[DataFrame, ...], others: tuple[DataFrame, ...]) -> DataFrame:
        lone, edges, points = side
        strips = _strips_with_edges(lone, edges).join(points.selectExpr("bdy_id", "px as qx", "py as qy"), "bdy_id", "left")
        depth, pairs = depth_for(others[2], lone)
        back = f"qx between own_minx and own_maxx and qy between own_miny and own_maxy and {_judged('own', 'qx', 'qy')} > 0"
        return points_in_cover(carried(*others), cover(strips, depth, FLAT), pairs).filter(_IN_CELL).withColumn(
            "back", F.expr(f"coalesce({back}, false)"))

    names = {"a": ("p_id", "p_name", "bdy_id", "bdy_name"), "b": ("bdy_id", "bdy_name", "p_id", "p_name")}
    keys = {k: [f"{c} as {n}" for c, n in zip(v, ("a_id", "a_name", "b_id", "b_name"), strict=True)] for k, v in names.items()}
    # What holds both ways is told by the points of the first.
    return found(b, a).selectExpr(*keys["a"], "if(back, 2L, 1L) as match_count").union(
        found(a, b).filter("not back").selectExpr(*keys["b"], "1L as match_count"))


def point_in_polygon_join(points: DataFrame, edges: DataFrame, point_id: str,
                          x: str = "px", y: str = "py") -> DataFrame:
    """Every point with every boundary it lies in or on: ``point_id`` and the
    boundary's layer, id and name, each pair once, also where ids repeat.

    Each polygon is cut into horizontal strips and these into cells of a grid, see ``cover``.  A point in a cell wholly inside is
    a hit; others are judged where they meet a cell, by the edges that go along with it.  Parts are judged one by one, so
    overlapping parts of one boundary do not cancel out.  On which side of an
    edge a point lies is decided exactly.
    """
    return hits(points, edges, point_id, x, y).withColumnRenamed("point_id", point_id)


def point_on_surface(edges: DataFrame) -> DataFrame:
    """A point well inside each boundary: ``layer, bdy_id, bdy_name, px, py``.

    A horizontal line is laid across each part halfway between the vertices
    next above and below the middle of its box, so it runs through no vertex.
    The point is the middle of the widest stretch inside, over all parts.
    """
    middle = parts(edges).selectExpr(*PART, "bdy_name", "(miny + maxy) / 2 as mid")
    shape = edges.select(*PART, "x1", "y1", "x2", "y2")
    between = "(max(if(y1 <= mid, y1, null)) + min(if(y1 > mid, y1, null))) / 2 as py"
    lines = (shape.join(middle, PART).groupBy(*PART, "bdy_name").agg(F.expr(between))
             .filter("py is not null"))
    cut = shape.join(lines, PART).filter("(y1 > py) <> (y2 > py)")
    # Crossings of one line with one part, in order: odd ones enter, even ones
    # leave.  A part has at most as many as fit its one geometry value.
    along = Window.partitionBy(*PART).orderBy("at")
    spans = (cut.selectExpr(*PART, "bdy_name", "py", "x1 + (py - y1) * (x2 - x1) / (y2 - y1) as at")
             .withColumns({"n": F.row_number().over(along), "to": F.lead("at").over(along)})
             .filter("n % 2 = 1 and to is not null"))
    best = F.expr("max(struct(to - at as width, (at + to) / 2 as px, py)) as best")
    return (spans.groupBy(*BDY, "bdy_name").agg(best)
            .select(*BDY, "bdy_name", "best.px", "best.py"))


def edge_pairs(pairs: DataFrame, edges_a: DataFrame, edges_b: DataFrame) -> DataFrame:
    """Edges of two layers that share some x, for given pairs of parts.

    ``pairs`` comes from ``part_pairs`` and the edges from ``named``.  Each part is
    cut into bands of x, in proportion to its edges.  Edges of the first
    layer meet the pairs whose box they share x with; what they share with the
    box then meets the edges of the second.  Long edges have few copies in either
    join, see ``spans_meet``.
    """
    def band(side: str, value: str) -> str:
        return (f"cast(greatest(0, least(floor(({value} - {side}_start) * {side}_per_unit), "
                f"{side}_bands - 1)) as bigint)")

    def banded(edges: DataFrame, side: str, name: str) -> DataFrame:
        return edges.withColumns({
            f"{name}_first": F.expr(band(side, "least(x1, x2)")), f"{name}_last": F.expr(band(side, "greatest(x1, x2)"))
        }).drop(f"{side}_start", f"{side}_bands", f"{side}_per_unit")

    boxed = pairs.withColumns({"b_first": F.expr(band("a", "minx")), "b_last": F.expr(band("a", "maxx"))})
    own = spans_meet(banded(edges_a, "a", "a"), boxed, ["a_id", "a_part"], "a_top")
    own = own.filter("greatest(x1, x2) >= minx and least(x1, x2) <= maxx").drop("a_first", "a_last", "b_first", "b_last")
    shared = {"a_first": F.expr(band("b", "greatest(minx, least(x1, x2))")),
              "a_last": F.expr(band("b", "least(maxx, greatest(x1, x2))"))}
    met = spans_meet(_prefixed(own.withColumns(shared), "a"), _prefixed(banded(edges_b, "b", "b"), "b"),
                     ["b_id", "b_part"], "b_top")
    return met.filter("greatest(least(ax1, ax2), least(bx1, bx2), minx) <= "
                      "least(greatest(ax1, ax2), greatest(bx1, bx2), maxx)")


#: Columns of an edge beside its part: ends, the corner before its start, and the turn there.
EDGE = ["x1", "y1", "x2", "y2", "x0", "y0", "bend"]


def _prefixed(edges: DataFrame, side: str) -> DataFrame:
    return edges.withColumnsRenamed({c: f"{side}{c}" for c in EDGE})


def stored_parts(edges: DataFrame) -> DataFrame:
    """The rows of ``parts`` as a table: they are read several times, and are few beside the edges."""
    return step_table(parts(edges), "parts")


def named(edges: DataFrame, sizes: DataFrame, side: str) -> DataFrame:
    """Edges by their part's key, each with its part's bands, the boundary's next corner anticlockwise around its
    start (``x0, y0``) and the side of the edge on which that corner is (``bend``): the inside is what lies between.

    ``sizes`` comes from ``stored_parts``.  The next corner is the one before on the ring.  Rings of one part may touch,
    so parts with several rings are cut at their own corners, and of several corners before the next
    anticlockwise is taken, by angles in doubles.
    """
    real = edges.select(*PART, "ring_id", "x1", "y1", "x2", "y2").filter("x1 <> x2 or y1 <> y2")
    at = [*PART, "x1", "y1"]
    before = lambda df: df.selectExpr(*PART, "x2 as x1", "y2 as y1", "x1 as x0", "y1 as y0")
    columns = [*PART, "x1", "y1", "x2", "y2", "before.x0", "before.y0"]

    def plain(one: DataFrame) -> DataFrame:
        return one.join(before(one).groupBy(*at).agg(F.min(F.struct("x0", "y0")).alias("before")), at, "left").select(*columns)

    holed = sizes.filter("rings > 0").select(*PART)
    if holed.isEmpty():
        cornered = plain(real)
    else:
        cut = step_table(cut_at_corners(step_table(real.join(holed, PART, "left_semi"), "rings"), PART), "cut")
        turn = "pmod(atan2(y0 - y1, x0 - x1) - atan2(y2 - y1, x2 - x1), 2 * pi())"
        many = cut.join(before(cut), at, "left").withColumn("turn", F.expr(turn)).groupBy(*at, "x2", "y2").agg(
            F.min(F.struct("turn", "x0", "y0")).alias("before"))
        cornered = plain(real.join(holed, PART, "left_anti")).union(many.select(*columns))
    bend = side_of(("x1", "y1"), ("x2", "y2"), ("x0", "y0"))
    bands = sizes.selectExpr(*PART, *[f"{value} as {side}_{name}" for name, value in BANDS.items()])
    return cornered.join(bands, PART).selectExpr(
        f"bdy_id as {side}_id", f"struct(layer, part_id) as {side}_part", *EDGE[:-1], f"if(x0 is null, null, {bend}) as bend",
        *[f"{side}_{name}" for name in BANDS])


#: A part's bands of x, from its row of ``parts``: where they start, how many there are and in a unit of x, and the level
#: on which one cell holds them all.
_COUNT = f"cast(greatest(1, ceil(edge_count / {EDGES_PER_STRIP})) as bigint)"
BANDS = {"start": "minx", "bands": _COUNT, "per_unit": f"coalesce(try_divide(double({_COUNT}), maxx - minx), 0D)",
         "top": f"cast(ceil(log2({_COUNT})) as int)"}


def part_pairs(sizes_a: DataFrame, sizes_b: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """Parts of two layers, from ``stored_parts``, whose boxes meet: keys, names, common box, the foot of the
    lower part and the bands of each.  Ids of different layers stay apart.

    ``wanted`` (``a_id, b_id``) leaves only parts of these pairs of boundaries, before any box is looked at.
    """
    def boxes(sizes: DataFrame, side: str) -> DataFrame:
        found = sizes.selectExpr(
            f"bdy_id as {side}_id", f"struct(layer, part_id) as {side}_part", f"bdy_name as {side}_name", *BOX,
            f"corner as {side}_corner", f"miny as {side}_low", *[f"{value} as {side}_{name}" for name, value in BANDS.items()])
        if wanted is not None:
            found = found.join(wanted.select("a_id", "b_id", F.struct("a_id", "b_id").alias("pair")).distinct(), f"{side}_id")
        return found

    a_key, b_key = ([f"{side}_{c}" for c in ("id", "name", "part", "low", "corner", *BANDS)] for side in "ab")
    pairs = boxes_in_boxes(boxes(sizes_a, "a"), boxes(sizes_b, "b"), a_key, b_key, on=[] if wanted is None else ["pair"])
    return pairs.withColumn("floor", F.least("a_low", "b_low")).drop("a_low", "b_low", "pair")


def wanted_ids(sizes_a: DataFrame, sizes_b: DataFrame) -> DataFrame:
    """Pairs of equal ids of two layers, for ``part_pairs``."""
    ids = sizes_a.select(F.col("bdy_id").alias("a_id")).distinct()
    return ids.join(sizes_b.select(F.col("bdy_id").alias("a_id")).distinct(), "a_id", "left_semi").select(
        "a_id", F.col("a_id").alias("b_id"))


# The edges of a boundary of one part go along with its box up to this many.
EDGES_WITH_BOX = 2 ** 5


def lone_and_other(sizes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of ``stored_parts`` that are all there is of their boundary, with few edges, and the others."""
    once = sizes.groupBy(*BDY).agg(F.count("*").alias("n"), F.count("part_id").alias("known"), F.max("edge_count").alias("most")).filter(
        f"n = 1 and known = 1 and most <= {EDGES_WITH_BOX}").select(*BDY)
    return step_table(sizes.join(once, BDY, "left_semi"), "lone"), step_table(sizes.join(once, BDY, "left_anti"), "other")


def lone_edge_pairs(edges_a: DataFrame, lone_a: DataFrame, edges_b: DataFrame, lone_b: DataFrame) -> tuple[DataFrame, list[str]]:
    """As ``edge_pairs``, for the parts of ``lone_and_other``, and what to group by so that no pair is moved.

    Each box brings its edges along to the cell where it meets the other's.  Boxes along the diagonals, from sums and
    differences of coordinates, leave out pairs that lie beside each other aslant: rounding keeps the order of numbers.
    """
    def boxed(edges: DataFrame, lone: DataFrame, side: str) -> DataFrame:
        own = named(edges, lone, side).groupBy(f"{side}_id", f"{side}_part").agg(
            F.collect_list(F.struct(*EDGE)).alias(f"{side}_edges"),
            *[F.expr(f"{f}({g}(x1 {op} y1, x2 {op} y2)) as {side}_{f}_{way}")
              for op, way in (("+", "sum"), ("-", "gap")) for f, g in (("min", "least"), ("max", "greatest"))])
        return lone.selectExpr(f"bdy_id as {side}_id", f"struct(layer, part_id) as {side}_part", f"bdy_name as {side}_name", *BOX,
                               f"corner as {side}_corner", f"miny as {side}_low").join(own, [f"{side}_id", f"{side}_part"])

    keys = [[f"{side}_{c}" for c in ("id", "part", "name", "corner", "low", "edges", "min_sum", "max_sum", "min_gap", "max_gap")] for side in "ab"]
    session = edges_a.sparkSession
    tasks = max(session.sparkContext.defaultParallelism, int(session.conf.get("spark.sql.shuffle.partitions")))
    pairs, dealt = boxes_by_cell(boxed(edges_a, lone_a, "a"), boxed(edges_b, lone_b, "b"), *keys, tasks)
    near = " and ".join(f"{p}_min_{way} <= {q}_max_{way}" for way in ("sum", "gap") for p, q in ("ab", "ba"))
    kept = [*dealt, *[f"{side}_{c}" for side in "ab" for c in ("id", "part", "name", "corner")], *BOX, "floor"]
    columns = {side: [f"{side}{c}" for c in EDGE] for side in "ab"}
    own = (pairs.filter(near).withColumn("floor", F.least("a_low", "b_low"))
           .selectExpr(*kept, "b_edges", f"inline(a_edges) as ({', '.join(columns['a'])})")
           .filter("greatest(ax1, ax2) >= minx and least(ax1, ax2) <= maxx"))
    met = own.selectExpr(*kept, *columns["a"], f"inline(b_edges) as ({', '.join(columns['b'])})")
    return met.filter("greatest(least(ax1, ax2), least(bx1, bx2), minx) <= "
                      "least(greatest(ax1, ax2), greatest(bx1, bx2), maxx)"), dealt


#: What two edges, or two parts by the most of their edges, have to do with each other.
APART, TOUCH, MEET = 0, 1, 2


def _point(name: str) -> tuple[str, str]:
    """The coordinates of a corner such as ``a1``: x and y."""
    return f"{name[0]}x{name[1]}", f"{name[0]}y{name[1]}"


def _equal(p: str, q: str) -> str:
    (px, py), (qx, qy) = _point(p), _point(q)
    return f"({px} = {qx} and {py} = {qy})"


_SAME_WAY = ("(signum(ax2 - ax1) = signum(bx2 - bx1) and signum(ay2 - ay1) = signum(by2 - by1))")

#: Sides that a contact needs: start, end and point of each, by the corners of two edges; 0 is the corner before 1.
#: The first four are column ``sides``; the others are worked out, as ``o``, for edges that touch.
SIDES = [name.split() for name in ("b1 b2 a1", "b1 b2 a2", "a1 a2 b1", "a1 a2 b2")]
MORE = [name.split() for name in ("b1 b2 a0", "a1 a2 b0", "a1 b2 a0", "b1 a2 b0")]


def _side(name: str) -> str:
    triple = name.split()
    return f"get(sides, {SIDES.index(triple)})" if triple in SIDES else f"get(o, {MORE.index(triple)})"


def _corner_on_edge(p: str, q: str) -> str:
    """Whether the inside of ``p`` at its edge's start reaches the inside of ``q``, on the middle of whose edge it lies.

    The inside of ``q`` is left of its edge.  That of ``p`` is what is swept anticlockwise from its edge to the corner
    before: some of it is left of ``q`` if either ray is, if the sweep is more than half a turn, or if it is half a turn
    and starts along ``q``.
    """
    x, y = _point(f"{p}1")
    place = (f"{_side(f'{q}1 {q}2 {p}1')} = 0 and not {_equal(f'{p}1', f'{q}1')} and not {_equal(f'{p}1', f'{q}2')} and "
             f"{x} between least({q}x1, {q}x2) and greatest({q}x1, {q}x2) and "
             f"{y} between least({q}y1, {q}y2) and greatest({q}y1, {q}y2)")
    return (f"({place} and {p}bend is not null and ({p}bend < 0 or ({p}bend = 0 and {_SAME_WAY}) "
            f"or {_side(f'{q}1 {q}2 {p}2')} > 0 or {_side(f'{q}1 {q}2 {p}0')} > 0))")


def _ray_within(p: str, q: str) -> str:
    """Whether the edge of ``q`` sets out into the inside of ``p``, or along its edge, from a corner of both."""
    left, right = f"{_side(f'{p}1 {p}2 {q}2')} > 0", f"{_side(f'{p}1 {q}2 {p}0')} > 0"
    along = f"({_side(f'{p}1 {p}2 {q}2')} = 0 and {_SAME_WAY})"
    return (f"({along} or ({p}bend > 0 and {left} and {right}) or ({p}bend = 0 and {left}) "
            f"or ({p}bend < 0 and ({left} or {right})))")


def contacts(met: DataFrame) -> DataFrame:
    """Rows of ``edge_pairs`` with ``contact``: whether the edges share no point, touch, or show that the insides meet.

    Insides meet where edges cross, and where corners or edges touch so that the inside of one reaches into
    the other's; if boundaries share a point and insides meet anywhere, they do so at a point that both boundaries share.
    Only edges whose boxes meet are looked at, and all their sides are decided exactly.
    """
    close = " and ".join(f"least({p}{c}1, {p}{c}2) <= greatest({q}{c}1, {q}{c}2)"
                         for c in "xy" for p, q in ("ab", "ba"))

    def decided(names: list[list[str]]) -> str:
        return sides_of([tuple(_point(corner) for corner in triple) for triple in names])

    ends = [_side(" ".join(name)) for name in SIDES]
    meets = (f"case when {_equal('a1', 'b1')} then abend is not null and bbend is not null "
             f"and ({_ray_within('a', 'b')} or {_ray_within('b', 'a')}) "
             f"else {_corner_on_edge('a', 'b')} or {_corner_on_edge('b', 'a')} end")
    contact = (f"case when sides is null or {ends[0]} * {ends[1]} > 0 or {ends[2]} * {ends[3]} > 0 then {APART} "
               f"when {ends[0]} * {ends[1]} < 0 and {ends[2]} * {ends[3]} < 0 then {MEET} "
               f"else get(transform(array({decided(MORE)}), o -> if({meets}, {MEET}, {TOUCH})), 0) end")
    return (met.withColumn("sides", F.expr(f"if({close}, {decided(SIDES)}, null)"))
            .withColumn("contact", F.expr(contact)).drop("sides"))


def corner_inside(outer: str, inner: str) -> Column:
    """Of a row of ``edge_pairs``, the turn of the outer edge above the inner part's corner.

    Summed over all rows of two parts whose edges do not touch, it is 0 unless
    the inner part lies in the outer one.  Half-open in x, so that a vertex
    above the corner counts for one of its two edges.
    """
    x, y = f"{inner}_corner.x1", f"{inner}_corner.y1"
    starts = f"{inner}x1 = {x} and {inner}y1 = {y} and {inner}x1 <> {inner}x2"
    spans = f"({outer}x1 <= {x}) <> ({outer}x2 <= {x})"
    # Below an edge is to the right of it if it runs to the right.
    run = f"int(signum({outer}x1 - {outer}x2))"
    below = f"{side_of(_point(f'{outer}1'), _point(f'{outer}2'), _point(f'{inner}1'))} = {run}"
    return F.expr(f"if({starts} and {spans} and {below}, {run}, 0)")
