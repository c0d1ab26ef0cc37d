"""Areas, centroids, overlaps and equality of polygon layers."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areaweave.operators.spatial.grid import BOX
from areaweave.operators.spatial.chains import differing_ids
from areaweave.operators.spatial.layers import BDY, parts
from areaweave.operators.spatial.predicates import (
    APART, MEET, TOUCH, contacts, corner_inside, edge_pairs, lone_and_other, lone_edge_pairs, named, part_pairs, stored_parts, wanted_ids,
)
from areaweave.sources.steps import step_table

# Rounding of a sum of doubles, as a share of the sum of their sizes.
ROUNDING = 2.0 ** -46

# GRS80 ellipsoid and the national Albers grid (EPSG 3577),
# degrees for angles.
GRS80_A = 6378137.0
GRS80_F = 1 / 298.257222101
ALBERS_LAT1, ALBERS_LAT2, ALBERS_LAT0, ALBERS_LON0 = -18.0, -36.0, 0.0, 132.0


def _albers_terms() -> tuple[float, float, float, float]:
    """Eccentricity, cone constant, C and rho0 of the published formulas."""
    e2 = GRS80_F * (2 - GRS80_F)
    e = math.sqrt(e2)

    def m(lat: float) -> float:
        s = math.sin(math.radians(lat))
        return math.cos(math.radians(lat)) / math.sqrt(1 - e2 * s * s)

    def q(lat: float) -> float:
        s = math.sin(math.radians(lat))
        return (1 - e2) * (s / (1 - e2 * s * s) - math.log((1 - e * s) / (1 + e * s)) / (2 * e))

    n = (m(ALBERS_LAT1) ** 2 - m(ALBERS_LAT2) ** 2) / (q(ALBERS_LAT2) - q(ALBERS_LAT1))
    c = m(ALBERS_LAT1) ** 2 + n * q(ALBERS_LAT1)
    return e, n, c, GRS80_A * math.sqrt(c - n * q(ALBERS_LAT0)) / n


def albers(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Equal-area easting and northing in metres, from degrees."""
    e, n, c, rho0 = _albers_terms()
    s = F.sin(F.radians(lat))
    q = (1 - e * e) * (s / (1 - e * e * s * s) - F.log((1 - e * s) / (1 + e * s)) / (2 * e))
    # The cone opens south: n and rho are negative together.
    rho = GRS80_A * F.sqrt(c - n * q) / n
    theta = n * F.radians(lon - ALBERS_LON0)
    return rho * F.sin(theta), rho0 - rho * F.cos(theta)


def project_albers(edges: DataFrame) -> DataFrame:
    """Edge table from degrees to equal-area metres."""
    x1, y1 = albers(F.col("x1"), F.col("y1"))
    x2, y2 = albers(F.col("x2"), F.col("y2"))
    return edges.withColumns({"x1": x1, "y1": y1, "x2": x2, "y2": y2})


def area_by_key(edges: DataFrame, by: Sequence[str] = (*BDY, "bdy_name")) -> DataFrame:
    """Area per key, holes taken out."""
    return edges.groupBy(*by).agg(F.expr("sum((x1 - x2) * (y1 + y2)) / 2 as area"))


def centroids(edges: DataFrame) -> DataFrame:
    """Area centroid of each boundary: ``layer, bdy_id, bdy_name, px, py``."""
    origin = parts(edges).groupBy(*BDY).agg(F.min("minx").alias("ox"), F.min("miny").alias("oy"))
    cross = "(x1 * y2 - x2 * y1)"
    moved = edges.join(origin, BDY).selectExpr(
        *BDY, "bdy_name", "ox", "oy", "x1 - ox as x1", "y1 - oy as y1", "x2 - ox as x2", "y2 - oy as y2")
    sums = moved.groupBy(*BDY, "bdy_name", "ox", "oy").agg(
        F.expr(f"sum({cross}) as a"), F.expr(f"sum((x1 + x2) * {cross}) as mx"), F.expr(f"sum((y1 + y2) * {cross}) as my"))
    return sums.filter("a <> 0").selectExpr(
        *BDY, "bdy_name", "ox + mx / (3 * a) as px", "oy + my / (3 * a) as py")


# The x range two edges share, from the left of their parts' common box.
RANGE = {"_u": "greatest(least(ax1, ax2), least(bx1, bx2)) - minx",
         "_v": "least(greatest(ax1, ax2), greatest(bx1, bx2)) - minx"}

# Heights of both edges at either end of that range, from the lower part's foot:
# small numbers keep the signed sums exact.  A vertical edge shares no stretch of
# x with any other; its slope is NULL.
_HEIGHT = "{e}y1 - floor + ({x} + minx - {e}x1) * try_divide({e}y2 - {e}y1, {e}x2 - {e}x1)"
HEIGHTS = {name: _HEIGHT.format(e=name[2], x="_u" if name[1] == "y" else "_v") for name in ("_ya", "_yb", "_za", "_zb")}

# Where along the range the edges cross, 1 if they do not; the lower edge's
# heights at both ends; then the place and height of the crossing.
CROSSING = {"_turn": "if((_ya - _yb) * (_za - _zb) < 0, try_divide(_ya - _yb, (_ya - _yb) - (_za - _zb)), 1D)",
            "_f": "least(_ya, _yb)", "_g": "least(_za, _zb)"}
MIDDLE = {"_mid": "_u + _turn * (_v - _u)", "_h": "if(_turn < 1, _ya + _turn * (_za - _ya), _g)"}


def _pieces(u: str, v: str, f: str, g: str) -> tuple[str, str, str]:
    """Area and moments about x and y of a trapezoid from u to v, f high to g high."""
    return (f"({v} - {u}) * ({f} + {g}) / 2", f"({v} - {u}) * ({u} * (2 * {f} + {g}) + {v} * ({f} + 2 * {g})) / 6",
            f"({v} - {u}) * ({f} * {f} + {f} * {g} + {g} * {g}) / 6")


NAMES = ["a_layer", "a_id", "a_name", "b_layer", "b_id", "b_name"]


def _judged(edges_a: DataFrame, edges_b: DataFrame, measured: Callable, placed: Callable, wanted: DataFrame | str | None = None) -> DataFrame:
    """Edges of parts that may meet, grouped by the pairs of parts as ``measured`` says, and by the boundaries as ``placed`` says.

    ``measured`` takes the edges with how they touch and which of them tell that a part holds the other's corner, and the
    columns that go along with a pair.  Small boundaries of one part are judged in the cell where their boxes meet: their pairs are
    neither moved nor grouped again.  All others meet edge by edge.  So do ``wanted`` pairs, which are as few as they are given.
    """
    def told(met: DataFrame) -> DataFrame:
        return contacts(met).withColumns({"_a_in": corner_inside("b", "a"), "_b_in": corner_inside("a", "b")})

    a, b = stored_parts(edges_a), stored_parts(edges_b)
    if wanted is not None:
        pairs, done = [part_pairs(a, b, wanted_ids(a, b) if isinstance(wanted, str) else wanted)], None
    else:
        (lone_a, other_a), (lone_b, other_b) = lone_and_other(a), lone_and_other(b)
        met, dealt = lone_edge_pairs(edges_a, lone_a, edges_b, lone_b)
        done = placed(measured(told(met), [*dealt, "a_name", "b_name"]), False)
        pairs = [part_pairs(x, y) for x, y in ((other_a, b), (lone_a, other_b)) if not (x.isEmpty() or y.isEmpty())]
        if not pairs:
            return done
    # Pairs are dealt out anew: they are few to move, and all that follows from one of them is many.
    every = reduce(DataFrame.unionByName, pairs).repartition("a_id", "a_part", "b_id", "b_part")
    rest = placed(measured(told(edge_pairs(every, named(edges_a, a, "a"), named(edges_b, b, "b"))), []), True)
    return rest if done is None else done.unionByName(rest)


#: Of a pair of parts: its boundaries.  Parts of one pair may have several names.
BOUNDARIES = ["a_part.layer as a_layer", "a_id", "b_part.layer as b_layer", "b_id"]


def _names(carried: Sequence[str]) -> list[Column]:
    """Names of a pair of parts, where they do not go along."""
    return [] if carried else [F.min(c).alias(c) for c in ("a_name", "b_name")]


#: Instead of a table of pairs: those of equal ids.
SAME_IDS = "same ids"


def _measure(edges_a: DataFrame, edges_b: DataFrame, wanted: DataFrame | str | None = None, least: int = MEET) -> DataFrame:
    """Pairs of boundaries whose insides meet, or with ``least`` TOUCH those that share any point,
    and the size of what they share.

    Two passes over one join of edges.  Which pairs there are is decided by how
    boundaries touch, exactly; an area only sizes what was found.  A point is in
    a polygon as often as the polygon's edges above it, counted with their
    direction, add up to.  The overlap of two polygons is therefore a signed sum
    over pairs of edges of the region under both, which needs one equi-join and
    one sum and no clipping: two straight lines cross at most once, so under a
    pair of edges lie two trapezoids.  A sum within its own rounding, where insides
    do meet, is given as that rounding.
    """
    sign = "signum(ax1 - ax2) * signum(bx1 - bx2)"
    pieces = _pieces("_u", "_mid", "_f", "_h"), _pieces("_mid", "_v", "_h", "_g")
    terms, first = list(zip(("s", "mx", "my"), *pieces)), [p[0] for p in pieces]
    # Parts without a common point of their boundaries are apart, or one holds the other.
    kind = f"if(contact = {APART} and (a_in <> 0 or b_in <> 0), {MEET}, contact)"
    rounding = f"{ROUNDING!r}D * mass"
    sized = {"mx": f"if(s > {rounding}, mx, {rounding} * (maxx - minx) / 2)",
             "my": f"if(s > {rounding}, my, {rounding} * ((miny + maxy) / 2 - floor))",
             "s": f"greatest(s, {rounding}, {2.0 ** -1022!r}D)"}

    def measured(met: DataFrame, carried: Sequence[str]) -> DataFrame:
        for step in (RANGE, HEIGHTS, CROSSING, MIDDLE):
            met = met.withColumns({name: F.expr(value) for name, value in step.items()})
        summed = met.groupBy("a_id", "a_part", "b_id", "b_part", *BOX, "floor", *carried).agg(
            *[F.expr(f"coalesce(sum(if(_u < _v, {sign} * ({p} + {q}), null)), 0D) as {name}") for name, p, q in terms],
            F.expr("coalesce(sum(if(_u < _v, abs({}) + abs({}), null)), 0D) as mass".format(*first)),
            F.max("contact").alias("contact"), F.sum("_a_in").alias("a_in"), F.sum("_b_in").alias("b_in"), *_names(carried))
        summed = summed.withColumn("kind", F.expr(kind)).filter(F.col("kind") >= least)
        return summed.withColumns({m: F.expr(f"if(kind = {MEET}, {value}, 0D)") for m, value in sized.items()})

    def placed(summed: DataFrame, several: bool) -> DataFrame:
        # Back to layer coordinates, over all parts of the two boundaries.
        rows = summed.selectExpr(*BOUNDARIES, "a_name", "b_name", "s as area", "kind", "mx + minx * s as mx", "my + floor * s as my", *BOX)
        if several:
            rows = rows.groupBy("a_layer", "a_id", "b_layer", "b_id").agg(
                *map(F.expr, ("min(a_name) as a_name", "min(b_name) as b_name", "sum(area) as area", "max(kind) as kind",
                              "sum(mx) as mx", "sum(my) as my",
                              "min(minx) as minx", "min(miny) as miny", "max(maxx) as maxx", "max(maxy) as maxy")))
        return rows.selectExpr(*NAMES, "area", "try_divide(mx, area) as cx", "try_divide(my, area) as cy", *BOX, "kind")

    return _judged(edges_a, edges_b, measured, placed, wanted)


def overlap(edges_a: DataFrame, edges_b: DataFrame, same_id: bool = False, wanted: DataFrame | None = None) -> DataFrame:
    """Pairs of boundaries whose insides meet: layer, id and name of both, the area, which is never 0, its centroid
    and the bounding box that the parts have in common.

    ``same_id`` pairs equal ids only, ``wanted`` the given ``a_id, b_id`` only; the work follows these pairs.
    """
    return _measure(edges_a, edges_b, SAME_IDS if same_id else wanted).drop("kind")


def overlap_report(edges_a: DataFrame, edges_b: DataFrame) -> DataFrame:
    """Every pair of boundaries that share a point, with layers, names, and the size and centroid of
    what they share.  Pairs that only touch have area 0 and no centroid."""
    return _measure(edges_a, edges_b, least=TOUCH).select(*NAMES, "area", "cx", "cy")


def _pairs_that_meet(edges_a: DataFrame, edges_b: DataFrame) -> DataFrame:
    """Pairs of boundaries that share any point; sides alone, no area."""
    def measured(met: DataFrame, carried: Sequence[str]) -> DataFrame:
        return met.groupBy("a_id", "a_part", "b_id", "b_part", *carried).agg(
            F.max("contact").alias("contact"), F.sum("_a_in").alias("a_in"), F.sum("_b_in").alias("b_in"), *_names(carried)).filter(
                f"contact > {APART} or a_in <> 0 or b_in <> 0")

    def placed(judged: DataFrame, several: bool) -> DataFrame:
        rows = judged.selectExpr(*BOUNDARIES, "a_name", "b_name")
        return rows.groupBy("a_layer", "a_id", "b_layer", "b_id").agg(
            F.min("a_name").alias("a_name"), F.min("b_name").alias("b_name")) if several else rows

    return _judged(edges_a, edges_b, measured, placed)


def polygons_meet(edges_a: DataFrame, edges_b: DataFrame, names: bool = False) -> DataFrame:
    """Pairs ``a_id, b_id`` of boundaries that share any point: edges of theirs
    touch, or one holds the other; with ``names`` also layers and names of both."""
    return _pairs_that_meet(edges_a, edges_b).select(*(NAMES if names else ("a_id", "b_id")))


def percent_overlap(edges_a: DataFrame, edges_b: DataFrame) -> DataFrame:
    """Overlap as a percent of the first boundary's area."""
    size = area_by_key(edges_a, BDY).select(
        F.col("layer").alias("a_layer"), F.col("bdy_id").alias("a_id"), F.col("area").alias("from_area"))
    return overlap(edges_a, edges_b).join(size, ["a_layer", "a_id"]).select(
        *NAMES, (F.col("area") / F.col("from_area") * 100.0).alias("percent_area"))


def geometry_diff(edges_a: DataFrame, edges_b: DataFrame) -> DataFrame:
    """Boundaries in both layers under one id whose shapes are not equal, with both areas and that of the overlap.

    Shapes are equal when their edges, cut where corners lie on them, cancel out; there is no tolerance.  Only those
    that differ are measured.
    """
    ids = step_table(differing_ids(edges_a, edges_b), "differing")

    def kept(edges: DataFrame) -> DataFrame:
        return edges.join(ids, "bdy_id", "left_semi")

    def sizes(edges: DataFrame, name: str) -> DataFrame:
        return area_by_key(kept(edges), ["bdy_id"]).withColumnRenamed("area", name)

    pairs = ids.select(F.col("bdy_id").alias("a_id"), F.col("bdy_id").alias("b_id"))
    shared = overlap(kept(edges_a), kept(edges_b), wanted=pairs).groupBy(F.col("a_id").alias("bdy_id")).agg(
        F.sum("area").alias("overlap_area"))
    return (sizes(edges_a, "a_area").join(sizes(edges_b, "b_area"), "bdy_id")
            .join(shared, "bdy_id", "left").withColumn("overlap_area", F.coalesce("overlap_area", F.lit(0.0))))


def unmatched(edges_a: DataFrame, edges_b: DataFrame) -> DataFrame:
    """Ids of the first layer missing from the second."""
    return edges_a.select("bdy_id").distinct().join(edges_b.select("bdy_id"), "bdy_id", "left_anti")


def atoms_touching(atoms: DataFrame, layer: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Atoms that share a point with any of the named boundaries."""
    chosen = layer.filter(F.col("bdy_id").isin(*ids))
    return polygons_meet(atoms, chosen).select(F.col("a_id").alias("atom_id"), F.col("b_id").alias("bdy_id"))
