"""Polygon layers as edge tables.

An edge table has one row per polygon edge:
``layer, bdy_id, bdy_name, part_id, ring_id, is_hole, x1, y1, x2, y2``.
Rings are closed.  Edges run anticlockwise around a part's outside and
clockwise around its holes, which makes areas and overlaps plain sums; every
reader here sees to that, and ``orient`` does for edges from elsewhere.

A layer used more than once is best stored as an edge table first.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EDGE_SCHEMA = ("layer string, bdy_id string, bdy_name string, part_id long, ring_id int, "
               "is_hole boolean, x1 double, y1 double, x2 double, y2 double")
BDY = ["layer", "bdy_id"]
PART = [*BDY, "part_id"]
RING = [*BDY, "bdy_name", "part_id", "ring_id", "is_hole"]
RINGS_TYPE = "array<struct<part_id:bigint,ring_id:int,is_hole:boolean,points:array<struct<x:double,y:double>>>>"

POINTS_PER_FRAME = 100_000
# Parts one row of a boundary may have; a boundary may have half as many rows as this times 2 ** 16.
PARTS_PER_ROW = 2 ** 31


def ring(points: list[tuple], part_id: Column | int = 0, ring_id: int = 0, is_hole: bool = False) -> Column:
    """A ring as a column, from corner expressions; the first corner closes it."""
    corners = [F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
               for x, y in [*points, points[0]]]
    part = part_id if isinstance(part_id, Column) else F.lit(part_id)
    return F.struct(part.cast("bigint").alias("part_id"), F.lit(ring_id).alias("ring_id"),
                    F.lit(is_hole).alias("is_hole"), F.array(*corners).alias("points"))


def edges_from_rings(df: DataFrame, layer: str, bdy_id: Column, bdy_name: Column, rings: Column) -> DataFrame:
    """Edges of polygons held as arrays of rings (see ``RINGS_TYPE``)."""
    flat = df.select(F.lit(layer).alias("layer"), bdy_id.cast("string").alias("bdy_id"),
                     bdy_name.cast("string").alias("bdy_name"), F.inline(rings.cast(RINGS_TYPE)))
    at, after = "element_at(points, i)", "element_at(points, i + 1)"
    corners = "sequence(1, size(points) - 1)"
    # Twice the enclosed area: positive if the ring runs anticlockwise.
    turn = f"aggregate({corners}, 0D, (t, i) -> t + ({at}.x - {after}.x) * ({at}.y + {after}.y))"
    return (flat.filter("size(points) > 1")
            .withColumn("points", F.expr(f"if(({turn} < 0) <> is_hole, reverse(points), points)"))
            .withColumn("e", F.expr(f"explode(transform({corners}, i -> struct({at} as a, {after} as b)))"))
            .selectExpr(*RING, "e.a.x as x1", "e.a.y as y1", "e.b.x as x2", "e.b.y as y2"))


def edges_from_vertices(vertices: DataFrame) -> DataFrame:
    """Edges of a vertex table with ``seq`` numbering each closed ring's points.

    Each vertex meets the next one in an equi-join on the ring and the number,
    so a single long ring spreads over all tasks.
    """
    step = [*PART, "ring_id", "seq"]
    here = vertices.select(*RING, "seq", F.col("x").alias("x1"), F.col("y").alias("y1"))
    after = vertices.withColumn("seq", F.col("seq") - 1).select(
        *step, F.col("x").alias("x2"), F.col("y").alias("y2"))
    return orient(here.join(after, step).select(*RING, "x1", "y1", "x2", "y2"))


def _wkb_rings(wkb: bytes, offset: int = 0) -> tuple[list[list[np.ndarray]], int]:
    """Parts of a (multi)polygon, each a list of rings, and the end offset."""
    order = "<" if wkb[offset] == 1 else ">"
    code, = struct.unpack_from(order + "I", wkb, offset + 1)
    offset += 5
    if code & 0x20000000:  # spatial reference id
        offset += 4
    iso, kind = divmod(code & 0x0FFFFFFF, 1000)
    dims = 2 + bool(code & 0x80000000) + bool(code & 0x40000000) + (0, 1, 1, 2)[iso]
    count, = struct.unpack_from(order + "I", wkb, offset)
    offset += 4
    if kind == 6:
        parts = []
        for _ in range(count):
            inner, offset = _wkb_rings(wkb, offset)
            parts += inner
        return parts, offset
    if kind != 3:
        raise ValueError(f"geometry type {kind} is not a polygon or multipolygon")
    rings = []
    for _ in range(count):
        n, = struct.unpack_from(order + "I", wkb, offset)
        points = np.frombuffer(wkb, order + "f8", n * dims, offset + 4).reshape(n, dims)
        rings.append(points[:, :2].astype("f8"))
        offset += 4 + 8 * n * dims
    return [rings], offset


def _edge_frame(rings: list[tuple]) -> pd.DataFrame:
    """One frame for many rings of (layer, id, name, part, ring, feature, points)."""
    sizes = [len(r[-1]) - 1 for r in rings]
    columns = {name: np.repeat(np.array([r[i] for r in rings], dtype=kind), sizes)
               for i, (name, kind) in enumerate((("layer", object), ("bdy_id", object), ("bdy_name", object),
                                                 ("part_id", "i8"), ("ring_id", "i4"), ("feature", object)))}
    start, end = (np.concatenate([r[-1][cut] for r in rings]) for cut in (slice(None, -1), slice(1, None)))
    return pd.DataFrame({**columns, "is_hole": columns["ring_id"] > 0,
                         "x1": start[:, 0], "y1": start[:, 1], "x2": end[:, 0], "y2": end[:, 1]})


def _wkb_edges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        held: list[tuple] = []
        points_held = 0
        for row in batch.itertuples(index=False):
            parts, _ = _wkb_rings(row.wkb)
            if len(parts) > PARTS_PER_ROW:
                raise ValueError(f"boundary {row.bdy_id!r} has a row of {len(parts)} parts")
            for part_id, rings in enumerate(parts, int(row.nth) * PARTS_PER_ROW):
                for ring_id, points in enumerate(rings):
                    # Outside anticlockwise, holes clockwise.
                    x, y = points[:, 0], points[:, 1]
                    turn = np.sum((x[:-1] - x[1:]) * (y[:-1] + y[1:] - 2 * y.min()))
                    held.append((row.layer, row.bdy_id, row.bdy_name, part_id, ring_id, row.feature,
                                 points[::-1] if (turn < 0) != (ring_id > 0) else points))
                    points_held += len(points)
            if points_held > POINTS_PER_FRAME:
                yield _edge_frame(held)
                held, points_held = [], 0
        if held:
            yield _edge_frame(held)


def edges_from_wkb(df: DataFrame, layer: str, bdy_id: Column, bdy_name: Column, wkb: Column,
                   feature: Column | None = None) -> DataFrame:
    """Edges of polygons held as (extended) well-known binary.

    Each row turns into its edges where it is read, which lets Python see a
    geometry once; everything after works on numbers in columns.  A boundary may
    have several rows, each of which keeps its own parts.  ``feature`` is a key that
    tells them apart: the edges carry it as a column, geometries stay where they are read, and parts
    are numbered by it.  Without one, rows of a boundary are numbered by name and digest of the geometry.
    """
    rows = df.select(F.lit(layer).alias("layer"), bdy_id.cast("string").alias("bdy_id"),
                     bdy_name.cast("string").alias("bdy_name"), wkb.alias("wkb"),
                     (F.lit(None) if feature is None else feature).cast("string").alias("feature")).filter("wkb is not null")
    schema = f"{EDGE_SCHEMA}, feature string"
    if feature is not None:
        return collect_parts(rows.withColumn("nth", F.lit(0)).mapInPandas(_wkb_edges, schema), "feature")
    nth = F.row_number().over(Window.partitionBy(*BDY).orderBy("bdy_name", F.sha2("wkb", 256))) - 1
    return rows.withColumn("nth", nth).mapInPandas(_wkb_edges, schema).drop("feature")


def orient(edges: DataFrame) -> DataFrame:
    """Turn rings so that outsides run anticlockwise and holes clockwise."""
    turn = F.expr("sum((x1 - x2) * (y1 + y2)) as _turn")
    rings = (edges.groupBy(*PART, "ring_id", "is_hole").agg(turn)
             .selectExpr(*PART, "ring_id", "(_turn < 0) <> is_hole as _flip"))
    swapped = [f"if(_flip, {a}, {b}) as {b}" for a, b in (("x2", "x1"), ("y2", "y1"), ("x1", "x2"), ("y1", "y2"))]
    return edges.join(rings, [*PART, "ring_id"]).selectExpr(*RING, *swapped)


def collect_parts(edges: DataFrame, part_key: str) -> DataFrame:
    """Gather the polygons sharing a ``bdy_id`` into one multipart shape.

    ``part_key`` names the column that tells the polygons apart; a polygon that
    has several parts itself keeps them.
    """
    pairs = edges.select(*BDY, part_key, F.col("part_id").alias("_part")).distinct()
    number = F.row_number().over(Window.partitionBy(*BDY).orderBy(part_key, "_part")) - 1
    numbered = edges.alias("e").join(pairs.withColumn("_nth", number).alias("p"), [
        F.col(f"e.{c}").eqNullSafe(F.col(f"p.{c}")) for c in (*BDY, part_key)]
        + [F.col("e.part_id").eqNullSafe(F.col("p._part"))])
    return numbered.select(*[F.col("p._nth").cast("long").alias(c) if c == "part_id" else F.col(f"e.{c}")
                             for c in edges.columns])


def parts(edges: DataFrame) -> DataFrame:
    """One row per polygon part: bounding box, edge statistics, the start of a
    leftmost edge that is not vertical, and the number of its last ring."""
    return edges.groupBy(*PART, "bdy_name").agg(*map(F.expr, (
        "min(least(x1, x2)) as minx", "min(least(y1, y2)) as miny",
        "max(greatest(x1, x2)) as maxx", "max(greatest(y1, y2)) as maxy",
        "count(1) as edge_count", "sum(abs(y2 - y1)) as climb",
        "min(if(x1 <> x2, struct(x1, y1), null)) as corner", "max(ring_id) as rings")))
