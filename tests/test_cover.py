"""Cells that hold polygons: equal to judging every point by every edge, and sparing most points the edges."""

import math
import random
from fractions import Fraction

import areaweave as aw
from areaweave.operators.spatial import cover as c
from areaweave.operators.spatial.predicates import _covered, _stripped_parts, hits
from areaweave.sources.steps import step_table

COLUMNS = "layer string, bdy_id string, bdy_name string, part_id long, ring_id int, is_hole boolean, x1 double, y1 double, x2 double, y2 double"


def edges(rings):
    """Rows of edges from (id, part, corners)."""
    return [("l", i, f"name {i}", part, 0, False, *map(float, (*p, *q))) for i, part, corners in rings
            for p, q in zip(corners, corners[1:] + corners[:1], strict=True)]


def inside(point, corners):
    """Whether a point lies in or on a ring, by rational arithmetic."""
    x, y = map(Fraction, point)
    odd = False
    for (ax, ay), (bx, by) in zip(corners, corners[1:] + corners[:1], strict=True):
        if not min(ay, by) <= point[1] <= max(ay, by) or max(ax, bx) < point[0]:
            continue
        ax, ay, bx, by = map(Fraction, (ax, ay, bx, by))
        side = (bx - ax) * (y - ay) - (by - ay) * (x - ax)
        if side == 0 and min(ax, bx) <= x <= max(ax, bx) and min(ay, by) <= y <= max(ay, by):
            return True
        if (ay > y) != (by > y) and (side > 0) == (by > ay):
            odd = not odd
    return odd


def star(rng, x, y, size, corners):
    return [(x + size * r * math.cos(t), y + size * r * math.sin(t)) for t, r in (
        (2 * math.pi * k / corners, rng.uniform(0.2, 1.0)) for k in range(corners))]


def shapes():
    rng = random.Random(5)
    found = [(f"s{k}", 0, star(rng, rng.uniform(0, 20), rng.uniform(0, 20), rng.choice([0.3, 3.0, 12.0]), rng.choice([3, 7, 40, 200]))) for k in range(20)]
    found += [(f"q{k}", 0, [(k, k), (k + 8, k), (k + 8, k + 4), (k + 4, k + 4), (k + 4, k + 8), (k, k + 8)]) for k in range(8)]
    found += [(f"t{k}", 0, [(k + 2 * y - 5, k + 3 * y - x) for x, y in ((0, 0), (6, 0), (6, 3), (3, 3), (3, 6), (0, 6))]) for k in range(6)]
    return found


def spots(found):
    rng = random.Random(6)
    near = [(x + rng.choice([0.0, 0.25, 1e-9]), y + rng.choice([0.0, -0.25])) for _, _, ring in found for x, y in ring[:6]]
    middles = [((p[0] + q[0]) / 2, (p[1] + q[1]) / 2) for _, _, ring in found for p, q in zip(ring[:3], ring[1:4], strict=False)]
    return near + middles + [(rng.randrange(88) / 4, rng.randrange(88) / 4) for _ in range(200)] + [(rng.uniform(-1, 22), rng.uniform(-1, 22)) for _ in range(200)]


def points_of(spark, places):
    return step_table(spark.createDataFrame([(i, *p, i % 7) for i, p in enumerate(places)], "id int, px double, py double, v int"), "p")


def test_hits_are_those_of_every_edge(spark, monkeypatch):
    found = shapes()
    layer, places = step_table(spark.createDataFrame(edges(found), COLUMNS), "l"), spots(found)
    points = points_of(spark, places + [(math.nan, 1.0), (None, 1.0)])
    expected = {(i, b) for i, p in enumerate(places) for b, _, ring in found if inside(p, ring)}
    for depth, at_once in ((None, c.PAIRS_AT_ONCE), (4, 50), (0, c.PAIRS_AT_ONCE)):
        if depth is not None:  # cells quartered more often or never, and crowded ones sliced
            monkeypatch.setattr("areaweave.operators.spatial.predicates.depth_for", lambda *_, d=depth: (d, 1e4))
        monkeypatch.setattr(c, "PAIRS_AT_ONCE", at_once)
        rows = [(r.id, r.bdy_id) for r in aw.point_in_polygon_join(points, layer, "id").collect()]
        assert len(rows) == len(set(rows)) and set(rows) == expected
        sums = {r.bdy_id: r.v for r in aw.zonal_sum(points, layer, ["v"], "id").collect()}
        assert sums == {b: sum(i % 7 for i, k in expected if k == b) for b in {b for _, b in expected}}


def test_few_points_meet_edges_and_sums_bring_no_pairs(spark):
    found = [(str(k), 0, [(k, k + 1), (k + 60, k), (k + 61, k + 62), (k, k + 60)]) for k in range(6)]
    rng = random.Random(7)
    points = points_of(spark, [(rng.uniform(0, 70), rng.uniform(0, 70)) for _ in range(20_000)])
    layer = step_table(spark.createDataFrame(edges(found), COLUMNS), "l")
    boxes = _stripped_parts(layer)
    depth, pairs = c.depth_for(points, boxes)
    met = c.points_in_cover(points, _covered(boxes, layer, depth), pairs)
    n = hits(points, layer, "id").count()
    assert met.filter("not clear").count() < 0.4 * n < 0.4 * met.count()
    assert hits(points, layer, "id", sums=["v"]).count() < 0.5 * n


def test_parts_that_overlap_share_their_cells(spark):
    rng = random.Random(8)
    found = [(str(k % 2), k, [(x, y), (x + 8, y), (x + 8, y + 8), (x, y + 8)]) for k, x, y in (
        (k, rng.randrange(80) / 8, rng.randrange(80) / 8) for k in range(60))]
    layer = step_table(spark.createDataFrame(edges(found), COLUMNS), "l")
    places = spots(found)[:1500]
    rows = [(r.id, r.bdy_id) for r in aw.point_in_polygon_join(points_of(spark, places), layer, "id").collect()]
    assert len(rows) == len(set(rows))
    assert set(rows) == {(i, b) for i, p in enumerate(places) for b, _, ring in found if inside(p, ring)}
    every = _covered(_stripped_parts(layer), layer, 3)
    assert c.united(every).count() < every.count() / 5


def test_strips_with_unknown_corners_are_left_whole(spark):
    rows = edges([("1", 0, [(0, 0), (8, 0), (8, 8), (0, 8)])])
    layer = step_table(spark.createDataFrame([*rows, (*rows[0][:6], 3.0, None, 5.0, 9.0)], COLUMNS), "l")
    covered = _covered(_stripped_parts(layer), layer, 3)
    assert covered.filter("clear or held >= 0").isEmpty() and not covered.isEmpty()
    assert {r.id for r in aw.point_in_polygon_join(points_of(spark, [(6.0, 4.0), (9.0, 9.5)]), layer, "id").collect()} == {0}
