"""Exact sides, overlaps decided by how boundaries meet, and equality of shapes, against rational arithmetic."""

import itertools
import math
import random
from fractions import Fraction

import pytest
from conftest import multi_wkb, polygon_wkb, square, values
from pyspark.sql import functions as F

import areaweave as aw
from areaweave.operators.spatial.exact import side_of, sign_of_sum
from areaweave.operators.spatial.grid import points_in_boxes, spans_meet
from areaweave.operators.spatial.predicates import edge_pairs, named, part_pairs, stored_parts
from areaweave.sources.steps import step_table
from workloads import views as v


def layer(spark, shapes, name="l"):
    df = spark.createDataFrame([(i, f"name {i}", bytearray(w)) for i, w in shapes.items()], "id string, n string, g binary")
    return step_table(aw.edges_from_wkb(df, name, F.col("id"), F.col("n"), F.col("g")), "layer")


def side(a, b, c):
    (ax, ay), (bx, by), (cx, cy) = [tuple(map(Fraction, p)) for p in (a, b, c)]
    d = (bx - ax) * (cy - ay) - (by - ay) * (cx - ax)
    return (d > 0) - (d < 0)


def test_sides_are_those_of_rational_arithmetic(spark):
    rng = random.Random(1)
    rows = []
    for _ in range(3_000):
        far = rng.choice([1.0, 1e6, 1e-3])
        a = (rng.uniform(-far, far), rng.uniform(-far, far))
        b = (a[0] + rng.uniform(-1, 1), a[1] + rng.uniform(-1, 1))
        t = rng.choice([0.0, 0.5, 1.0, rng.random(), 3.0])
        c = [a[0] + t * (b[0] - a[0]), a[1] + t * (b[1] - a[1])]
        for k in (0, 1):  # a few steps off the line, or none
            for _ in range(rng.choice([0, 0, 1, 2])):
                c[k] = math.nextafter(c[k], rng.choice([-math.inf, math.inf]))
        rows.append((*a, *b, *c))
    rows += [(i / 10, j / 10, 0.7, 0.1, k / 10, 0.3) for i in range(8) for j in range(8) for k in range(8)]
    frame = spark.createDataFrame(rows, "ax double, ay double, bx double, by double, cx double, cy double")
    got = frame.withColumn("side", F.expr(side_of(("ax", "ay"), ("bx", "by"), ("cx", "cy")))).collect()
    assert [r.side for r in got] == [side(r[:2], r[2:4], r[4:6]) for r in rows]
    assert {0, 1, -1} == {r.side for r in got}


def test_exact_sign_of_products(spark):
    rng = random.Random(2)
    rows = []
    for _ in range(500):
        values_ = [rng.uniform(-1, 1) * 2.0 ** rng.randrange(-40, 40) for _ in range(6)]
        values_[4], values_[5] = rng.choice([(values_[0], -values_[1]), (values_[4], values_[5])])
        rows.append(tuple(values_))
    frame = spark.createDataFrame(rows, ", ".join(f"v{i} double" for i in range(6)))
    got = frame.select(F.expr(sign_of_sum([("v0", "v1"), ("v2", "v3"), ("v4", "v5")])).alias("s")).collect()
    for r, g in zip(rows, got, strict=True):
        v = list(map(Fraction, r))
        d = v[0] * v[1] + v[2] * v[3] + v[4] * v[5]
        assert g.s == (d > 0) - (d < 0)


def cut(ring, a, b, c):
    """A convex ring of rational corners cut by the half-plane a x + b y <= c."""
    out = []
    for p, q in zip(ring, ring[1:] + ring[:1]):
        dp, dq = (a * x + b * y - c for x, y in (p, q))
        if dp <= 0:
            out.append(p)
        if dp * dq < 0:
            t = dp / (dp - dq)
            out.append((p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1])))
    return out


def shared(one, two):
    """Exact area that two convex anticlockwise rings share, and whether they share a point."""
    ring = [tuple(map(Fraction, p)) for p in one]
    for p, q in zip(two, two[1:] + two[:1]):
        (px, py), (qx, qy) = tuple(map(Fraction, p)), tuple(map(Fraction, q))
        ring = cut(ring, qy - py, px - qx, (qy - py) * px + (px - qx) * py)
    area = sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(ring, ring[1:] + ring[:1])) / 2 if ring else 0
    return area, bool(ring)


def turned(ring):
    area = sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(ring, ring[1:] + ring[:1]))
    return ring if area > 0 else ring[::-1]


def test_triangles_that_share_corners_and_slanted_edges(spark):
    rng = random.Random(3)
    spots = [(rng.randrange(12) / 10 + 150.1, rng.randrange(12) / 10 - 33.7) for _ in range(40)]
    def triangle():
        while True:
            t = rng.sample(spots, 3)
            if side(*t):
                return turned(t)
    a, b = ({f"{k}{i}": triangle() for i in range(45)} for k in "ab")
    la, lb = (layer(spark, {i: polygon_wkb(t) for i, t in x.items()}) for x in (a, b))
    expected = {(i, j): shared(s, t) for (i, s), (j, t) in itertools.product(a.items(), b.items())}
    got = {(r.a_id, r.b_id): r.area for r in aw.overlap(la, lb).collect()}
    assert set(got) == {k for k, (area, _) in expected.items() if area > 0}
    assert min(got.values()) > 0
    for k, area in got.items():
        assert area == pytest.approx(float(expected[k][0]), rel=1e-6, abs=1e-12)
    touching = {(i, j) for (i, j), (_, meet) in expected.items() if meet}
    assert set(values(aw.polygons_meet(la, lb))) == touching and len(touching) > len(got)
    report = aw.overlap_report(la, lb).collect()
    assert {(r.a_id, r.b_id) for r in report} == touching
    assert all((r.area > 0) == ((r.a_id, r.b_id) in got) for r in report)
    percents = aw.percent_overlap(la, lb).collect()
    assert {(r.a_id, r.b_id) for r in percents} == set(got) and all(r.percent_area > 0 for r in percents)


def test_triangles_that_touch_at_a_corner_on_a_slanted_edge(spark):
    rng = random.Random(4)
    a, b = {}, {}
    for i in range(60):
        x, y, dx, dy = rng.uniform(-5, 5), rng.uniform(-5, 5), 2 * rng.randrange(1, 9), 2 * rng.randrange(1, 9)
        a[str(i)] = [(0, 0), (dx, 0), (0, dy)]
        b[str(i)] = [(dx / 2, dy / 2), (dx + 3 + abs(x), dy + 1), (dx + 1, dy + 4 + abs(y))]
    for (i, s), (j, t) in zip(a.items(), b.items()):
        assert shared(s, turned(t)) == (0, True)
    la, lb = (layer(spark, {i: polygon_wkb(t) for i, t in x.items()}) for x in (a, b))
    assert aw.overlap(la, lb, same_id=True).count() == 0
    meeting = set(values(aw.polygons_meet(la, lb)))
    assert all((i, i) in meeting for i in a)


def test_slanted_squares_inside_at_corners_and_along_edges(spark):
    # A square, the diamond between the middles of its sides, its own copy, a hole's filling, and neighbours.
    big = [(0.0, 0.0), (8.0, 2.0), (6.0, 10.0), (-2.0, 8.0)]
    mids = [tuple((u + v) / 2 for u, v in zip(p, q)) for p, q in zip(big, big[1:] + big[:1])]
    across = [(8.0, 2.0), (16.0, 4.0), (14.0, 12.0), (6.0, 10.0)]
    notch = [(0.0, 0.0), (8.0, 2.0), (3.0, 5.0), (6.0, 10.0), (-2.0, 8.0)]
    thin = [(3.0, 5.0), (7.0, 3.5), (6.0, 7.0)]
    a = layer(spark, {"big": polygon_wkb(big), "ring": polygon_wkb(big, mids), "notch": polygon_wkb(notch)})
    b = layer(spark, {"mids": polygon_wkb(mids), "copy": polygon_wkb(big[2:] + big[:2]), "across": polygon_wkb(across),
                      "tip": polygon_wkb([(-2.0, 8.0), (-3.0, 9.0), (-4.0, 8.0)]), "thin": polygon_wkb(thin)}, "m")
    got = {(r.a_id, r.b_id): r.area for r in aw.overlap(a, b).collect()}
    lost = shared(mids, turned([(8.0, 2.0), (6.0, 10.0), (3.0, 5.0)]))[0]
    assert got == pytest.approx({
        ("big", "mids"): 34, ("big", "copy"): 68, ("big", "thin"): 6.25, ("ring", "copy"): 34,
        ("ring", "thin"): 6.25 - float(shared(mids, turned(thin))[0]), ("notch", "copy"): 51, ("notch", "mids"): 34 - float(lost)})
    touching = {("big", "across"), ("big", "tip"), ("ring", "mids"), ("ring", "across"), ("ring", "tip"), ("notch", "across"),
                ("notch", "tip"), ("notch", "thin")}
    assert set(values(aw.polygons_meet(a, b))) == set(got) | touching


def test_equality_has_no_tolerance(spark):
    rng = random.Random(6)
    base = {str(i): [(x := rng.uniform(-99, 99), y := rng.uniform(-99, 99)), (x + 7.3, y + 1.1), (x + 5.9, y + 8.7), (x - 2.2, y + 6.1)]
            for i in range(30)}
    a = {i: polygon_wkb(r) for i, r in base.items()}
    same = layer(spark, {i: polygon_wkb((r[1:] + r[:1])[::-1]) for i, r in base.items()}, "m")
    assert aw.geometry_diff(layer(spark, a), same).count() == 0
    moved = dict(base)
    moved["3"] = [(math.nextafter(x, 1e9), y) if k == 2 else (x, y) for k, (x, y) in enumerate(base["3"])]
    b = {i: polygon_wkb(r) for i, r in moved.items()}
    b["5"] = multi_wkb([base["5"]], [square(500, 500, 1e-4)])
    assert values(aw.geometry_diff(layer(spark, a), layer(spark, b, "m")), "bdy_id") == [("3",), ("5",)]


def test_equality_of_shapes_cut_otherwise(spark):
    # Further corners along slanted edges, two halves against a whole, and one piece missing.
    whole = [(0.0, 0.0), (9.0, 3.0), (9.0, 13.0), (0.0, 10.0)]
    extra = [(0.0, 0.0), (3.0, 1.0), (6.0, 2.0), (9.0, 3.0), (9.0, 13.0), (3.0, 11.0), (0.0, 10.0), (0.0, 4.0)]
    halves = [[(0.0, 0.0), (3.0, 1.0), (3.0, 11.0), (0.0, 10.0)]], [[(3.0, 1.0), (9.0, 3.0), (9.0, 13.0), (6.0, 12.0), (3.0, 11.0)]]
    dent = [(0.0, 0.0), (9.0, 3.0), (9.0, 13.0), (3.0, 11.0), (3.0, 10.5), (0.0, 10.0)]
    a = layer(spark, {"more": polygon_wkb(whole), "half": polygon_wkb(whole), "dent": polygon_wkb(whole), "hole": polygon_wkb(whole)})
    b = layer(spark, {"more": polygon_wkb(extra), "half": multi_wkb(*halves), "dent": polygon_wkb(dent),
                      "hole": polygon_wkb(whole, square(4, 5, 0.5))}, "m")
    assert values(aw.geometry_diff(a, b), "bdy_id") == [("dent",), ("hole",)]
    assert values(aw.geometry_diff(b, a), "bdy_id") == [("dent",), ("hole",)]


def test_parts_under_one_id_meet_by_cell(spark):
    n = 60
    frame = lambda off: spark.range(n * n).select(F.lit("k").alias("id"), (F.col("id") % n + off).alias("x"),
                                                  F.floor(F.col("id") / n).alias("y"), F.col("id").alias("part"))
    def edges(df):
        corners = [(F.col("x") + dx, F.col("y") + dy) for dx, dy in ((0, 0), (0.5, 0), (0.5, 0.5), (0, 0.5))]
        return aw.edges_from_rings(df, "l", F.col("id"), F.col("id"), F.array(aw.ring(corners, part_id=F.col("part"))))
    a, b = edges(frame(0)), edges(frame(0.25))
    pairs = part_pairs(stored_parts(a), stored_parts(b), spark.createDataFrame([("k", "k")], "a_id string, b_id string"))
    assert pairs.count() == n * n
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert aw.overlap(a, b, same_id=True).first().area == pytest.approx(n * n * 0.125)
    assert values(aw.geometry_diff(a, b), "bdy_id") == [("k",)] and aw.geometry_diff(a, a).count() == 0


def test_wanted_pairs_bound_the_work(spark):
    a = layer(spark, {str(i): polygon_wkb(square(0, 0, 10 + i)) for i in range(40)})
    wanted = spark.createDataFrame([("3", "5"), ("9", "1"), ("7", "nowhere")], "a_id string, b_id string")
    sizes = stored_parts(a)
    pairs = part_pairs(sizes, sizes, wanted)
    assert values(pairs, "a_id", "b_id") == [("3", "5"), ("9", "1")]
    assert edge_pairs(pairs, named(a, sizes, "a"), named(a, sizes, "b")).select("a_id").distinct().count() == 2
    assert values(aw.overlap(a, a, wanted=wanted), "a_id", "b_id", "area") == [("3", "5", 169.0), ("9", "1", 121.0)]


def test_spans_meet_once(spark):
    rng = random.Random(7)
    def spans(k):
        out = []
        for i in range(120):
            key, top = rng.randrange(3), None
            first = rng.randrange(64)
            out.append((key, 6, f"{k}{i}", first, min(63, first + rng.choice([0, 0, 1, 5, 40, 63]))))
        return out
    a, b = spans("a"), spans("b")
    fa = spark.createDataFrame(a, "k int, top int, a string, a_first long, a_last long")
    fb = spark.createDataFrame(b, "k int, top int, b string, b_first long, b_last long")
    got = values(spans_meet(fa, fb, ["k"], "top"), "a", "b")
    assert got == sorted(((p[2], q[2]) for p in a for q in b if p[0] == q[0] and p[3] <= q[4] and q[3] <= p[4]), key=repr)


def comb(teeth, width=100.0):
    """A ring whose long level teeth all run from end to end."""
    points = []
    for i in range(teeth):
        points += [(0.0, 2.0 * i), (width, 2.0 * i), (width, 2.0 * i + 1), (1.0, 2.0 * i + 1)]
    return [*points, (1.0, 2.0 * teeth), (-1.0, 2.0 * teeth), (-1.0, 0.0)]


def test_long_edges_are_not_copied_into_every_band(spark):
    sizes = {}
    for teeth in (200, 800):
        a = layer(spark, {"comb": polygon_wkb(comb(teeth))})
        b = layer(spark, {"sq": polygon_wkb(square(40, 3, 6))})
        pa, pb = stored_parts(a), stored_parts(b)
        sizes[teeth] = edge_pairs(part_pairs(pa, pb), named(a, pa, "a"), named(b, pb, "b")).count()
        assert aw.overlap(a, b).first().area == pytest.approx(18)
    assert sizes[800] <= 4.2 * sizes[200]


def test_points_meet_boxes_of_their_key(spark):
    boxes = spark.createDataFrame([("k", 1, 0.0, 0.0, 2.0, 2.0), ("l", 2, 0.0, 0.0, 2.0, 2.0)],
                                  "k string, b int, minx double, miny double, maxx double, maxy double")
    points = spark.createDataFrame([("k", 1.0, 1.0), ("m", 1.0, 1.0)], "k string, x double, y double")
    assert values(points_in_boxes(points, boxes, "x", "y", on=["k"]), "k", "b") == [("k", 1)]


def test_features_of_one_boundary(spark):
    rows = [("x", "f1", polygon_wkb(square(0, 0, 2))), ("x", "f2", polygon_wkb(square(1, 1, 2))),
            ("y", None, multi_wkb([square(5, 5)], [square(7, 7)]))]
    df = spark.createDataFrame([(i, f, bytearray(w)) for i, f, w in rows], "id string, f string, g binary")
    edges = aw.edges_from_wkb(df, "l", F.col("id"), F.col("id"), F.col("g"), feature=F.col("f"))
    assert values(edges.select("bdy_id", "feature", "part_id").distinct()) == sorted(
        [("x", "f1", 0), ("x", "f2", 1), ("y", None, 0), ("y", None, 1)], key=repr)
    points = spark.createDataFrame([(1, 1.5, 1.5), (2, 0.5, 0.5), (3, 7.5, 7.5)], "p int, px double, py double")
    assert values(aw.point_in_polygon_join(points, edges, "p"), "p", "bdy_id") == [(1, "x"), (2, "x"), (3, "y")]
    named_edges = aw.polygons_meet(edges, edges, names=True).filter("a_id = 'x'").first()
    assert (named_edges.a_layer, named_edges.a_name, named_edges.b_name) == ("l", "x", "x")


def test_pairs_of_small_parts_are_not_moved(spark):
    """What follows from two boxes that meet stays where they met, up to the pair's row."""
    n = 8
    a = aw.edges_from_rings(spark.range(n), "a", F.col("id"), F.col("id"), F.array(v.box(F.col("id") * 2, F.lit(0), 3)))
    b = aw.edges_from_rings(spark.range(n), "b", F.col("id"), F.col("id"), F.array(v.box(F.col("id") * 3, F.lit(1), 6)))
    found = aw.overlap_report(v.slanted(a), v.slanted(b))
    text = found._jdf.queryExecution().executedPlan().toString()
    above = text[:min(text.index(join) for join in ("SortMergeJoin", "BroadcastHashJoin") if join in text)]
    assert "Generate inline" in above and "Exchange" not in above and "SortAggregate" not in above
    shared = {(str(i), str(j)): min(2 * i + 3, 3 * j + 6) - max(2 * i, 3 * j) for i in range(n) for j in range(n)}
    assert {(r.a_id, r.b_id): round(r.area, 9) for r in found.collect()} == {k: 2.0 * x for k, x in shared.items() if x >= 0}
