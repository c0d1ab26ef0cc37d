"""Spatial operators against shapes with known answers and brute force."""

import math
import random
import struct

import pytest
from conftest import multi_wkb, polygon_wkb, square, values
from pyspark.sql import functions as F

import areaweave as aw
from areaweave.operators.spatial import grid, predicates
from areaweave.operators.spatial.layers import RING, parts
from areaweave.operators.spatial.measures import albers
from workloads import views as v

ELL = [(0, 0), (4, 0), (4, 2), (2, 2), (2, 4), (0, 4)]


def layer(spark, shapes, name="l"):
    """Edges of {id: wkb}."""
    df = spark.createDataFrame([(i, f"name {i}", bytearray(w)) for i, w in shapes.items()], "id string, n string, g binary")
    return aw.edges_from_wkb(df, name, F.col("id"), F.col("n"), F.col("g"))


def points(spark, named):
    return spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in named.items()], "p string, px double, py double")


def inside(spark, named, edges):
    return values(aw.point_in_polygon_join(points(spark, named), edges, "p"), "p", "bdy_id")


def star(cx, cy, n, seed, big=10.0):
    """A wavy simple polygon with n corners around a centre."""
    rnd = random.Random(seed)
    return [(cx + r * math.cos(2 * math.pi * i / n), cy + r * math.sin(2 * math.pi * i / n))
            for i in range(n) for r in [rnd.uniform(big / 3, big)]]


def in_ring(x, y, ring):
    odd = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
        if (y1 > y) != (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
            odd = not odd
    return odd


def test_wkb_forms_agree(spark):
    shapes = {"le": polygon_wkb(ELL), "be": polygon_wkb(ELL, order=">"), "srid": polygon_wkb(ELL, srid=4283),
              "multi": multi_wkb([ELL]), "turned": polygon_wkb(ELL[::-1])}
    got = layer(spark, shapes).select("bdy_id", "x1", "y1", "x2", "y2").collect()
    by_id = {}
    for r in got:
        by_id.setdefault(r.bdy_id, set()).add(tuple(r)[1:])
    assert set(by_id) == set(shapes) and len({frozenset(e) for e in by_id.values()}) == 1
    assert len(by_id["le"]) == len(ELL)


def test_wkb_with_height_and_wrong_type(spark):
    flat = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)]
    body = struct.pack("<II", 1, 4) + b"".join(struct.pack("<ddd", x, y, 9.0) for x, y in flat)
    for code in (1003, 3 | 0x80000000):
        edges = layer(spark, {"z": struct.pack("<BI", 1, code) + body})
        assert values(aw.area_by_key(edges), "area") == [(0.5,)]
    with pytest.raises(Exception, match="not a polygon"):
        layer(spark, {"p": struct.pack("<BIdd", 1, 1, 0.0, 0.0)}).collect()


def test_readers_agree(spark):
    hole = square(1, 1, 0.5)
    want = values(layer(spark, {"a": polygon_wkb(ELL, hole)}).drop("bdy_name"))
    vertices = [("l", "a", "a", 0, ring_id, ring_id > 0, i, float(x), float(y))
                for ring_id, ring in enumerate((ELL[::-1], hole)) for i, (x, y) in enumerate([*ring, ring[0]])]
    df = spark.createDataFrame(vertices, "layer string, bdy_id string, bdy_name string, part_id int, ring_id int, "
                                         "is_hole boolean, seq int, x double, y double")
    assert values(aw.edges_from_vertices(df).drop("bdy_name")) == want
    rings = F.array(aw.ring([(F.lit(x), F.lit(y)) for x, y in ELL]),
                    aw.ring([(F.lit(x), F.lit(y)) for x, y in hole], ring_id=1, is_hole=True))
    edges = aw.edges_from_rings(spark.range(1), "l", F.lit("a"), F.lit("a"), rings)
    assert values(edges.drop("bdy_name")) == want
    assert values(aw.area_by_key(edges), "area") == [(11.75,)]


def test_point_in_polygon_on_edges_corners_and_holes(spark):
    edges = layer(spark, {"ell": polygon_wkb(ELL), "ring": polygon_wkb(square(10, 0, 4), square(11, 1, 2))})
    got = inside(spark, {
        "in": (1, 1), "notch": (3, 3), "corner": (2, 2), "tip": (0, 4), "edge": (4, 1), "inner edge": (2, 3),
        "beside": (4.1, 1), "level with corner": (-1, 2), "frame": (10.5, 2), "hole": (12, 2), "hole edge": (11, 2),
        "hole corner": (13, 3), "far": (100, 100)}, edges)
    assert got == sorted([("in", "ell"), ("corner", "ell"), ("tip", "ell"), ("edge", "ell"), ("inner edge", "ell"),
                          ("frame", "ring"), ("hole edge", "ring"), ("hole corner", "ring")], key=repr)


def test_shared_edges_and_parts(spark):
    edges = layer(spark, {"w": polygon_wkb(square(0, 0)), "e": polygon_wkb(square(1, 0)),
                          "both": multi_wkb([square(0, 0)], [square(1, 0)]),
                          "twice": multi_wkb([square(0, 0)], [square(0.2, 0.2)])})
    assert inside(spark, {"m": (1, 0.5), "c": (0.5, 0.5)}, edges) == [
        ("c", "both"), ("c", "twice"), ("c", "w"), ("m", "both"), ("m", "e"), ("m", "twice"), ("m", "w")]


@pytest.mark.parametrize("corners", [5, 60, 1500])
def test_point_in_polygon_against_brute_force(spark, corners):
    rnd = random.Random(corners)
    shapes = {str(i): star(rnd.uniform(-30, 30), rnd.uniform(-30, 30), corners, i, 3.0 ** (i % 4)) for i in range(8)}
    named = {f"p{i}": (rnd.uniform(-40, 40), rnd.uniform(-40, 40)) for i in range(400)}
    got = inside(spark, named, layer(spark, {i: polygon_wkb(s) for i, s in shapes.items()}))
    assert got == sorted([(p, i) for p, (x, y) in named.items() for i, s in shapes.items() if in_ring(x, y, s)], key=repr)


def test_long_edges_in_many_strips(spark):
    # Two long sides and a finely toothed base: most strips hold only the sides.
    teeth = [(i / 100, -0.5 if i % 2 else 0.0) for i in range(1001)]
    shape = [*teeth, (10.0, 500.0), (0.0, 500.0)]
    named = {"high": (5, 499.5), "middle": (9.99, 250), "tooth": (5.0049, -0.4), "gap": (5.01, -0.49), "left": (-0.01, 100),
             "side": (10, 77), "top": (3, 500)}
    got = inside(spark, named, layer(spark, {"s": polygon_wkb(shape)}))
    want = [(p, "s") for p, (x, y) in named.items() if in_ring(x, y, shape) or p in ("side", "top")]
    assert got == sorted(want, key=repr)


def test_strip_copies_stay_bounded(spark):
    comb = [c for i in range(2000) for c in ((i, 0), (i + 0.4, 0), (i + 0.5, 100), (i + 0.9, 100))] + [(2000, -1), (0, -1)]
    edges = layer(spark, {"comb": polygon_wkb([(float(x), float(y)) for x, y in comb])})
    box = parts(edges).withColumn("s", F.expr(predicates.STRIPS))
    row = box.first()
    assert row.s * row.climb / (row.maxy - row.miny) <= row.edge_count


def test_grid_joins_find_every_pair_once(spark):
    rnd = random.Random(3)
    boxes = []
    for i in range(300):
        w, h = rnd.choice([0, 1e-6, 0.5, 3, 80, 1000]), rnd.choice([0, 1e-3, 1, 64, 300])
        x, y = rnd.uniform(-200, 200), rnd.uniform(-200, 200)
        boxes.append((i, float(x), float(y), float(x + w), float(y + h)))
    a = spark.createDataFrame(boxes[:150], "a int, minx double, miny double, maxx double, maxy double")
    b = spark.createDataFrame(boxes[150:], "b int, minx double, miny double, maxx double, maxy double")
    got = values(grid.boxes_in_boxes(a, b, ["a"], ["b"]), "a", "b")
    assert got == sorted([(p[0], q[0]) for p in boxes[:150] for q in boxes[150:]
                          if p[1] <= q[3] and q[1] <= p[3] and p[2] <= q[4] and q[2] <= p[4]], key=repr)
    pts = spark.createDataFrame([(i, b[1], b[2]) for i, b in enumerate(boxes)], "p int, x double, y double")
    got = values(grid.points_in_boxes(pts, b, "x", "y"), "p", "b")
    assert got == sorted([(i, q[0]) for i, p in enumerate(boxes) for q in boxes[150:]
                          if q[1] <= p[1] <= q[3] and q[2] <= p[2] <= q[4]], key=repr)


def test_point_on_surface_is_inside(spark):
    shapes = {str(i): polygon_wkb(star(i * 25, 0, 7 + 40 * i, i)) for i in range(12)}
    shapes["ring"] = polygon_wkb(square(0, 100, 10), square(1, 101, 8))
    shapes["parts"] = multi_wkb([square(0, 200)], [square(50, 200, 30)])
    shapes["ell"] = polygon_wkb([(x - 50, y) for x, y in ELL])
    edges = layer(spark, shapes)
    found = aw.point_on_surface(edges)
    assert found.count() == len(shapes)
    hits = aw.point_in_polygon_join(found.withColumnRenamed("bdy_id", "p"), edges, "p")
    assert hits.filter("p = bdy_id").count() == len(shapes)
    where = {r.bdy_id: (r.px, r.py) for r in found.collect()}
    assert where["parts"] == (65.0, 215.0)  # the widest part
    assert where["ell"] == (-49.0, 3.0)     # clear of the corner halfway up


def test_areas_and_centroids(spark):
    edges = layer(spark, {"ell": polygon_wkb(ELL), "frame": polygon_wkb(square(10, 0, 4), square(11, 1, 2)[::-1]),
                          "two": multi_wkb([square(0, 9)], [square(5, 9, 2)])})
    assert values(aw.area_by_key(edges, ["bdy_id"])) == [("ell", 12.0), ("frame", 12.0), ("two", 5.0)]
    got = {r.bdy_id: (r.px, r.py) for r in aw.centroids(edges).collect()}
    assert got["ell"] == pytest.approx((5 / 3, 5 / 3)) and got["frame"] == pytest.approx((12, 2))
    assert got["two"] == pytest.approx(((0.5 + 4 * 6) / 5, (9.5 + 4 * 10) / 5))
    # A centroid can lie outside its shape; here it is used as a point like any other.
    hits = aw.point_in_polygon_join(aw.centroids(edges).withColumnRenamed("bdy_id", "p"), edges, "p")
    assert values(hits, "p", "bdy_id") == [("ell", "ell")]


def test_albers_keeps_area(spark):
    x, y = albers(F.lit(132.0), F.lit(-25.0))
    row = spark.range(1).select(x.alias("x"), y.alias("y")).first()
    assert row.x == pytest.approx(0) and -2.9e6 < row.y < -2.6e6
    # Area between two parallels over one degree, on the ellipsoid.
    e2 = (1 / 298.257222101) * (2 - 1 / 298.257222101)
    e, b2 = math.sqrt(e2), 6378137.0 ** 2 * (1 - e2)

    def zone(lat):
        s = math.sin(math.radians(lat))
        return s / (1 - e2 * s * s) + math.log((1 + e * s) / (1 - e * s)) / (2 * e)

    steps = [i / 200 for i in range(201)]
    cell = [(140 + t, -30.0) for t in steps] + [(141 - t, -29.0) for t in steps]
    got = aw.area_by_key(aw.project_albers(layer(spark, {"c": polygon_wkb(cell)}))).first().area
    assert got == pytest.approx(b2 * math.radians(1) * (zone(-29) - zone(-30)) / 2, rel=1e-7)


def test_overlap_of_known_shapes(spark):
    a = layer(spark, {"ell": polygon_wkb(ELL), "ring": polygon_wkb(square(10, 0, 12), square(12, 2, 4)),
                      "two": multi_wkb([square(0, 50)], [square(5, 50)]), "away": polygon_wkb(square(900, 900))})
    b = layer(spark, {"sq": polygon_wkb(square(1, 1, 2)), "in hole": polygon_wkb(square(13, 3, 1)),
                      "over hole": polygon_wkb(square(11, 1, 8)), "wide": polygon_wkb(square(-1, 50.5, 20)),
                      "touch": polygon_wkb(square(4, 0, 1)), "corner": polygon_wkb(square(-1, -1, 1)),
                      "tri": polygon_wkb([(0, 0), (4, 0), (0, 4)])}, "m")
    got = {(r.a_id, r.b_id): r for r in aw.overlap(a, b).collect()}
    area = {k: r.area for k, r in got.items()}
    assert area == pytest.approx({("ell", "sq"): 3.0, ("ring", "over hole"): 48.0, ("two", "wide"): 1.0, ("ell", "tri"): 8.0})
    sq = got["ell", "sq"]
    assert (sq.cx, sq.cy) == pytest.approx(((1.5 * 2 + 2.5) / 3, (1.5 * 2 + 2.5) / 3))
    assert (sq.minx, sq.miny, sq.maxx, sq.maxy) == (1, 1, 3, 3)
    report = {(r.a_id, r.b_id): r.area for r in aw.overlap_report(a, b).collect()}
    assert report == pytest.approx({**area, ("ell", "touch"): 0.0, ("ell", "corner"): 0.0})
    assert values(aw.polygons_meet(a, b)) == sorted(report, key=repr)
    percent = {(r.a_id, r.b_id): r.percent_area for r in aw.percent_overlap(a, b).collect()}
    assert percent["two", "wide"] == pytest.approx(50.0)


def clip_area(a, b, n=700):
    """Overlap by sampling rows of a fine grid."""
    xs, ys = [x for x, _ in a], [y for _, y in a]
    x0, x1, y0, y1 = min(xs), max(xs), min(ys), max(ys)
    rnd = random.Random(1)
    hits = sum(in_ring(x, y, a) and in_ring(x, y, b)
               for x, y in ((rnd.uniform(x0, x1), rnd.uniform(y0, y1)) for _ in range(n)))
    return hits / n * (x1 - x0) * (y1 - y0)


def test_overlap_of_wavy_shapes(spark):
    one, two = star(0, 0, 300, 1), star(4, 3, 900, 2)
    a = layer(spark, {"a": polygon_wkb([(x + 1e6, y - 4e6) for x, y in one])})
    b = layer(spark, {"b": polygon_wkb([(x + 1e6, y - 4e6) for x, y in two])})
    got = aw.overlap(a, b).first().area
    assert got == pytest.approx(clip_area(one, two, 20000), rel=0.08)
    # A layer against itself gives its own area, also cut into many strips.
    own = aw.overlap(b, b).first()
    assert own.area == pytest.approx(aw.area_by_key(b).first().area, rel=1e-9)
    centre = aw.centroids(b).first()
    assert (own.cx, own.cy) == pytest.approx((centre.px, centre.py), rel=1e-9)


def test_geometry_diff(spark):
    a = layer(spark, {"same": polygon_wkb(ELL), "moved": polygon_wkb(square(0, 0)), "gone": polygon_wkb(square(5, 5)),
                      "cut": polygon_wkb(square(0, 0, 2))})
    b = layer(spark, {"same": polygon_wkb(ELL[3:] + ELL[:3]), "moved": polygon_wkb(square(7, 7)),
                      "cut": polygon_wkb(square(0, 0, 2, 1.5)), "new": polygon_wkb(square(1, 1))})
    assert values(aw.geometry_diff(a, b), "bdy_id", "overlap_area") == [("cut", 3.0), ("moved", 0.0)]
    assert values(aw.unmatched(a, b)) == [("gone",)] and values(aw.unmatched(b, a)) == [("new",)]


def test_atoms_touching(spark):
    atoms = layer(spark, {f"{i}{j}": polygon_wkb(square(i, j)) for i in range(5) for j in range(5)})
    zones = layer(spark, {"z": polygon_wkb(square(1.2, 1.2, 0.2)), "y": polygon_wkb(square(4, 4)),
                          "x": polygon_wkb(square(0, 0, 5))})
    assert values(aw.atoms_touching(atoms, zones, ["z", "y"])) == sorted(
        [("11", "z"), ("33", "y"), ("34", "y"), ("43", "y"), ("44", "y")], key=repr)


def test_tagging_optional_layers_and_ties(spark):
    named = {"a": (0.5, 0.5), "b": (1, 0.5), "c": (9, 9)}
    layers = layer(spark, {"w": polygon_wkb(square(0, 0)), "e": polygon_wkb(square(1, 0)),
                           "far": polygon_wkb(square(8, 8, 2))}, "must").unionByName(
        layer(spark, {"o": polygon_wkb(square(0, 0, 0.6))}, "may"))
    tags = aw.tag_atoms(points(spark, named), layers, ["must", "may"], "p", optional=["may"])
    assert values(tags, "p", "must_id", "may_id") == sorted(
        [("a", "w", "o"), ("b", "e", None), ("b", "w", None), ("c", "far", None)], key=repr)
    tied = aw.tag_atoms(points(spark, named), layers, ["must", "may"], "p", optional=["may"], tie_break=True)
    assert values(tied, "p", "must_id") == [("a", "w"), ("b", "e"), ("c", "far")]
    strict = aw.tag_atoms(points(spark, named), layers, ["must", "may"], "p")
    assert values(strict, "p") == [("a",)]


def test_two_way_match(spark):
    a = layer(spark, {"1": polygon_wkb(square(0, 0, 4)), "2": polygon_wkb(square(4, 0, 4))})
    b = layer(spark, {"x": polygon_wkb(square(0.5, 0, 4)), "y": polygon_wkb(square(6.5, 0, 1))})
    got = aw.two_way_match(a, b)
    assert values(got, "a_id", "b_id", "match_count") == [("1", "x", 2), ("2", "y", 1)]
    assert values(aw.one_way_matches(got), "a_id") == [("2",)]
    assert aw.name_mismatches(got).count() == 2


def test_zonal_sum_with_attributes(spark):
    pts = points(spark, {"a": (0.5, 0.5), "b": (0.7, 0.7), "c": (5, 5)}).withColumn("v", F.lit(2))
    zones = layer(spark, {"z": polygon_wkb(square(0, 0))})
    states = spark.createDataFrame([("z", "NSW")], "bdy_id string, state string")
    assert values(aw.zonal_sum(pts, zones, ["v"], "p", states)) == [("z", "name z", "NSW", 4)]


def test_collect_parts(spark):
    edges = layer(spark, {"a": polygon_wkb(square(0, 0)), "b": polygon_wkb(square(3, 0))})
    joined = aw.collect_parts(edges.withColumns({"piece": F.ascii("bdy_id"), "bdy_id": F.lit("all")}), "piece").select(
        *RING, "x1", "y1", "x2", "y2")
    assert values(aw.area_by_key(joined, ["bdy_id"])) == [("all", 2.0)]
    assert inside(spark, {"p": (3.5, 0.5), "gap": (2, 0.5)}, joined) == [("p", "all")]


def _layer(spark, name, rows):
    frame = spark.createDataFrame([(i, bytearray(w)) for i, w in rows], "id string, w binary")
    return aw.edges_from_wkb(frame, name, F.col("id"), F.col("id"), F.col("w"))


def test_small_islet_inside_is_found(spark):
    ell = [(0, 0), (10, 0), (10, 5), (5, 5), (5, 10), (0, 10)]
    a = _layer(spark, "a", [("A", polygon_wkb(ell))])
    b = _layer(spark, "b", [("B", multi_wkb([square(7, 7, 2)], [square(1, 1, 1e-4)])), ("C", polygon_wkb(square(6, 6, 3)))])
    assert values(aw.polygons_meet(a, b)) == [("A", "B")]
    assert aw.overlap(a, b).first().area == pytest.approx(1e-8)


def test_rows_of_one_boundary_keep_their_parts(spark):
    both = _layer(spark, "x", [("x", polygon_wkb(square(0, 0, 2))), ("x", polygon_wkb(square(1, 1, 2)))])
    points = spark.createDataFrame([(1, 1.5, 1.5), (1, 1.5, 1.5), (1, 9.0, 9.0)], "pid int, px double, py double")
    assert values(aw.point_in_polygon_join(points, both, "pid"), "pid", "bdy_id") == [(1, "x")]
    apart = _layer(spark, "y", [("y", polygon_wkb(square(0, 0, 2))), ("y", polygon_wkb(square(50, 50, 2)))])
    assert aw.point_on_surface(apart).count() == 1


def test_ids_of_two_layers_stay_apart(spark):
    two = _layer(spark, "l1", [("1", polygon_wkb(square(0, 0)))]).union(_layer(spark, "l2", [("1", polygon_wkb(square(2, 2)))]))
    big = _layer(spark, "z", [("Z", polygon_wkb(square(-5, -5, 20)))])
    assert values(aw.overlap(two, big), "a_layer", "a_id", "area") == [("l1", "1", 1.0), ("l2", "1", 1.0)]


def test_boxes_of_mixed_sizes_meet_once(spark):
    rng = random.Random(4)
    draw = lambda n: [(i, x := rng.uniform(0, 50), y := rng.uniform(0, 50), x + (s := rng.choice([0.3, 2, 40])), y + s)
                      for i in range(n)]
    a, b = draw(60), draw(60)
    frame = lambda rows, key: spark.createDataFrame(rows, f"{key} int, minx double, miny double, maxx double, maxy double")
    got = values(grid.boxes_in_boxes(frame(a, "ka"), frame(b, "kb"), ["ka"], ["kb"]), "ka", "kb")
    assert got == sorted(((p[0], q[0]) for p in a for q in b if p[1] <= q[3] and q[1] <= p[3] and p[2] <= q[4] and q[2] <= p[4]),
                         key=repr)


def test_pairs_of_points_and_shapes_are_not_shuffled(spark):
    """Many points in many shapes at one place: what is found leaves the grid join as it is."""
    pts = spark.range(300).select("id", (F.col("id") % 20 / 10.0).alias("px"), F.lit(0.5).alias("py"), F.lit(2).alias("n"))
    edges = aw.edges_from_rings(spark.range(40), "s", F.col("id"), F.col("id"), F.array(v.box(F.lit(0), F.lit(0), 1)))
    found = aw.point_in_polygon_join(pts, edges, "id")
    text = found._jdf.queryExecution().executedPlan().toString()
    assert text.index("Join") < text.index("Exchange")
    assert found.count() == found.distinct().count() == 300 * 11 // 20 * 40
    sums = aw.zonal_sum(pts, edges, ["n"], "id")
    assert values(sums.select("n").distinct()) == [(330,)]


def test_several_places_of_an_id_and_several_parts_give_one_row(spark):
    pts = spark.createDataFrame([(1, .5, .5, 1), (1, .6, .6, 2), (1, .5, .5, 4), (2, 1., .5, 8), (3, None, .5, 16), (None, .5, .5, 32)],
                                "id int, px double, py double, n int")
    two = F.array(v.box(F.lit(0), F.lit(0), 1), v.box(F.lit(1), F.lit(0), 1, part_id=1))
    edges = aw.edges_from_rings(spark.range(1), "s", F.lit("two"), F.lit("two"), two).unionByName(
        aw.edges_from_rings(spark.range(1), "s", F.lit("one"), F.lit("one"), F.array(v.box(F.lit(0), F.lit(0), 1))))
    got = aw.point_in_polygon_join(pts, edges, "id").select("id", "bdy_id")
    assert sorted(got.collect(), key=repr) == sorted(
        [(i, b) for i in (1, 2, None) for b in ("one", "two")], key=repr)
    assert values(aw.zonal_sum(pts, edges, ["n"], "id"), "bdy_id", "n") == [("one", 15), ("two", 15)]


def test_large_parts_meet_points_by_edge(spark, monkeypatch):
    """The path of parts that do not fit a row gives the same."""
    comb = [(0, 0)] + [p for i in range(30) for p in ((30 - i, 0.0), (30 - i - 0.5, 10.0))]
    edges = aw.edges_from_wkb(spark.createDataFrame([("c", polygon_wkb(comb)), ("q", polygon_wkb(square(0, 0, 9)))], "k string, g binary"),
                              "l", F.col("k"), F.col("k"), F.col("g"))
    pts = spark.range(400).select("id", (F.col("id") % 61 / 2.0).alias("px"), (F.col("id") % 13).cast("double").alias("py"))
    one = values(aw.point_in_polygon_join(pts, edges, "id"))
    monkeypatch.setattr(predicates, "EDGES_IN_ROW", 10)
    assert one and values(aw.point_in_polygon_join(pts, edges, "id")) == one
