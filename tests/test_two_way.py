"""Matches both ways: judged where they are found, and equal to counting all pairs."""

import io
import random
from collections import Counter
from contextlib import redirect_stdout

import areaweave as aw
from areaweave.functions import name_before
from areaweave.operators.spatial.predicates import point_in_polygon_join, point_on_surface
from pyspark.sql import functions as F

COLUMNS = "layer string, bdy_id string, bdy_name string, part_id long, ring_id int, is_hole boolean, x1 double, y1 double, x2 double, y2 double"


def layer(spark, shapes):
    rows = []
    for name, bdy_id, bdy_name, part, x, y, size in shapes:
        corners = [(x, y), (x + size, y), (x + size, y + size / 2), (x + size / 2, y + size), (x, y + size)]
        rows += [(name, bdy_id, bdy_name, part, 0, False, *map(float, (*p, *q))) for p, q in zip(corners, corners[1:] + corners[:1], strict=True)]
    return spark.createDataFrame(rows, COLUMNS)


def counted(layer_a, layer_b):
    points = [point_on_surface(x).select(F.struct("bdy_id", "bdy_name").alias("p"), "px", "py") for x in (layer_a, layer_b)]
    short = name_before(F.col("name")).alias("name")
    b_in_a = point_in_polygon_join(points[1], layer_a, "p").selectExpr("bdy_id as a", "bdy_name as a_name", "p.bdy_id as b", "p.bdy_name as name")
    a_in_b = point_in_polygon_join(points[0], layer_b, "p").selectExpr("p.bdy_id as a", "p.bdy_name as a_name", "bdy_id as b", "bdy_name as name")
    return Counter(map(tuple, b_in_a.union(a_in_b).select("a", "a_name", "b", short).collect()))


def shapes(seed, name, odd):
    rng = random.Random(seed)
    found = [(name, str(i), f"{name} {i} ({i % 3})", 0, rng.randrange(30), rng.randrange(30), rng.choice([2, 4, 8])) for i in range(40)]
    if odd:
        found += [(name, "7", f"{name} 7 (9)", 0, 5, 5, 8), (name, "8", f"{name} 8 (2)", 1, 11, 3, 8), (f"{name}2", "9", f"{name} 9 (0)", 0, 9, 9, 16),
                  (name, "50", None, 0, 4, 4, 16), (name, None, "no id", 0, 3, 3, 20)]
    return found


def test_both_ways_equal_counting_all_pairs(spark):
    for odd_a, odd_b in ((False, False), (True, False), (True, True)):
        a, b = layer(spark, shapes(1, "A", odd_a)), layer(spark, shapes(2, "B", odd_b))
        got = {tuple(r)[:4]: r.match_count for r in aw.two_way_match(a, b).select("a_id", "a_name", "b_id", "b_name", "match_count").collect()}
        assert got == dict(counted(a, b)) and {1, 2} <= set(got.values())


def test_pairs_are_not_shuffled(spark):
    text = io.StringIO()
    with redirect_stdout(text):
        aw.two_way_match(layer(spark, shapes(1, "A", False)), layer(spark, shapes(2, "B", False))).explain()
    assert "hashpartitioning(a_id" not in text.getvalue()
