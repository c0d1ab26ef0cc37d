"""Shapes of the physical plans, and results under heavy skew."""

import re

import pytest
from conftest import values
from pyspark.sql import functions as F

import areaweave as aw
from workloads import views as v
from workloads.queries import QUERIES


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_python_or_single_partition_window(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text and "InPandas" not in text
    assert not re.search(r"Window \[.*\], \[\], ", text)


def test_counts_are_worked_out_once(spark, sf):
    """The totals reuse the shuffle of the counts they come from."""
    df = QUERIES["same_table_pair"](spark, sf)
    df.collect()
    final = plan(df).split("Initial Plan")[0]
    assert "ReusedExchange" in final and final.count("FileScan") <= 8


def test_columns_and_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "tags")
    spark.range(100).select(F.col("id").alias("u"), *[F.col("id").cast("string").alias(c) for c in "abcdefgh"],
                            F.lit("home").alias("cat")).write.parquet(path)
    registry = aw.Registry.of(aw.Source("t", {c: aw.Boundary(c, c) for c in "abcdefgh"}, unit_id="u", category="cat"))
    rule = aw.Residential({"t": ("home",)})
    text = plan(aw.build_pair({"t": spark.read.parquet(path)}, registry, aw.Pair("t", "a", "t", "b"), rule))
    assert "ReadSchema: struct<a:string,b:string,cat:string>" in text
    assert "IsNotNull(a)" in text and "EqualTo(cat,home)" in text
    pairs = [aw.Pair("t", "a", "t", "b"), aw.Pair("t", "b", "t", "c")]
    text = plan(aw.build_all({"t": spark.read.parquet(path)}, registry, pairs, rule))
    assert "ReadSchema: struct<a:string,b:string,c:string,cat:string>" in text


def test_partial_aggregates_run_before_each_shuffle(spark, sf):
    text = plan(QUERIES["nested_pairs"](spark, sf))
    assert "partial_count" in text and "partial_sum" in text


@pytest.fixture
def small_partitions(spark):
    """Make adaptive execution treat modest partitions as skewed, and never broadcast."""
    settings = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20kb",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20kb",
                "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


def test_hot_from_area_is_split(spark, small_partitions):
    """Half of all rows go out from one area to thousands of others."""
    rows = spark.range(400000).select(
        F.col("id").alias("u"), F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("f"), F.col("id") % 500)).alias("a"),
        F.sha2((F.col("id") % 99991).cast("string"), 256).alias("b"))
    registry = aw.Registry.of(aw.Source("t", {"a": aw.Boundary("a", "a"), "b": aw.Boundary("b", "b")}, unit_id="u"))
    df = aw.build_pair({"t": rows}, registry, aw.Pair("t", "a", "t", "b"))
    total = {r.from_id: r.n for r in df.groupBy("from_id").agg(F.sum("address_count").alias("n")).collect()}
    assert total["hot"] == 200000 and sum(total.values()) == 400000
    df.collect()
    assert "skew=true" in plan(df)


def test_hot_atom_is_split_although_the_tags_lie_by_atom(spark, small_partitions):
    units = spark.range(300000).select(
        F.sha2(F.col("id").cast("string"), 256).alias("u"),
        F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 400).cast("string").alias("mb"))
    cells = spark.range(400).select(F.col("id").cast("string").alias("mb"), (F.col("id") + 0.5).alias("px"), F.lit(0.5).alias("py"))
    edges = aw.edges_from_rings(spark.range(20), "zone", F.col("id"), F.col("id"),
                                F.array(v.box(F.col("id") * 20, F.lit(0), 20)))
    tagged = aw.tag_units(units, cells.select("mb"), edges, ["zone"], "u", "mb", "mb", cells)
    assert len(tagged.collect()) == 300000
    assert "skew=true" in plan(tagged)


def test_crowded_atom_and_polygon(spark, small_partitions):
    """Most points lie in one of many polygons; most units in one atom."""
    points = spark.range(20000).select(
        F.col("id"), F.when(F.col("id") % 3 > 0, 0.5 + (F.col("id") % 997) / 2e4).otherwise(F.col("id") % 90 + 0.5).alias("px"),
        F.lit(0.5).alias("py"))
    cells = spark.range(90)
    edges = aw.edges_from_rings(cells, "cell", F.col("id"), F.col("id"), F.array(v.box(F.col("id"), F.lit(0), 1)))
    hits = aw.point_in_polygon_join(points, edges, "id")
    counts = {r.bdy_id: r.n for r in hits.groupBy("bdy_id").agg(F.count("*").alias("n")).collect()}
    assert sum(counts.values()) == 20000 and counts["0"] > 13000
    units = spark.range(30000).select(F.when(F.col("id") % 3 > 0, "m0").otherwise(F.concat(F.lit("m"), F.col("id") % 50)).alias("mb"))
    atoms = spark.range(50).select(F.concat(F.lit("m"), F.col("id")).alias("mb"), (F.col("id") % 5).cast("string").alias("s1"),
                                   F.lit("all").alias("s2"))
    levels = {"s1": aw.Boundary("s1", "s1"), "s2": aw.Boundary("s2", "s2")}
    got = aw.nested_pairs(atoms, units, "c", "mb", "mb", ["s1", "s2"], levels)
    assert got.agg(F.sum("address_count")).first()[0] == 30000


def test_crosswalk_partitions_by_pair_without_one_task_per_pair(spark, small_partitions, tmp_path):
    """A pair with most rows is written by several tasks."""
    from areaweave.sources import write_crosswalk
    rows = spark.range(40000, numPartitions=8).select(
        F.lit("s").alias("from_source"), F.when(F.col("id") < 39000, "big").otherwise("small").alias("from_bdy"),
        F.col("id").cast("string").alias("from_id"), F.sha2(F.col("id").cast("string"), 256).alias("from_name"),
        F.lit("s").alias("to_source"), F.lit("t").alias("to_bdy"), F.col("id").cast("string").alias("to_id"),
        F.col("id").cast("string").alias("to_name"), F.lit(1).cast("bigint").alias("address_count"),
        F.lit(100).cast("decimal(4,1)").alias("address_percent"))
    path = tmp_path / "cw"
    write_crosswalk(rows, str(path))
    assert len(list(path.glob("from_source=s/from_bdy=big/*/*/part-*"))) > 1
    assert spark.read.parquet(str(path)).count() == 40000


def test_identity_crosswalk_keeps_every_value(spark, sf):
    units = v.cust_units(spark, sf)
    cw = aw.build_pair({"cust": units}, v.REGISTRY, aw.Pair("cust", "nation", "cust", "nation"))
    assert values(aw.score(cw), "concordance_percent") == [(100,)]
    cases = units.groupBy("nation_id").agg(F.count(F.lit(1)).alias("n"))
    assert values(aw.apportion(cases, "nation_id", ["n"], cw), "to_id", "n") == values(cases)


def test_apportioned_total_is_close_to_the_input(spark, sf):
    units = v.cust_units(spark, sf)
    cw = aw.build_pair({"cust": units}, v.REGISTRY, aw.Pair("cust", "nation", "cust", "region"))
    cases = units.groupBy("nation_id").agg(F.count(F.lit(1)).alias("n"))
    carried = aw.apportion(cases, "nation_id", ["n"], cw).agg(F.sum("n")).first()[0]
    assert abs(carried - units.count()) <= 0.01 * units.count()
