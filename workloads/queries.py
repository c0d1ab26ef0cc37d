"""One Spark query per operator, over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import areaweave as aw
from areaweave import Boundary, Override
from areaweave.functions import release_version, strip_prefix
from areaweave.sources.steps import step_table
from workloads import views as v

NATION_SEGMENT = v.PAIRS[0]
CROSS = v.PAIRS[2]
TWO_SIDED = aw.Residential({"cust": ("1-URGENT", "2-HIGH", "3-MEDIUM"), "supp": ("1-URGENT", "2-HIGH")})
OVERRIDES_ALWAYS = (Override("ASIA", "T-ASIA", "Unincorporated - ASIA"),)
OVERRIDES_MISSING = (Override("3", "T-3", "Fix three"), Override("7", "T-7", "Fix seven"),
                     Override("3", "T-LATE", "Never used"), Override("11", "T-11", "Fix eleven"))


def build_pair(spark: SparkSession, sf: str) -> DataFrame:
    return aw.build_pair(v.tables(spark, sf), v.REGISTRY, NATION_SEGMENT, v.RESIDENTIAL)


def build_pair_cross_source(spark, sf):
    return aw.build_pair(v.tables(spark, sf), v.REGISTRY, CROSS, v.RESIDENTIAL)


def build_pair_by_flag(spark, sf):
    flags = v.read(spark, sf, "orders").select(
        F.col("o_orderkey").alias("unit_id"),
        F.expr("case when o_orderstatus = 'O' then true when o_orderstatus = 'F' then false end")
        .alias("is_residential"))
    return aw.build_pair(v.tables(spark, sf), v.REGISTRY, CROSS, aw.Residential(by_flag=True), flags)


def build_pair_two_sided_filter(spark, sf):
    registry = aw.Registry.of(
        aw.Source("cust", v.REGISTRY["cust"].boundaries, unit_id="unit_id", category="category"), v.REGISTRY["supp"])
    return (aw.build_pair_for(v.tables(spark, sf), registry, CROSS, ["3", "8"], TWO_SIDED)
            .withColumn("percent", F.round("percent", 6)))


def build_all(spark, sf):
    units = v.read(spark, sf, "orders").select(F.col("o_orderkey").alias("unit_id"))
    return aw.build_all(v.tables(spark, sf), v.REGISTRY, v.PAIRS, v.RESIDENTIAL, units=units)


def build_all_from_atoms(spark, sf):
    atoms = v.read(spark, sf, "customer").join(
        v.places(spark, sf), F.col("c_nationkey") == F.col("n_nationkey")).withColumnRenamed("c_mktsegment", "segment")
    units = v.read(spark, sf, "orders").select(F.col("o_orderkey").alias("unit_id"), "o_custkey")
    return aw.build_all_from_atoms(
        units, "unit_id", {"cust": aw.AtomTags(atoms, "c_custkey", "o_custkey")},
        {"supp": v.supp_units(spark, sf), "part": v.part_units(spark, sf)}, v.REGISTRY, v.PAIRS, v.RESIDENTIAL)


LEVELS = {
    "atom": Boundary("c_custkey", "c_name"),
    "nation": Boundary("nation_id", "nation_name"),
    "region": Boundary("region_id", "region_name"),
}


def nested_pairs(spark, sf):
    atoms = v.read(spark, sf, "customer").join(v.places(spark, sf), F.col("c_nationkey") == F.col("n_nationkey"))
    return aw.nested_pairs(atoms, v.read(spark, sf, "orders"), "cust", "c_custkey", "o_custkey", list(LEVELS), LEVELS)


def same_table_pair(spark, sf):
    units = v.cust_units(spark, sf).withColumn("segment_id", F.nullif("segment", F.lit("BUILDING")))
    return (aw.same_table_pair(units, "cust segment", "segment_id", "segment_id",
                               "cust nation", "nation_id", "nation_name")
            .withColumn("percent_from_addresses", F.round("percent_from_addresses", 6)))


def legacy_pair_overrides(spark, sf):
    units = v.cust_units(spark, sf).select(
        F.col("segment").alias("source_id"), F.concat_ws("", "region_name", F.lit(" "), "segment").alias("source_name"),
        F.col("region_name").alias("source_state"),
        F.expr("case when cast(nation_id as int) % 4 <> 3 then nation_id end").alias("target_id"),
        F.col("nation_name").alias("target_name"), F.col("region_name").alias("target_state"),
        F.col("nation_id").alias("locality_pid"))
    return aw.legacy_pair(units, "cust segment", "cust nation", OVERRIDES_ALWAYS, OVERRIDES_MISSING)


def score(spark, sf):
    return aw.score(build_all(spark, sf))


def error_rate(spark, sf):
    return aw.error_rate(_inside_cust(spark, sf), v.indicators(spark, sf), "cust", ("atom", "nation", "region"))


def _inside_cust(spark, sf):
    """All woven pairs and all nested ones."""
    return build_all(spark, sf).unionByName(nested_pairs(spark, sf))


def score_with_error(spark, sf):
    return aw.score_with_error(_inside_cust(spark, sf), v.indicators(spark, sf), "cust", ("atom", "nation", "region"))


def weighted_percent_by_id(spark, sf):
    return (aw.weighted_percent_by_id(build_pair(spark, sf))
            .withColumn("weighted_percent", F.round("weighted_percent", 6))
            .withColumn("weighted_address_count", F.col("weighted_address_count").cast("double")))


def _cases(spark, sf):
    return v.cust_units(spark, sf).groupBy("nation_id").agg(F.sum("price").alias("cases"))


def _slice(spark, sf):
    return aw.slice_pair(build_all(spark, sf), NATION_SEGMENT)


def apportion(spark, sf):
    return aw.apportion(_cases(spark, sf), "nation_id", ["cases"], build_pair(spark, sf))


def rate(spark, sf):
    tests = (v.cust_units(spark, sf).groupBy("segment")
             .agg((F.sum("price") * 2).cast("bigint").alias("tests")))
    return aw.rate(apportion(spark, sf), "cases", tests, "segment", "tests", "infection_rate_percent")


def slice_pair(spark, sf):
    return _slice(spark, sf)


def lookup(spark, sf):
    found = aw.lookup(build_all(spark, sf), from_ids=["3", "11"], below_percent=30, from_bdy="nation")
    return found.select("from_id", "to_bdy", "to_id", "to_name", "address_count", "address_percent")


def compare_official(spark, sf):
    units = v.cust_units(spark, sf)
    # Another count of the same units: finished ones weigh twice.
    counts = (units.groupBy(F.col("nation_id").alias("sa2_maincode_2016"), F.col("segment").alias("sa2_code_2021"))
              .agg(F.sum(F.when(F.col("status") == "F", 2).otherwise(1)).alias("n")))
    totals = counts.groupBy("sa2_maincode_2016").agg(F.sum("n").alias("total"))
    official = counts.join(totals, "sa2_maincode_2016").withColumn("ratio_from_to", F.col("n") / F.col("total"))
    # Ids go by five names here, so take the percent of the id as a whole.
    whole = (v.tables(spark, sf)["cust"].withColumn("region_name", F.lit("all")))
    cw = aw.build_pair({"cust": whole}, v.REGISTRY, NATION_SEGMENT)
    return (aw.compare_official(cw, official).withColumn("threshold", F.lit(0))
            .unionByName(aw.compare_official(cw, official, 2.0).withColumn("threshold", F.lit(2))))


def rollup_indicator(spark, sf):
    raw = (v.read(spark, sf, "events").groupBy(F.to_date("ts").alias("notification_date"), "event_type")
           .agg(F.count(F.lit(1)).alias("confirmed_cases_count")))
    return aw.rollup_indicator(raw, "event_type", "confirmed_cases_count", "EVT", "cases")


def residential_flags(spark, sf):
    zones = aw.building_zones(v.building_address(spark, sf), v.zones(spark, sf))
    categories = v.atom_categories(spark, sf)
    return aw.residential_units(v.addresses(spark, sf), categories, categories, zones, keep=("state",))


def reconcile(spark, sf):
    units = v.read(spark, sf, "orders").select(F.col("o_orderkey").alias("gnaf_pid"))
    # Seventh lines stand at addresses that no order has.
    buildings = v.read(spark, sf, "lineitem").select(
        F.expr("if(l_linenumber = 7, -l_orderkey, l_orderkey)").alias("address_detail_pid"),
        F.col("l_partkey").alias("building_pid"), "l_returnflag").withColumn(
        "is_residential", F.expr("case l_returnflag when 'A' then 'Yes' when 'R' then 'No' end"))
    return aw.reconcile(units, buildings)


def category_disagreement(spark, sf):
    units = v.read(spark, sf, "orders").join(v.read(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    labelled = units.select(
        F.expr("case when o_orderpriority < '3' then 'residential' when o_orderpriority < '5' then 'commercial' end")
        .alias("is_residential"),
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", "residential").otherwise("commercial").alias("mb_category_2021"),
        F.col("o_custkey").alias("mb_2021_code"))
    return aw.category_disagreement(labelled, "is_residential", "mb_category_2021", "mb_2021_code", "residential")


def unit_profile(spark, sf):
    return aw.unit_profile(residential_flags(spark, sf), ["is_residential", "mb_category_2021", "state"])


def unit_profile_topk(spark, sf):
    units = v.cust_units(spark, sf).withColumn("segment_id", F.nullif("segment", F.lit("BUILDING")))
    return aw.unit_profile(units, ["region_name", "nation_name", "segment_id", "status"],
                           F.col("category").isin("1-URGENT", "2-HIGH"), 50)


def release_versions(spark, sf):
    return (v.read(spark, sf, "orders").groupBy(release_version(F.col("o_orderdate")).alias("release"))
            .agg(F.count(F.lit(1)).alias("order_count"))
            .select(F.col("release.current").alias("current_release"),
                    F.col("release.previous").alias("previous_release"), "order_count"))


def duplicate_keys(spark, sf):
    return aw.duplicate_keys(v.read(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def duplicate_names(spark, sf):
    return aw.duplicate_keys(build_all(spark, sf), list(aw.config.KEY_COLUMNS))


def null_violations(spark, sf):
    units = v.cust_units(spark, sf).withColumn("segment_id", F.nullif("segment", F.lit("BUILDING")))
    return aw.null_violations(units, ["unit_id", "nation_id", "segment_id"])


def dropped_units(spark, sf):
    return aw.dropped_units(v.cust_units(spark, sf).select("unit_id", "status"), v.supp_units(spark, sf), "unit_id")


def row_parity(spark, sf):
    return aw.row_parity(v.cust_units(spark, sf), v.supp_units(spark, sf), "unit_id")


def percent_totals(spark, sf):
    return aw.percent_totals(build_all(spark, sf), by=("from_bdy", "to_bdy", "from_id", "from_name"))


def pip_join(spark, sf):
    return aw.point_in_polygon_join(v.atom_points(spark, sf), v.supplier_ells(spark, sf), "atom_id")


def pip_join_parts_and_holes(spark, sf):
    layers = v.region_blocks(spark, sf).unionByName(v.supplier_frames(spark, sf)).unionByName(
        v.nation_frames(spark, sf))
    return aw.point_in_polygon_join(v.atom_points(spark, sf), layers, "atom_id").drop("bdy_name")


def _three_layers(spark, sf):
    return (v.nation_squares(spark, sf).unionByName(v.nation_ells(spark, sf))
            .unionByName(v.region_blocks(spark, sf)))


def tag_units(spark, sf):
    units = v.read(spark, sf, "orders").select("o_orderkey", "o_custkey")
    atoms = v.read(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("atom_id"), "c_mktsegment")
    points = v.atom_points(spark, sf).withColumn("atom_id", F.col("atom_id").cast("string"))
    return aw.tag_units(units, atoms, _three_layers(spark, sf), ["square", "block", "ell"], "o_orderkey", "o_custkey",
                        "atom_id", points, optional=["ell"], unit_atom_length=11)


def tag_units_tie_break(spark, sf):
    units = v.read(spark, sf, "orders").select("o_orderkey", "o_custkey")
    atoms = v.read(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("atom_id"), "c_mktsegment")
    points = v.atom_points(spark, sf).withColumn("atom_id", F.col("atom_id").cast("string"))
    return aw.tag_units(units, atoms, _three_layers(spark, sf), ["square", "ell"], "o_orderkey", "o_custkey",
                        "atom_id", points, optional=["ell"], tie_break=True)


def tag_units_from_shapes(spark, sf):
    units = v.read(spark, sf, "orders").select("o_orderkey", "o_custkey")
    layers = _three_layers(spark, sf).unionByName(v.atom_squares(spark, sf))
    atoms = v.read(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("atom_id"), "c_mktsegment")
    return aw.tag_units(units, atoms, layers, ["square", "ell"], "o_orderkey", "o_custkey", "atom_id",
                        optional=["ell"])


def zonal_sum(spark, sf):
    return aw.zonal_sum(v.atom_points(spark, sf), v.supplier_ells(spark, sf), ["balance"], "atom_id")


def point_on_surface_inside(spark, sf):
    shapes = (v.supplier_frames(spark, sf).unionByName(v.supplier_ells(spark, sf))
              .unionByName(v.region_blocks(spark, sf)).unionByName(v.nation_frames(spark, sf)))
    points = aw.point_on_surface(shapes).select(F.struct("layer", "bdy_id").alias("p"), "px", "py")
    hits = aw.point_in_polygon_join(points, shapes, "p")
    return hits.filter("p.layer = layer and p.bdy_id = bdy_id").select("layer", "bdy_id")


def two_way_match(spark, sf):
    return aw.two_way_match(v.supplier_ells(spark, sf), v.atom_squares(spark, sf))


def name_mismatches(spark, sf):
    return aw.name_mismatches(aw.one_way_matches(aw.two_way_match(v.nation_squares(spark, sf), v.atom_squares(spark, sf))))


def area_by_key(spark, sf):
    return (aw.area_by_key(v.supplier_frames(spark, sf), ["bdy_name"])
            .select(F.col("bdy_name").alias("nation_id"), F.round("area", 6).alias("area")))


def area_from_vertices(spark, sf):
    return aw.area_by_key(aw.edges_from_vertices(v.supplier_vertices(spark, sf)), ["bdy_id"])


def strip_code_prefix(spark, sf):
    return v.read(spark, sf, "customer").select("c_custkey", strip_prefix(F.col("c_name"), 9).alias("code"))


def _as_degrees(edges):
    for x, y in (("x1", "y1"), ("x2", "y2")):
        edges = edges.withColumns({x: 112 + F.col(x) * 0.4, y: -44 + F.col(y) * 0.34})
    return edges


def albers_area(spark, sf):
    shapes = aw.project_albers(_as_degrees(v.supplier_frames(spark, sf)))
    return (aw.area_by_key(shapes, ["bdy_id"])
            .select("bdy_id", F.round(F.col("area") / 1e6, 3).alias("area_sqkm")))


def centroids(spark, sf):
    return (aw.centroids(v.supplier_ells(spark, sf))
            .select("bdy_id", F.round("px", 6).alias("cx"), F.round("py", 6).alias("cy")))


def overlap_report(spark, sf):
    return (aw.overlap_report(v.atom_squares(spark, sf), v.supplier_ells(spark, sf))
            .select("a_id", "b_id", *[F.round(c, 6).alias(c) for c in ("area", "cx", "cy")]))


def percent_overlap(spark, sf):
    return (aw.percent_overlap(v.supplier_frames(spark, sf), v.nation_frames(spark, sf))
            .select("a_id", "b_id", F.round("percent_area", 6).alias("percent_area")))


def atoms_touching(spark, sf):
    return aw.atoms_touching(v.atom_squares(spark, sf), v.nation_ells(spark, sf), ["6", "18"])


def geometry_diff(spark, sf):
    return (aw.geometry_diff(v.supplier_squares(spark, sf), v.supplier_squares(spark, sf, odd_as_ells=True))
            .select("bdy_id", *[F.round(c, 6).alias(c) for c in ("a_area", "b_area", "overlap_area")]))


def geometry_diff_islet(spark, sf):
    found = aw.geometry_diff(v.supplier_squares(spark, sf), v.supplier_islets(spark, sf))
    return found.select("bdy_id", *[F.round(c, 9).alias(c) for c in ("a_area", "b_area", "overlap_area")])


def overlap_slanted(spark, sf):
    found = aw.overlap(v.slanted(v.atom_squares(spark, sf)), v.slanted(v.supplier_ells(spark, sf)))
    return found.select("a_id", "a_name", "b_id", "b_name", *[F.round(c, 6).alias(c) for c in ("area", "cx", "cy")])


def overlap_at_corners(spark, sf):
    found = aw.overlap(v.supplier_triangles(spark, sf), v.supplier_triangles(spark, sf, second=True), same_id=True)
    return found.select("a_id", F.round("area", 6).alias("area"))


def atoms_touching_slanted(spark, sf):
    return aw.atoms_touching(v.slanted(v.atom_squares(spark, sf)), v.slanted(v.nation_ells(spark, sf)), ["6", "18"])


def pip_slanted(spark, sf):
    shapes = v.slanted(v.enlarged(v.supplier_ells(spark, sf), 10))
    return aw.point_in_polygon_join(v.slanted_points(spark, sf), shapes, "atom_id")


def collected_features(spark, sf):
    shapes = step_table(v.nation_stores(spark, sf), "stores")
    sizes = shapes.groupBy("bdy_id").agg(F.countDistinct("part_id").alias("part_count"), F.countDistinct("feature").alias("feature_count"))
    inside = aw.point_in_polygon_join(v.atom_points(spark, sf), shapes, "atom_id").groupBy("bdy_id").agg(
        F.count(F.lit(1)).alias("atom_count"))
    return sizes.join(aw.area_by_key(shapes, ["bdy_id"]), "bdy_id").join(inside, "bdy_id", "left")


def unmatched_shapes(spark, sf):
    return aw.unmatched(v.supplier_squares(spark, sf), v.nation_squares(spark, sf))


def overlap_legacy_pair(spark, sf):
    units = v.cust_units(spark, sf)
    targets = units.select("unit_id", F.col("nation_id").alias("target_id"), F.col("nation_name").alias("target_name"),
                           F.col("region_name").alias("target_state"))
    rows = aw.legacy_pair_spatial(
        v.atom_points(spark, sf), units.select("unit_id", F.col("segment").alias("state"), "atom_id"), targets,
        v.nation_squares(spark, sf), v.nation_frames(spark, sf), "square", "frame", "atom_id")
    return rows.withColumns({c: F.round(c, 6) for c in ("overlap_area", "overlap_x", "overlap_y")})


def project_population(spark, sf):
    orders = v.read(spark, sf, "orders").withColumnRenamed("o_custkey", "mb_code")
    atoms = v.read(spark, sf, "customer").select(F.col("c_custkey").alias("mb_code"),
                                                 F.floor("c_acctbal").alias("person"))
    return aw.project_population(atoms, orders.filter("o_orderstatus = 'F'"), orders)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        build_pair, build_pair_cross_source, build_pair_by_flag, build_pair_two_sided_filter, build_all,
        build_all_from_atoms, nested_pairs, same_table_pair, legacy_pair_overrides,
        score, error_rate, score_with_error, weighted_percent_by_id,
        apportion, rate, slice_pair, lookup, compare_official, rollup_indicator,
        residential_flags, reconcile, category_disagreement, unit_profile, unit_profile_topk, release_versions,
        duplicate_keys, duplicate_names, null_violations, dropped_units, row_parity, percent_totals,
        pip_join, pip_join_parts_and_holes, tag_units, tag_units_tie_break, tag_units_from_shapes, zonal_sum, point_on_surface_inside,
        two_way_match, name_mismatches, area_by_key, area_from_vertices, albers_area, centroids, overlap_report, percent_overlap,
        atoms_touching, geometry_diff, geometry_diff_islet, overlap_slanted, overlap_at_corners, atoms_touching_slanted,
        pip_slanted, collected_features, unmatched_shapes, overlap_legacy_pair, project_population,
        strip_code_prefix,
    )
}
QUERIES["release_version"] = QUERIES.pop("release_versions")
