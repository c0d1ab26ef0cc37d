"""The standard build end to end on a small made-up country."""

from decimal import Decimal as D

import pytest
from conftest import polygon_wkb, square, values
from pyspark.sql import functions as F

import areaweave as aw
from areaweave.config import (
    BUILDINGS, CENSUS_2016, CENSUS_2021, CLASSIFIED_TABLE, CROSSWALK_COLUMNS, KEY_COLUMNS, STANDARD_RESIDENTIAL, Namespaces, standard_pairs,
    standard_registry,
)
from areaweave.plans.standard import OUTPUT_TABLE, SCORE_TABLE, run_standard
from areaweave.sources import read_crosswalk, replace_table

SIZE = 6
NS = Namespaces("202508")


def _rows(spark, rows, columns, name):
    spark.createDataFrame(rows, columns).write.mode("overwrite").saveAsTable(name)


@pytest.fixture(scope="module")
def country(spark, tmp_path_factory):
    """Meshblocks on a grid; the layers are bands and blocks of it."""
    for db in ("gnaf_202508", "census_2016_bdys", "census_2021_bdys_gda94", "census_2016_data"):
        spark.sql(f"create database if not exists {db}")
    cells = [(i, j) for i in range(SIZE) for j in range(SIZE)]
    wkb = {c: bytearray(polygon_wkb(square(*c))) for c in cells}
    old = [(f"1{i}{j}", "RESIDENTIAL", f"a{i}{j // 2}", f"{i}{j // 2}", f"b{i // 2}", f"B{i // 2}", f"c{i // 4}", f"C{i // 4}",
            "d0", "D0", "g0", "G0", "1", "State", wkb[i, j]) for i, j in cells]
    _rows(spark, old, "mb_code16 string, mb_cat16 string, sa1_main16 string, sa1_7dig16 string, sa2_main16 string, "
          "sa2_name16 string, sa3_code16 string, sa3_name16 string, sa4_code16 string, sa4_name16 string, gcc_code16 string, "
          "gcc_name16 string, ste_code16 string, ste_name16 string, geom binary", "census_2016_bdys.mb_2016_aust")
    new = [(f"2{i}{j}", "Parkland" if (i + j) % 5 == 0 else "Residential", f"A{i}{j // 3}", f"x{i // 2}", f"X{i // 2}", f"y{i // 4}",
            f"Y{i // 4}", "z0", "Z0", "g0", "G0", "1", "State", wkb[i, j]) for i, j in cells]
    _rows(spark, new, "mb_code_2021 string, mb_category_2021 string, sa1_code_2021 string, sa2_code_2021 string, "
          "sa2_name_2021 string, sa3_code_2021 string, sa3_name_2021 string, sa4_code_2021 string, sa4_name_2021 string, "
          "gccsa_code_2021 string, gccsa_name_2021 string, state_code_2021 string, state_name_2021 string, geom binary",
          "census_2021_bdys_gda94.mb_2021_aust_gda94")
    bands = {"ced": 6, "lga": 2, "poa": 3, "ra": 6, "ucl": 6, "sed": 1}
    for b, width in bands.items():
        shapes = [(f"{b}{k}", f"{b.upper()} {k}", bytearray(polygon_wkb(square(0, k * width, SIZE, width))))
                  for k in range(SIZE // width if b != "sed" else 4)]
        _rows(spark, shapes, f"{b}_code16 string, {b}_name16 string, geom binary", f"census_2016_bdys.{b}_2016_aust")
        _rows(spark, shapes, f"{b}_code_2021 string, {b}_name_2021 string, geom binary",
              f"census_2021_bdys_gda94.{b}_2021_aust_gda94")
    people = [(n, f"u{n}", i, j) for n, (i, j) in enumerate(c for c in cells for _ in range(c[0] + 2 * c[1] + 1))]
    _rows(spark, [(n, u, f"1{i}{j}", f"2{i}{j}", "NSW") for n, u, i, j in people],
          "gid int, gnaf_pid string, mb_2016_code string, mb_2021_code string, state string", "gnaf_202508.address_principals")
    _rows(spark, [(u, f"loc{i}", f"Loc {i}", f"20{j // 4}0", "NSW", f"lga{j // 2}" if i else None, f"Lga {j // 2}")
                  for n, u, i, j in people if n % 11],
          "gnaf_pid string, locality_pid string, locality_name string, postcode string, state string, lga_pid string, "
          "lga_name string", "gnaf_202508.address_principal_admin_boundaries")
    for b, ids in {"sa2": ["b0", "b1", "b2"], "sa3": ["c0", "c1"], "sa4": ["d0"], "poa": ["poa0", "poa1"],
                   "lga": ["lga0", "lga1", "lga2"], "gccsa": ["g0"], "ste": ["1"], "ra": ["ra0"]}.items():
        _rows(spark, [(r, 600.0 / len(ids)) for r in ids], "region_id string, g3 double", f"census_2016_data.{b}_g01")
    out = str(tmp_path_factory.mktemp("export"))
    run_standard(spark, NS, export_path=out, publish_to="gnaf_202508_copy", buckets=4)
    return out


def test_all_pairs_are_built_and_scored(spark, country):
    scores = spark.table(f"gnaf_202508.{SCORE_TABLE}")
    assert scores.count() == 65
    inside = scores.filter("from_source = 'abs 2016' and to_source = 'abs 2016'")
    assert inside.count() == 21 and inside.filter("error_percent is null").count() == 0
    assert inside.filter("error_percent = 0.0 and from_bdy like 'sa%' and to_bdy in ('sa2', 'sa3', 'sa4', 'gcc')").count() == 10
    assert scores.filter("not (from_source = 'abs 2016' and to_source = 'abs 2016') and error_percent is not null").count() == 0
    assert scores.filter("from_bdy = 'gcc' and to_bdy = 'gccsa'").first().concordance_percent == 100


def test_unit_tables_keep_units_outside_the_optional_layer(spark, country):
    tags = spark.table("gnaf_202508.address_principal_census_2016_boundaries")
    assert tags.count() == spark.table("gnaf_202508.address_principals").count()
    assert tags.filter("sed_code16 is null").count() > 0 and tags.filter("lga_code16 is null").count() == 0
    row = tags.filter("mb_code16 = '123'").first()
    assert (row.lga_code16, row.poa_name16, row.sa1_code16, row.sa1_name16) == ("lga1", "POA 1", "a21", "21")


def test_crosswalk_equals_pair_by_pair_over_the_unit_tables(spark, country):
    registry = standard_registry(NS)
    tables = {name: spark.table(s.table) for name, s in registry.sources.items()}
    pairs = standard_pairs("202508")
    got = spark.table(f"gnaf_202508.{OUTPUT_TABLE}").select(*CROSSWALK_COLUMNS)
    woven = aw.build_all(tables, registry, pairs, STANDARD_RESIDENTIAL)
    assert got.count() > woven.count() and woven.exceptAll(got).isEmpty()
    for pair in (pairs[0], pairs[18], pairs[24], pairs[39], pairs[44]):
        assert values(aw.slice_pair(got, pair)) == values(
            aw.build_pair(tables, registry, pair, STANDARD_RESIDENTIAL))


def test_percents_add_up_and_filter_is_per_pair(spark, country):
    cw = spark.table(f"gnaf_202508.{OUTPUT_TABLE}")
    totals = cw.groupBy("from_source", "from_bdy", "from_id", "to_source", "to_bdy").agg(
        F.sum("address_percent").alias("p")).agg(F.min("p").alias("lo"), F.max("p").alias("hi")).first()
    assert D("99.5") < totals.lo and totals.hi < D("100.5")
    counts = {(r.from_source, r.from_bdy, r.to_source, r.to_bdy): r.n for r in cw.groupBy(
        "from_source", "from_bdy", "to_source", "to_bdy").agg(F.sum("address_count").alias("n")).collect()}
    units = spark.table("gnaf_202508.address_principals").count()
    assert counts[CENSUS_2016, "lga", CENSUS_2016, "sa3"] == counts[CENSUS_2021, "sa1", CENSUS_2021, "gccsa"] == units
    assert counts[CENSUS_2021, "lga", CENSUS_2021, "sa3"] == counts[CENSUS_2016, "sa2", CENSUS_2021, "sa2"] < units


def test_exports_and_published_copy(spark, country):
    exported = read_crosswalk(spark, f"{country}/{OUTPUT_TABLE}")
    stored = spark.table(f"gnaf_202508.{OUTPUT_TABLE}").select(*CROSSWALK_COLUMNS)
    assert values(exported) == values(stored)
    assert values(spark.table(f"gnaf_202508_copy.{OUTPUT_TABLE}").select(*CROSSWALK_COLUMNS)) == values(stored)
    assert aw.duplicate_keys(stored, KEY_COLUMNS).count() == 0


def test_flagged_residential_rule_end_to_end(spark, country):
    registry, pairs = standard_registry(NS), standard_pairs("202508")
    tables = {name: spark.table(s.table) for name, s in registry.sources.items()}
    flags = spark.table("gnaf_202508.address_principals").select("gnaf_pid", (F.col("gid") % 3 == 0).alias("is_residential"))
    atoms = {
        CENSUS_2016: aw.AtomTags(tables[CENSUS_2016].drop("gid", "gnaf_pid").distinct(), "mb_code16", "mb_2016_code"),
        CENSUS_2021: aw.AtomTags(tables[CENSUS_2021].drop("gid", "gnaf_pid").distinct(), "mb_code_2021", "mb_2021_code")}
    rule = aw.Residential(by_flag=True)
    by_unit = aw.build_all(tables, registry, pairs, rule, flags)
    by_atom = aw.build_all_from_atoms(spark.table("gnaf_202508.address_principals"), "gnaf_pid", atoms, tables,
                                      registry, pairs, rule, flags)
    assert values(by_unit) == values(by_atom)
    pair = pairs[25]
    assert values(aw.slice_pair(by_unit, pair)) == values(aw.build_pair(tables, registry, pair, rule, flags))


def test_residential_sources_by_name(spark, country):
    """All three sources end to end: both census ones keep units by category, the buildings by a stored, checked flag."""
    for db in ("admin_bdys_202508", "geoscape_202203"):
        spark.sql(f"create database if not exists {db}")
    atoms_16, atoms_21 = spark.table("census_2016_bdys.mb_2016_aust"), spark.table("census_2021_bdys_gda94.mb_2021_aust_gda94")
    replace_table(atoms_16.select(F.col("mb_code16").alias("mb_16code"), F.col("mb_cat16").alias("mb_category")), "admin_bdys_202508.abs_2016_mb")
    replace_table(atoms_21.select(F.col("mb_code_2021").alias("mb21_code"), F.col("mb_category_2021").alias("mb_cat")),
                  "admin_bdys_202508.abs_2021_mb")
    units = spark.table("gnaf_202508.address_principals")
    replace_table(units.select(F.col("gnaf_pid").alias("address_detail_pid"), (F.col("gid") % 4).alias("building_pid")).filter(
        "building_pid < 3"), "geoscape_202203.building_address")
    replace_table(spark.createDataFrame([(0, "Low Density Residential"), (1, "Industrial"), (2, None)], "building_pid int, planning_zone string"),
                  "geoscape_202203.buildings")
    spark.sql(f"drop table if exists geoscape_202203.{CLASSIFIED_TABLE}")
    built = {}
    for name in (CENSUS_2021, CENSUS_2016, BUILDINGS):
        run_standard(spark, NS, name, buckets=4)
        built[name] = values(spark.table(f"gnaf_202508.{OUTPUT_TABLE}").select(*CROSSWALK_COLUMNS))
    assert built[CENSUS_2021] == built[CENSUS_2016] != built[BUILDINGS]
    classified = spark.table(f"geoscape_202203.{CLASSIFIED_TABLE}")
    assert classified.count() == units.count()
    expected = units.join(atoms_21, F.col("mb_2021_code") == F.col("mb_code_2021")).select("gnaf_pid", F.expr(
        "case gid % 4 when 0 then true when 1 then false else mb_category_2021 = 'Residential' end as is_residential"))
    assert values(classified.select("gnaf_pid", "is_residential")) == values(expected)
    registry, pair = standard_registry(NS), standard_pairs("202508")[25]
    tables = {name: spark.table(s.table) for name, s in registry.sources.items()}
    got = aw.slice_pair(spark.table(f"gnaf_202508.{OUTPUT_TABLE}").select(*CROSSWALK_COLUMNS), pair)
    assert values(got) == values(aw.build_pair(tables, registry, pair, aw.Residential(by_flag=True), classified))
    with pytest.raises(ValueError, match="unknown residential source"):
        run_standard(spark, NS, "nowhere")


def test_score_with_error_is_score_and_error_rate(spark, country):
    crosswalk = spark.table(f"gnaf_202508.{OUTPUT_TABLE}").select(*CROSSWALK_COLUMNS)
    indicators = spark.createDataFrame([("sa3", "c0", 310.5), ("sa3", "c1", 99.0), ("lga", "lga0", 100.0), ("lga", "lga1", 200.0),
                                        ("lga", "lga1", 7.0), ("poa", "poa0", 0.0), ("sa3", "c0", 4.0)], "bdy string, region_id string, value double")
    got = aw.score_with_error(crosswalk, indicators)
    apart = aw.score(crosswalk).join(aw.error_rate(crosswalk, indicators), list(aw.Pair._fields), "left")
    nested = "from_source = 'abs 2016' and to_source = 'abs 2016' and from_bdy in ('sa1', 'sa2', 'sa3', 'sa4', 'gcc') and to_bdy in ('sa2', 'sa3', 'sa4', 'gcc')"
    assert values(got.filter(f"not ({nested})")) == values(apart.filter(f"not ({nested})"))
    assert got.filter(nested).filter("error_percent = 0").count() == 10
    scans = got._jdf.queryExecution().optimizedPlan().toString().count(OUTPUT_TABLE)
    assert scans == 1
