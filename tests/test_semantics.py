"""Rounding, NULLs, filters and key rules on tables small enough to check by eye."""

import datetime
from decimal import Decimal as D

import pytest
from conftest import values
from pyspark.sql import functions as F

import areaweave as aw
from areaweave.config import (
    KEY_COLUMNS, Boundary, Pair, Registry, Residential, Source, census_levels, level_pairs, standard_pairs,
)
from areaweave.functions import (
    concat_skip_nulls, name_before, release_version, round_half_even, strip_prefix, to_numeric, varchar,
)
from areaweave.operators.legacy import LOCALITY_OVERRIDES
from areaweave.operators.profile import unit_profile

REG = Registry.of(
    Source("a", {"x": Boundary("x", "x_name"), "y": Boundary("y", "y")}, unit_id="u", category="cat"),
    Source("b", {"z": Boundary("z", "z")}, unit_id="u", category="cat"),
)


def one(spark, column):
    return spark.range(1).select(column).first()[0]


@pytest.mark.parametrize("value, whole", [(0.5, 0), (1.5, 2), (2.5, 2), (-2.5, -2), (-2.7, -3), (2.4, 2)])
def test_round_half_even(spark, value, whole):
    assert one(spark, round_half_even(F.lit(value), "smallint")) == whole


@pytest.mark.parametrize("value, shown", [(0.25, "0.3"), (0.45, "0.5"), (0.04, "0.0"), (100.0, "100.0")])
def test_to_numeric(spark, value, shown):
    assert one(spark, to_numeric(F.lit(value), 4, 1)) == D(shown)


def test_to_numeric_overflow_raises(spark):
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE|cannot be represented"):
        one(spark, to_numeric(F.lit(1000.0), 4, 1))


def test_text_functions(spark):
    null = F.lit(None).cast("string")
    assert one(spark, concat_skip_nulls(F.lit("0822"), F.lit(" "), null)) == "0822 "
    assert one(spark, name_before(F.lit("Dungog (A)"))) == "Dungog"
    assert one(spark, name_before(F.lit("Sydney"))) == "Sydney"
    assert one(spark, varchar(F.lit(123456789012345), 11)) == "12345678901"
    assert one(spark, strip_prefix(F.lit("LGA10050"))) == "10050"


@pytest.mark.parametrize("day, current, previous", [
    ((2025, 1, 31), "202411", "202408"), ((2025, 2, 1), "202502", "202411"), ((2025, 4, 30), "202502", "202411"),
    ((2025, 5, 1), "202505", "202502"), ((2025, 8, 15), "202508", "202505"), ((2025, 10, 31), "202508", "202505"),
    ((2025, 11, 1), "202511", "202508"), ((2025, 12, 31), "202511", "202508")])
def test_release_version(spark, day, current, previous):
    assert tuple(one(spark, release_version(F.lit(datetime.date(*day))))) == (current, previous)


def test_standard_pairs():
    pairs = standard_pairs("202508")
    assert len(pairs) == len(set(pairs)) == 45
    assert len(pairs) + 2 * len(level_pairs(census_levels("abs 2016"))) == 65
    sources = [(p.from_source, p.to_source) for p in pairs]
    assert sources.count(("abs 2016", "abs 2016")) == sources.count(("abs 2021", "abs 2021")) == 11
    assert sources.count(("geoscape 202508", "abs 2016")) == sources.count(("geoscape 202508", "abs 2021")) == 7
    assert sources.count(("abs 2016", "abs 2021")) == 5
    registry = aw.standard_registry(aw.Namespaces("202508"))
    for p in pairs:
        registry[p.from_source].boundary(p.from_bdy)
        registry[p.to_source].boundary(p.to_bdy)
    assert registry["abs 2016"].boundary("gccsa") == registry["abs 2016"].boundary("gcc")
    assert registry["abs 2021"].boundary("sa1").name == "sa1_code_2021"
    assert ("gccsa" in census_levels("abs 2021")) and ("gcc" in census_levels("abs 2016"))


def test_unknown_names_raise(spark):
    with pytest.raises(ValueError, match="unknown source"):
        REG["c"]
    with pytest.raises(ValueError, match="is not in source"):
        REG["a"].boundary("w")
    assert REG.find("c") is None


def _tables(spark):
    a = spark.createDataFrame(
        [(1, "p", "P", "q", "home"), (2, "p", "P", "q", "home"), (3, "p", "P2", "r", "work"), (4, "p", "P", None, "home"),
         (5, None, "N", "q", "home"), (6, "o", "O", "r", None)], "u int, x string, x_name string, y string, cat string")
    b = spark.createDataFrame([(1, "m", "home"), (2, "n", "home"), (3, "m", "home"), (9, "m", "home")],
                              "u int, z string, cat string")
    return {"a": a, "b": b}


def test_build_pair_counts_names_apart_but_shares_by_id(spark):
    pair = Pair("a", "x", "a", "y")
    got = values(aw.build_pair(_tables(spark), REG, pair),
                 "from_id", "from_name", "to_id", "address_count", "address_percent")
    assert got == [("o", "O", "r", 1, D("100.0")), ("p", "P", "q", 2, D("66.7")), ("p", "P2", "r", 1, D("33.3"))]


def test_residential_rule_only_where_its_source_takes_part(spark):
    rule = Residential({"a": ("home",)})
    assert values(aw.build_pair(_tables(spark), REG, Pair("a", "x", "a", "y"), rule),
                  "from_id", "to_id", "address_count") == [("p", "q", 2)]
    other = Residential({"b": ("work",)})
    assert aw.build_pair(_tables(spark), REG, Pair("a", "x", "a", "y"), other).count() == 3
    assert aw.build_pair(_tables(spark), REG, Pair("a", "x", "b", "z"), other).count() == 0


def test_residential_flag_applies_to_every_pair(spark):
    flags = spark.createDataFrame([(1, True), (2, False), (3, None)], "u int, is_residential boolean")
    rule = Residential(by_flag=True)
    for build in (lambda p: aw.build_pair(_tables(spark), REG, p, rule, flags),
                  lambda p: aw.build_all(_tables(spark), REG, [p], rule, flags)):
        assert values(build(Pair("a", "x", "a", "y")), "from_id", "to_id", "address_count") == [("p", "q", 1)]
    with pytest.raises(ValueError, match="by flag"):
        aw.build_pair(_tables(spark), REG, Pair("a", "x", "a", "y"), rule)


@pytest.mark.parametrize("rule", [aw.EVERYONE, Residential({"a": ("home",)}), Residential({"a": ("home",), "b": ("home",)})])
@pytest.mark.parametrize("listed", [False, True])
def test_build_all_is_the_union_of_pairs(spark, rule, listed):
    pairs = [Pair("a", "x", "a", "y"), Pair("a", "y", "b", "z"), Pair("b", "z", "a", "x"), Pair("b", "z", "b", "z")]
    units = spark.range(20).select(F.col("id").cast("int").alias("u")) if listed else None
    single = [r for p in pairs for r in values(aw.build_pair(_tables(spark), REG, p, rule))]
    assert values(aw.build_all(_tables(spark), REG, pairs, rule, units=units)) == sorted(single, key=repr)


def test_tiny_share_is_kept_as_zero(spark):
    rows = spark.range(4000).select(F.col("id").alias("u"), F.lit("f").alias("x"), F.lit("F").alias("x_name"),
                                    F.when(F.col("id") == 0, "rare").otherwise("usual").alias("y"))
    got = values(aw.build_pair({"a": rows}, REG, Pair("a", "x", "a", "y")), "to_id", "address_percent")
    assert got == [("rare", D("0.0")), ("usual", D("100.0"))]


def test_legacy_pair_drops_shares_that_round_to_zero(spark):
    rows = spark.range(1000).select(
        F.lit("s").alias("source_id"), F.lit("S").alias("source_name"), F.lit("NSW").alias("source_state"),
        F.when(F.col("id") < 4, "t1").when(F.col("id") < 10, "t2").otherwise("t3").alias("target_id"),
        F.lit("T").alias("target_name"), F.lit("NSW").alias("target_state"), F.lit("loc").alias("locality_pid"))
    got = values(aw.legacy_pair(rows, "from", "to"), "target_id", "total_source_addresses", "percent_source_addresses")
    assert got == [("t2", 1000, 1), ("t3", 1000, 99)]


def test_overrides_order(spark):
    known = LOCALITY_OVERRIDES[0]
    rows = spark.createDataFrame(
        [("ACT", "lga1", "One", "x"), ("ACT", None, None, known.key), ("NSW", None, None, known.key),
         ("NSW", "lga2", "Two", known.key), ("NSW", None, "Odd", "x"), (None, "lga3", "Three", None)],
        "target_state string, target_id string, target_name string, locality_pid string")
    got = values(aw.apply_overrides(rows), "target_id", "target_name")
    assert got == sorted([("lgaact9999991", "Unincorporated - ACT")] * 2 + [(known.target_id, known.target_name),
                         ("lga2", "Two"), ("lga3", "Three")], key=repr)


@pytest.mark.parametrize("zone, count, category, flag", [
    ("industrial - low density residential", 2, "commercial", True), ("rural - unknown", 2, "residential", False),
    ("unknown", 1, "residential", True), ("unknown", 1, "parkland", False), ("unknown", 1, None, None),
    (None, 0, "residential", True), (None, 0, "other", False), (None, 0, None, None), ("rural", 0, "residential", True)])
def test_residential_flag(spark, zone, count, category, flag):
    row = spark.createDataFrame([(zone, count, category)], "z string, n int, c string")
    assert row.select(aw.residential_flag(F.col("z"), F.col("n"), F.col("c"))).first()[0] is flag


def _crosswalk(spark, rows):
    return spark.createDataFrame(
        [("s", "f", fid, fid, "s", "t", tid, tid, n, D(p)) for fid, tid, n, p in rows],
        "from_source string, from_bdy string, from_id string, from_name string, to_source string, to_bdy string, "
        "to_id string, to_name string, address_count bigint, address_percent decimal(4,1)")


def test_apportion_and_rate(spark):
    cw = _crosswalk(spark, [("1", "A", 1, "25.0"), ("1", "B", 3, "75.0"), ("None", "A", 1, "100.0"), ("2", "C", 5, "100.0")])
    cases = spark.createDataFrame([("1", 10), ("None", 4), ("9", 100), ("2", 7)], "postcode string, cases int")
    carried = aw.apportion(cases, "postcode", ["cases"], cw)
    # 2.5 + 4 = 6.5 goes to the even 6, and 7.5 to the even 8.
    assert values(carried, "to_id", "cases", "cases_qa_count", "from_count") == [
        ("A", 6, 14, 2), ("B", 8, 10, 1), ("C", 7, 7, 1)]
    tests = spark.createDataFrame([("A", 40), ("B", 0), ("LGAX999", 5)], "lga string, tests int")
    got = values(aw.rate(carried, "cases", tests, "lga", "tests"), "to_id", "tests", "cases", "rate_percent",
                 "concordance_percent", "from_count")
    assert got == [("A", 40, 6, D("15.0"), 43, 2), ("B", 0, 8, None, 80, 1)]
    assert aw.rate(carried, "cases", tests, "lga", "tests", how="left").count() == 3


def test_score_uses_the_stored_percent(spark):
    cw = _crosswalk(spark, [("1", "A", 1, "33.3"), ("1", "B", 2, "66.7"), ("2", "A", 7, "100.0")])
    assert values(aw.score(cw), "concordance_percent") == [(87,)]
    exact = _crosswalk(spark, [("1", "A", 1, "87.5"), ("2", "A", 1, "87.5")])
    assert values(aw.score(exact), "concordance_percent") == [(88,)]
    same = _crosswalk(spark, [(i, i, 5, "100.0") for i in "abc"])
    assert values(aw.score(same), "concordance_percent") == [(100,)]


def test_score_with_error(spark):
    cw = (_crosswalk(spark, [("1", "A", 5, "50.0"), ("1", "B", 5, "50.0"), ("2", "B", 10, "100.0")])
          .withColumns({"from_source": F.lit("abs 2016"), "to_source": F.lit("abs 2016")}))
    nested = cw.withColumns({"from_bdy": F.lit("sa1"), "to_bdy": F.lit("sa2")})
    cross = cw.withColumns({"to_source": F.lit("abs 2021")})
    unmatched = cw.withColumns({"to_bdy": F.lit("nowhere")})
    people = spark.createDataFrame([("f", "1", 100.0), ("f", "2", 50.0), ("t", "A", 60.0), ("t", "B", 90.0),
                                    ("sa1", "1", 1.0)], "bdy string, region_id string, value double")
    whole = cw.unionByName(nested).unionByName(cross).unionByName(unmatched)
    got = values(aw.score_with_error(whole, people), "from_bdy", "to_source", "to_bdy", "error_percent")
    # Estimates 50 and 100 against 60 and 90: 20 of 150.
    assert got == [("f", "abs 2016", "nowhere", None), ("f", "abs 2016", "t", D("13.3")),
                   ("f", "abs 2021", "t", None), ("sa1", "abs 2016", "sa2", D("0.0"))]


def test_compare_official_threshold(spark):
    cw = _crosswalk(spark, [("1", "A", 100, "50.0"), ("1", "B", 100, "50.0"), ("2", "B", 10, "100.0")])
    official = spark.createDataFrame([("1", "A", 0.4), ("1", "B", 0.52), ("3", "B", 1.0)],
                                     "sa2_maincode_2016 string, sa2_code_2021 string, ratio_from_to double")
    assert tuple(aw.compare_official(cw, official).first()) == (2, 7, -4, -10, 2, 12)
    assert tuple(aw.compare_official(cw, official, 5.0).first()) == (1, 10, -10, -10, -10, 10)


def test_nested_pairs(spark):
    atoms = spark.createDataFrame([("m1", "a", "r"), ("m2", "a", "r"), ("m3", None, "r")], "mb string, sa1 string, sa2 string")
    units = spark.createDataFrame([("m1",)] * 3 + [("m2",), ("m3",), ("m9",), (None,)], "code string")
    columns = {"sa1": Boundary("sa1", "sa1"), "sa2": Boundary("sa2", "sa2")}
    got = values(aw.nested_pairs(atoms, units, "abs", "mb", "code", ["sa1", "sa2"], columns),
                 "from_id", "to_id", "address_count", "address_percent")
    assert got == [("a", "r", 4, D("100.0")), (None, "r", 1, D("100.0"))]


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "k int, v string")
    assert values(aw.duplicate_keys(df, ["k"])) == [(1, 2)]
    assert aw.duplicate_keys(df, ["v"]).count() == 2
    with pytest.raises(ValueError, match="not unique"):
        aw.assert_unique(df, ["k"])
    assert aw.assert_unique(df.distinct(), ["k"]).count() == 2
    assert values(aw.null_violations(df, ["k", "v"])) == [("k", 0), ("v", 1)]
    tagged = spark.createDataFrame([(1,)], "k int")
    assert values(aw.row_parity(df, tagged, "k")) == [(3, 1, 1)]
    assert values(aw.dropped_units(df, tagged, "k"), "k") == [(2,)]
    crosswalk = aw.build_pair(_tables(spark), REG, Pair("a", "x", "a", "y"))
    assert aw.duplicate_keys(crosswalk, KEY_COLUMNS).count() == 0
    assert [r.from_id for r in aw.percent_totals(crosswalk, by=["from_id"]).collect()] == ["o", "p"]


def test_reconcile(spark):
    units = spark.createDataFrame([(1,), (2,), (3,)], "gnaf_pid int")
    buildings = spark.createDataFrame([(1, "Yes"), (1, "Yes"), (2, None), (8, "Yes")],
                                      "address_detail_pid int, is_residential string")
    assert values(aw.reconcile(units, buildings)) == sorted(
        [(None, None, 0, 1, 0), ("Yes", 3, 1, 0, 1), ("unknown", 1, 1, 0, 0)], key=repr)


def test_profile_puts_null_last(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",), ("a",)], "k string")
    assert [tuple(r) for r in unit_profile(df, ["k"]).collect()] == [("a", 2), ("b", 1), (None, 1)]
    assert [tuple(r) for r in unit_profile(df, ["k"], limit=1).collect()] == [("a", 2)]


def test_project_population(spark):
    atoms = spark.createDataFrame([("m1", 10), ("m2", 5), ("m3", 8)], "mb_code string, person int")
    old = spark.createDataFrame([("m1",)] * 4 + [("m3",)], "mb_code string")
    new = spark.createDataFrame([("m1",)] * 5 + [("m2",)], "mb_code string")
    assert values(aw.project_population(atoms, old, new)) == [
        ("m1", 10, 4, 5, 12), ("m2", 5, 0, 1, 0), ("m3", 8, 1, 0, 0)]


def test_legacy_units(spark):
    units = spark.createDataFrame([("u", "0822", None)], "gnaf_pid string, postcode string, state string")
    admin = spark.createDataFrame([("u", "loc", "lga1", "One", "NT")],
                                  "gnaf_pid string, locality_pid string, lga_pid string, lga_name string, state string")
    row = aw.legacy_units(units, admin).first()
    assert (row.source_id, row.source_name, row.target_id, row.target_state) == ("0822", " 0822", "lga1", "NT")


def test_building_zones(spark):
    address = spark.createDataFrame([(1, "b1"), (1, "b2"), (1, "b2"), (2, "b3"), (None, "b1"), (3, "gone")],
                                    "address_detail_pid int, building_pid string")
    buildings = spark.createDataFrame([("b1", "Rural"), ("b2", None), ("b3", "RURAL")],
                                      "building_pid string, planning_zone string")
    assert values(aw.building_zones(address, buildings)) == [(1, "rural - unknown", 3), (2, "rural", 1)]


def test_category_disagreement_and_rollup(spark):
    df = spark.createDataFrame([("r", "c", 1), ("r", "c", 1), ("r", "r", 2), ("c", "r", 3), (None, "r", 4)],
                               "label string, cat string, mb int")
    assert tuple(aw.category_disagreement(df, "label", "cat", "mb").first()) == (3, 2)
    assert tuple(aw.category_disagreement(df, "label", "cat", "mb", "r").first()) == (2, 1)
    raw = spark.createDataFrame([("1", 2), ("1", 3), ("None", 1)], "lga string, n int")
    rolled = aw.rollup_indicator(raw, "lga", "n", "LGA", "cases")
    assert values(rolled) == [("LGA1", 5), ("LGANone", 1)]
    assert values(aw.rollup_indicator(raw, "lga", "n")) == [("1", 5), ("None", 1)]
