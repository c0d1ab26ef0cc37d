"""Files and tables, read back after writing."""

import glob
import gzip
from decimal import Decimal as D

import pytest
from conftest import values
from pyspark.sql import functions as F

import areaweave as aw
from areaweave.config import CROSSWALK_COLUMNS, KEY_COLUMNS, PAIR_COLUMNS
from areaweave.sources import (
    append_table, export_csv, find_table, open_table, publish, read_crosswalk, read_csv, replace_table, write_crosswalk,
)
from areaweave.sources import files
from areaweave.sources.catalog import layout_of


@pytest.fixture(scope="module")
def crosswalk(spark):
    rows = [("s", f"b{b}", f"{i:04d}", f'Name "{i}", the', "s", "t", str(i % 7), f"T{i % 7}", i, D("0.5") + i % 99)
            for b in range(3) for i in range(200)]
    return spark.createDataFrame(rows, files.CROSSWALK_SCHEMA)


def test_export_is_sorted_and_reads_back(spark, crosswalk, tmp_path):
    path = str(tmp_path / "out")
    export_csv(crosswalk.repartition(5), path)
    got = [r[:3] for f in sorted(glob.glob(f"{path}/part-*")) for r in
           [line.split(",") for line in open(f).read().splitlines()[1:]]]
    assert got == sorted(got) and len(got) == 600
    assert open(sorted(glob.glob(f"{path}/part-*"))[0]).readline().strip().split(",") == CROSSWALK_COLUMNS
    assert values(read_crosswalk(spark, path)) == values(crosswalk)


def test_compressed_export(spark, crosswalk, tmp_path):
    path = str(tmp_path / "zip")
    export_csv(crosswalk, path, compress=True)
    first = sorted(glob.glob(f"{path}/part-*.csv.gz"))[0]
    assert gzip.open(first, "rt").readline().startswith("from_source,")
    assert read_crosswalk(spark, path).count() == 600


def test_codes_stay_text_and_bad_rows_stop_the_read(spark, tmp_path):
    good = tmp_path / "good.csv"
    good.write_text("postcode,cases\n0822,5\nNone,7\n")
    assert values(read_csv(spark, str(good), files.CASES_BY_POSTCODE)) == [("0822", 5), ("None", 7)]
    bad = tmp_path / "bad.csv"
    bad.write_text("postcode,cases\n0822,many\n")
    with pytest.raises(Exception):
        read_csv(spark, str(bad), files.CASES_BY_POSTCODE).collect()
    other = tmp_path / "other.csv"
    other.write_text("postcode,tests\n0822,5\n")
    with pytest.raises(Exception):
        read_csv(spark, str(other), files.CASES_BY_POSTCODE).collect()


def test_empty_field_is_null(spark, tmp_path):
    path = tmp_path / "score.csv"
    path.write_text(",".join([*PAIR_COLUMNS, "concordance_percent", "error_percent"]) + "\na,b,c,d,78,\na,b,c,e,99,0.1\n")
    assert values(read_csv(spark, str(path), files.SCORE_SCHEMA), "to_bdy", "error_percent") == [("d", None), ("e", D("0.1"))]


def test_stored_crosswalk_prunes_to_one_pair(spark, crosswalk, tmp_path):
    path = str(tmp_path / "stored")
    write_crosswalk(crosswalk, path)
    stored = read_crosswalk(spark, path, "parquet")
    assert values(stored) == values(crosswalk)
    piece = aw.slice_pair(stored, aw.Pair("s", "b1", "s", "t"))
    assert piece.count() == 200
    scan = piece._jdf.queryExecution().executedPlan().toString()
    filters = scan[scan.index("PartitionFilters"):scan.index("PushedFilters")]
    assert all(c in filters for c in PAIR_COLUMNS)


def test_tables(spark, crosswalk):
    spark.sql("create database if not exists work")
    replace_table(crosswalk, "work.cw", PAIR_COLUMNS)
    replace_table(crosswalk, "work.cw", PAIR_COLUMNS)
    assert spark.table("work.cw").count() == 600
    append_table(crosswalk.limit(10), "work.extra")
    append_table(crosswalk.limit(10), "work.extra")
    assert spark.table("work.extra").count() == 20
    publish(spark, {"cw": KEY_COLUMNS, "extra": []}, "work", "copy", {"cw": PAIR_COLUMNS})
    assert values(spark.table("copy.cw").select(*CROSSWALK_COLUMNS)) == values(crosswalk)
    with pytest.raises(ValueError, match="not unique"):
        publish(spark, {"extra": KEY_COLUMNS}, "work", "copy")


def test_bucketed_tag_tables_join_without_shuffle(spark):
    spark.sql("create database if not exists work")
    tags = spark.range(1000).select(F.col("id").alias("gnaf_pid"), (F.col("id") % 9).cast("string").alias("x"))
    for name in ("left_tags", "right_tags"):
        replace_table(tags, f"work.{name}", bucket=(4, "gnaf_pid"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = spark.table("work.left_tags").join(spark.table("work.right_tags"), "gnaf_pid")
        assert joined.count() == 1000
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_published_copies_keep_their_layout_and_join_without_shuffle(spark, crosswalk):
    spark.sql("create database if not exists work")
    tags = spark.range(1000).select(F.col("id").alias("gnaf_pid"), (F.col("id") % 9).cast("string").alias("x"))
    for name in ("tags_one", "tags_two"):
        replace_table(tags, f"work.{name}", bucket=(4, "gnaf_pid"))
    replace_table(crosswalk, "work.parted", PAIR_COLUMNS)
    publish(spark, {"tags_one": ["gnaf_pid"], "tags_two": [], "parted": KEY_COLUMNS}, "work", "verbatim")
    assert layout_of(spark, "verbatim.tags_one") == layout_of(spark, "work.tags_one") == ((), 4, ("gnaf_pid",), ("gnaf_pid",))
    assert layout_of(spark, "verbatim.parted") == (tuple(PAIR_COLUMNS), 0, (), ())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = spark.table("verbatim.tags_one").join(spark.table("verbatim.tags_two"), "gnaf_pid")
        assert joined.count() == 1000
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert values(spark.table("verbatim.parted").select(*CROSSWALK_COLUMNS)) == values(crosswalk)


def test_adding_a_pair_again_replaces_it(spark, crosswalk):
    spark.sql("create database if not exists work")
    spark.sql("drop table if exists work.replayed")
    for b in ("b0", "b1", "b1", "b0"):
        append_table(crosswalk.filter(F.col("from_bdy") == b), "work.replayed", PAIR_COLUMNS)
    stored = spark.table("work.replayed").select(*CROSSWALK_COLUMNS)
    assert values(stored) == values(crosswalk.filter("from_bdy in ('b0', 'b1')"))
    append_table(crosswalk.filter("from_bdy = 'b1'").limit(7), "work.replayed", PAIR_COLUMNS)
    counts = {r.from_bdy: r["count"] for r in spark.table("work.replayed").groupBy("from_bdy").count().collect()}
    assert counts == {"b0": 200, "b1": 7}
    with pytest.raises(ValueError, match="partitioned"):
        append_table(crosswalk, "work.replayed", ["from_bdy"])


def test_source_lookup(spark):
    registry = aw.standard_registry(aw.Namespaces("202508", units="units"))
    assert find_table(registry, "abs 2016") == "units.address_principal_census_2016_boundaries"
    assert find_table(registry, "nowhere") is None
    with pytest.raises(ValueError):
        open_table(spark, registry, "nowhere")
    with pytest.raises(ValueError, match="no table"):
        open_table(spark, aw.Registry.of(aw.Source("x", {})), "x")
