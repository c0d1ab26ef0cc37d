"""The standard build at full size: ``python -m workloads.country [units] [grid]``.

Lays out a made-up country as large as the real inputs (14.45 million units on
360,000 meshblocks, six layers of polygons for each census) and times the whole
build on it.  Writes to a new folder under the system's temporary folder.
"""

from __future__ import annotations

import json
import struct
import sys
import tempfile
import time

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areaweave import Namespaces, building_zones, residential_units, run_standard, two_way_match
from areaweave.operators.spatial.layers import edges_from_wkb

NS = Namespaces("202508")
# Areas each way, by layer: about as many as the real layers have.
LAYERS = {"ced": 12, "lga": 24, "poa": 50, "ra": 3, "sed": 20, "ucl": 40}
CORNERS = 50  # points on each side of a layer's polygons


def cell_wkb(spark: SparkSession, cells: int, size: float, corners: int) -> DataFrame:
    """A grid of square polygons with ``corners`` points on each side."""
    def shapes(batches):
        t = np.arange(corners) / corners
        zero, one = np.zeros(corners), np.ones(corners)
        x = np.concatenate([t, one, 1 - t, zero, [0.0]])
        y = np.concatenate([zero, t, one, 1 - t, [0.0]])
        head = struct.pack("<BIII", 1, 3, 1, len(x))
        for batch in batches:
            geom = [head + np.column_stack([(i % cells + x) * size, (i // cells + y) * size]).tobytes() for i in batch.id]
            yield pd.DataFrame({"id": batch.id, "geom": geom})
    return spark.range(cells * cells).mapInPandas(shapes, "id long, geom binary")


def lay_out(spark: SparkSession, units: int, grid: int) -> None:
    for db in ("gnaf_202508", "census_2016_bdys", "census_2021_bdys_gda94", "census_2016_data"):
        spark.sql(f"create database if not exists {db}")
    x, y = F.col("id") % grid, F.floor(F.col("id") / grid)

    def block(width: int):
        return F.concat_ws("_", F.floor(x / width), F.floor(y / width))

    mb = cell_wkb(spark, grid, 1.0, 1)
    old = [F.col("id").cast("string").alias("mb_code16"), F.lit("RESIDENTIAL").alias("mb_cat16"),
           block(2).alias("sa1_main16"), block(2).alias("sa1_7dig16"), block(12).alias("sa2_main16"), block(12).alias("sa2_name16")]
    new = [F.col("id").cast("string").alias("mb_code_2021"),
           F.when(F.col("id") % 9 == 0, "Parkland").otherwise("Residential").alias("mb_category_2021"),
           block(2).alias("sa1_code_2021"), block(12).alias("sa2_code_2021"), block(12).alias("sa2_name_2021")]
    for level, width in (("sa3", 36), ("sa4", 72)):
        old += [block(width).alias(f"{level}_code16"), block(width).alias(f"{level}_name16")]
        new += [block(width).alias(f"{level}_code_2021"), block(width).alias(f"{level}_name_2021")]
    old += [F.lit("g").alias(c) for c in ("gcc_code16", "gcc_name16", "ste_code16", "ste_name16")] + ["geom"]
    new += [F.lit("g").alias(c) for c in ("gccsa_code_2021", "gccsa_name_2021", "state_code_2021", "state_name_2021")] + ["geom"]
    mb.select(*old).write.mode("overwrite").saveAsTable("census_2016_bdys.mb_2016_aust")
    mb.select(*new).write.mode("overwrite").saveAsTable("census_2021_bdys_gda94.mb_2021_aust_gda94")
    for b, cells in LAYERS.items():
        shapes = cell_wkb(spark, cells, grid / cells, CORNERS)
        code = F.concat(F.lit(b), F.col("id").cast("string"))
        shapes.select(code.alias(f"{b}_code16"), code.alias(f"{b}_name16"), "geom").write.mode("overwrite").saveAsTable(
            f"census_2016_bdys.{b}_2016_aust")
        shapes.select(code.alias(f"{b}_code_2021"), code.alias(f"{b}_name_2021"), "geom").write.mode(
            "overwrite").saveAsTable(f"census_2021_bdys_gda94.{b}_2021_aust_gda94")
    # A third of all units crowd into one meshblock in a thousand.
    spot = F.when(F.col("id") % 3 == 0, F.pmod(F.xxhash64("id"), F.lit(grid * grid // 1000)) * 1000).otherwise(
        F.pmod(F.xxhash64("id"), F.lit(grid * grid)))
    people = spark.range(units).withColumnRenamed("id", "gid").select(
        F.col("gid"), F.concat(F.lit("GA"), F.col("gid")).alias("gnaf_pid"),
        F.col("gid").alias("id")).withColumn("spot", spot).drop("id")
    people.select("gid", "gnaf_pid", F.col("spot").alias("mb_2016_code"), F.col("spot").cast("string").alias("mb_2021_code"),
                  F.lit("NSW").alias("state"), (F.col("gid") % 6).alias("reliability")).write.mode("overwrite").saveAsTable(
        "gnaf_202508.address_principals")
    place = people.withColumn("id", F.col("spot"))
    place.select("gnaf_pid", block(5).alias("locality_pid"), block(5).alias("locality_name"), block(11).alias("postcode"),
                 F.lit("NSW").alias("state"), block(25).alias("lga_pid"), block(25).alias("lga_name")).write.mode(
        "overwrite").saveAsTable("gnaf_202508.address_principal_admin_boundaries")
    for b, source in {"sa2": "sa2_main16", "sa3": "sa3_code16", "sa4": "sa4_code16", "gccsa": "gcc_code16", "ste": "ste_code16"}.items():
        spark.table("census_2016_bdys.mb_2016_aust").groupBy(F.col(source).alias("region_id")).agg(
            (F.count("*") * 40.0).cast("double").alias("g3")).write.mode("overwrite").saveAsTable(f"census_2016_data.{b}_g01")
    for b in ("lga", "poa", "ra"):
        share = grid * grid * 40.0 / LAYERS[b] ** 2
        spark.table(f"census_2016_bdys.{b}_2016_aust").select(
            F.col(f"{b}_code16").alias("region_id"), F.lit(share).alias("g3")).write.mode("overwrite").saveAsTable(
            f"census_2016_data.{b}_g01")


def buildings(spark: SparkSession, units: int) -> tuple[DataFrame, DataFrame]:
    zones = F.element_at(F.array(*[F.lit(z) for z in ("Low Density Residential", "Industrial", None, "Rural", "General Residential")]),
                         (F.col("id") % 5 + 1).cast("int"))
    blg = spark.range(units).select(F.col("id").alias("building_pid"), zones.alias("planning_zone"))
    address = spark.range(units * 4 // 3).select(
        F.concat(F.lit("GA"), F.pmod(F.xxhash64("id"), F.lit(units * 5 // 4))).alias("address_detail_pid"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(units)).alias("building_pid"))
    return address, blg


def main() -> None:
    units = int(sys.argv[1]) if len(sys.argv) > 1 else 14_451_352
    grid = int(sys.argv[2]) if len(sys.argv) > 2 else 600
    # The warehouse and the export; on a cluster, a folder that all machines share.
    root = sys.argv[3] if len(sys.argv) > 3 else tempfile.mkdtemp(prefix="run-")
    spark = (SparkSession.builder.master("local[8]").appName("areaweave-country")
             .config("spark.driver.memory", "20g").config("spark.sql.shuffle.partitions", "32")
             .config("spark.sql.warehouse.dir", f"{root}/warehouse").config("spark.local.dir", f"{root}/local")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    times = {}

    def clock(name, work):
        start = time.perf_counter()
        work()
        times[name] = round(time.perf_counter() - start, 1)
        print(name, times[name], flush=True)

    def noop(df):
        df.write.format("noop").mode("overwrite").save()

    clock("lay out inputs (not part of the build)", lambda: lay_out(spark, units, grid))
    clock("full standard build", lambda: run_standard(spark, NS, export_path=f"{root}/export", publish_to="gnaf_202508_copy", buckets=32))
    address, blg = buildings(spark, units)
    c16 = spark.table("census_2016_bdys.mb_2016_aust").select(F.col("mb_code16").cast("long").alias("mb_code"), F.col("mb_cat16").alias("mb_category"))
    c21 = spark.table("census_2021_bdys_gda94.mb_2021_aust_gda94").select(F.col("mb_code_2021").alias("mb_code"), F.col("mb_category_2021").alias("mb_category"))
    clock("classify residential units", lambda: noop(residential_units(
        spark.table("gnaf_202508.address_principals"), c16, c21, building_zones(address, blg))))

    def lga(db, code):
        return edges_from_wkb(spark.table(db), "lga", F.col(code), F.col(code), F.col("geom"))

    clock("two-way match of 576 by 576 areas", lambda: noop(two_way_match(
        lga("census_2016_bdys.lga_2016_aust", "lga_code16"), lga("census_2021_bdys_gda94.lga_2021_aust_gda94", "lga_code_2021"))))
    counts = {t: spark.table(f"gnaf_202508.{t}").count() for t in ("boundary_concordance", "boundary_concordance_score",
                                                                   "address_principal_census_2021_boundaries")}
    print(json.dumps({"units": units, "meshblocks": grid * grid, "seconds": times, "rows": counts}))


if __name__ == "__main__":
    main()
