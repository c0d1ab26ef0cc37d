"""Delimited files and the crosswalk's stored layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from areaweave.config import CROSSWALK_COLUMNS, PAIR_COLUMNS


# Columns of the files read and written.
CROSSWALK_SCHEMA = (
    "from_source string not null, from_bdy string not null, from_id string not null, "
    "from_name string not null, to_source string not null, to_bdy string not null, "
    "to_id string not null, to_name string not null, address_count bigint, address_percent decimal(4,1)")
SCORE_SCHEMA = (
    "from_source string, from_bdy string, to_source string, to_bdy string, "
    "concordance_percent smallint, error_percent decimal(5,1)")
CORRESPONDENCE_SCHEMA = (
    "sa2_maincode_2016 string, sa2_name_2016 string, sa2_code_2021 string, sa2_name_2021 string, "
    "ratio_from_to double, indiv_to_region_qlty_indicator string, overall_quality_indicator string, "
    "bmos_null_flag smallint")
CASES_BY_POSTCODE = "postcode string not null, cases int not null"
CASES_BY_LGA = "lga_code19 string not null, cases int not null"
TESTS_BY_POSTCODE = "postcode string not null, tests int not null"
TESTS_BY_LGA = "lga_code19 string not null, tests int not null"
RAW_CASES_SCHEMA = (
    "notification_date date not null, postcode string not null, lhd_2010_code string not null, "
    "lhd_2010_name string not null, lga_code19 string not null, lga_name19 string not null, "
    "confirmed_by_pcr string not null, confirmed_cases_count int not null")
RAW_TESTS_SCHEMA = (
    "test_date date not null, postcode string not null, lhd_2010_code string not null, "
    "lhd_2010_name string not null, lga_code19 string not null, lga_name19 string not null, "
    "test_count int not null")


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A comma-separated file with a header that must match the schema.

    Codes stay text, so leading zeros and stand-ins such as ``None`` survive; a
    malformed row stops the read.
    """
    return (spark.read.schema(schema).option("header", True).option("enforceSchema", False)
            .option("escape", '"').option("mode", "FAILFAST").csv(path))


def read_crosswalk(spark: SparkSession, path: str, format: str = "csv") -> DataFrame:
    """A crosswalk exported as CSV, or stored by ``write_crosswalk``."""
    if format == "csv":
        return read_csv(spark, path, CROSSWALK_SCHEMA)
    return spark.read.schema(CROSSWALK_SCHEMA).parquet(path).select(*CROSSWALK_COLUMNS)


def write_crosswalk(crosswalk: DataFrame, path: str) -> None:
    """Store by pair, so that a slice reads its own folder only.

    Rebalancing gathers a pair's rows into few files but splits a pair that is
    too big for one task.
    """
    (crosswalk.hint("rebalance", *PAIR_COLUMNS).write.mode("overwrite")
     .partitionBy(*PAIR_COLUMNS).parquet(path))


def export_csv(df: DataFrame, path: str, order: Sequence[str] = tuple(PAIR_COLUMNS),
               compress: bool = False) -> None:
    """Write sorted CSV part files with headers; part order is row order.

    Ids refine the sort, which lets range partitioning split a large pair.
    """
    finer = [c for c in ("from_id", "to_id", "from_name", "to_name") if c in df.columns and c not in order]
    writer = df.orderBy(*order, *finer).write.mode("overwrite").option("header", True).option("escape", '"')
    if compress:
        writer = writer.option("compression", "gzip")
    writer.csv(path)
