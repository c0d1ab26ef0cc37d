"""Data-quality checks standing in for database constraints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys occurring more than once, or with a NULL part, and their row count."""
    has_null = F.lit(False)
    for key in keys:
        has_null = has_null | F.col(key).isNull()
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
            .filter((F.col("row_count") > 1) | has_null))


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Return ``df`` if the keys identify its rows, else raise with examples."""
    found = duplicate_keys(df, keys).limit(5).collect()
    if found:
        raise ValueError(f"keys {list(keys)} are not unique or not set, for example {found}")
    return df


def null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column that must be set: how many rows leave it NULL."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count"))
                      for c in columns])
    return counts.select(F.explode(pairs).alias("p")).select("p.*")


def dropped_units(units: DataFrame, tagged: DataFrame, unit_id: str) -> DataFrame:
    """Units that did not make it into the tagged table."""
    return units.join(tagged.select(unit_id), unit_id, "left_anti")


def row_parity(units: DataFrame, tagged: DataFrame, unit_id: str) -> DataFrame:
    """Input, tagged and lost unit counts in one row."""
    side = F.struct(F.lit(1).alias("u"), F.lit(0).alias("t"))
    other = F.struct(F.lit(0).alias("u"), F.lit(1).alias("t"))
    both = (units.select(unit_id, side.alias("s"))
            .unionByName(tagged.select(unit_id, other.alias("s")))
            .groupBy(unit_id).agg(F.sum("s.u").alias("u"), F.sum("s.t").alias("t")))
    return both.agg(F.sum("u").alias("unit_count"), F.sum("t").alias("tagged_count"),
                    F.sum(F.when(F.col("t") == 0, F.col("u")).otherwise(0)).alias("dropped_count"))


def percent_totals(crosswalk: DataFrame, percent: str = "address_percent",
                   by: Sequence[str] = ("from_id", "from_name")) -> DataFrame:
    """Number of targets and summed percent per ``from`` id, largest sum first."""
    return (crosswalk.groupBy(*by)
            .agg(F.count(F.lit(1)).alias("target_count"), F.sum(percent).alias("percent_total"))
            .orderBy(F.desc("percent_total"), *by))
