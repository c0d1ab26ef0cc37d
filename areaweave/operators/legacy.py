"""The earlier crosswalk form: state columns, whole-number percents and manual
fixes for units whose target is missing."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areaweave.functions import concat_skip_nulls
from areaweave.operators.pairs import legacy_counts


class Override(NamedTuple):
    """A target for the units whose ``key`` column equals ``key``."""

    key: str
    target_id: str
    target_name: str


# The target of a whole state, applied whether or not one is set,
# and those of single localities, applied only where the target is missing.
STATE_OVERRIDES = (Override("ACT", "lgaact9999991", "Unincorporated - ACT"),)
LOCALITY_OVERRIDES = (
    Override("locc15e0d2d6f2a", "lgaot9999991", "Unincorporated - Norfolk Island"),
    Override("loced195c315de9", "lgaot9999992", "Unincorporated - Jervis Bay"),
    Override("250190776", "lgasa9999991", "Unincorporated - Thistle Island"),
    Override("loc0f7a581b85b7", "lgacbffb11990f2", "Hobart City"),
    Override("loccf8be9dcdacd", "lgaa8d127fa14e7", "Ceduna"),
    Override("loc552bd3aef1b8", "lga7872e04f6637", "Tenterfield"),
)


def _first_match(key: Column, overrides: Sequence[Override]) -> Column | None:
    chosen = None
    for o in overrides:
        target = F.struct(F.lit(o.target_id).alias("target_id"), F.lit(o.target_name).alias("target_name"))
        chosen = F.when(key == o.key, target) if chosen is None else chosen.when(key == o.key, target)
    return chosen


def apply_overrides(units: DataFrame, always: Sequence[Override] = STATE_OVERRIDES,
                    when_missing: Sequence[Override] = LOCALITY_OVERRIDES,
                    always_key: str = "target_state", missing_key: str = "locality_pid") -> DataFrame:
    """Fix ``target_id`` and ``target_name``, then drop units still without one.

    The unconditional rules win over a target already set; among the rules for
    missing targets the first match wins, as it sets the target for the rest.
    """
    current = F.struct("target_id", "target_name")
    fixed = F.when(F.col("target_id").isNotNull(), current)
    for key, rules, missing in ((missing_key, when_missing, True), (always_key, always, False)):
        match = _first_match(F.col(key), rules)
        if match is not None:
            fixed = F.coalesce(fixed, match) if missing else F.coalesce(match, fixed)
    return (units.withColumn("_fixed", fixed)
            .withColumns({"target_id": F.col("_fixed.target_id"),
                          "target_name": F.col("_fixed.target_name")})
            .drop("_fixed").filter("target_id is not null"))


def legacy_units(units: DataFrame, admin: DataFrame) -> DataFrame:
    """Source postcode and target council of every unit, before fixes."""
    source = units.select("gnaf_pid", F.col("postcode").alias("source_id"),
                          concat_skip_nulls(F.col("state"), F.lit(" "), F.col("postcode")).alias("source_name"),
                          F.col("state").alias("source_state"))
    target = admin.select("gnaf_pid", "locality_pid", F.col("lga_pid").alias("target_id"),
                          F.col("lga_name").alias("target_name"), F.col("state").alias("target_state"))
    return source.join(target, "gnaf_pid")


def legacy_pair(units: DataFrame, source_type: str, target_type: str,
                always: Sequence[Override] = STATE_OVERRIDES,
                when_missing: Sequence[Override] = LOCALITY_OVERRIDES) -> DataFrame:
    """Fix targets, count, and keep the pairs of at least half a percent."""
    return legacy_rows(legacy_counts(apply_overrides(units, always, when_missing)),
                       source_type, target_type)


def legacy_rows(counts: DataFrame, source_type: str, target_type: str) -> DataFrame:
    return counts.select(
        F.lit(source_type).alias("source_type"), "source_id", "source_name", "source_state",
        F.lit(target_type).alias("target_type"), "target_id", "target_name", "target_state",
        "address_count", "total_source_addresses", "percent_source_addresses")
