"""Classifying units as residential from building zones and atom categories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# How planning zones are matched, joined and named when missing.
ZONE_WORD = "residential"
UNKNOWN_ZONE = "unknown"
ZONE_DELIMITER = " - "


def building_zones(building_address: DataFrame, buildings: DataFrame,
                   unit: str = "address_detail_pid", building: str = "building_pid",
                   zone: str = "planning_zone") -> DataFrame:
    """Per unit: its buildings' distinct zones in order, and how many there are.

    The set is merged on the map side, so a unit with very many buildings still
    sends only its distinct zones.
    """
    zones = F.coalesce(F.lower(F.col(zone)), F.lit(UNKNOWN_ZONE))
    return (building_address.filter(F.col(unit).isNotNull()).select(unit, building)
            .join(buildings.select(building, zone), building)
            .groupBy(F.col(unit).alias("unit_id"))
            .agg(F.array_join(F.array_sort(F.collect_set(zones)), ZONE_DELIMITER).alias("planning_zone"),
                 F.count(F.lit(1)).alias("building_count")))


def residential_flag(zone: Column, building_count: Column, category: Column) -> Column:
    """True, false or NULL (undecided), by the first rule that applies:

    a residential zone among the unit's buildings; any other known zone; else
    whether the atom's category is residential, if it has one.
    """
    return (F.when(zone.contains(ZONE_WORD), True)
            .when((building_count > 0) & (zone != UNKNOWN_ZONE), False)
            .when(category == ZONE_WORD, True)
            .when(category != ZONE_WORD, False))


def residential_units(units: DataFrame, categories_2016: DataFrame, categories_2021: DataFrame,
                      zones: DataFrame, unit_id: str = "gnaf_pid",
                      keep: tuple[str, ...] = ("reliability", "state")) -> DataFrame:
    """Units with zones, building counts, both atom categories and the flag.

    ``categories_*`` have columns ``mb_code, mb_category``; units without either
    atom drop out, units without buildings stay.
    """
    c16 = categories_2016.select(F.col("mb_code").alias("mb_2016_code"),
                                 F.lower("mb_category").alias("mb_category_2016"))
    c21 = categories_2021.select(F.col("mb_code").alias("mb_2021_code"),
                                 F.lower("mb_category").alias("mb_category_2021"))
    blg = zones.withColumnRenamed("unit_id", unit_id)
    classified = (units.select(unit_id, *keep, "mb_2016_code", "mb_2021_code")
                  .join(blg, unit_id, "left")
                  .join(c16, "mb_2016_code").join(c21, "mb_2021_code")
                  .withColumn("building_count", F.coalesce("building_count", F.lit(0))))
    flag = residential_flag(F.col("planning_zone"), F.col("building_count"), F.col("mb_category_2021"))
    return classified.withColumn("is_residential", flag).select(
        unit_id, *keep, "planning_zone", "is_residential", "building_count",
        "mb_2016_code", "mb_category_2016", "mb_2021_code", "mb_category_2021")


def reconcile(units: DataFrame, buildings: DataFrame, unit_id: str = "gnaf_pid",
              building_unit: str = "address_detail_pid", label: str = "is_residential") -> DataFrame:
    """Match units with the units buildings are registered for.

    Per building label: building count, units in both tables, units only, and
    building-side units only.  The label is NULL for units without buildings.
    """
    blg = (buildings.groupBy(F.col(building_unit).alias("_blg_unit"), F.col(label).alias("_raw"))
           .agg(F.count(F.lit(1)).alias("building_count"))
           .withColumn(label, F.coalesce("_raw", F.lit("unknown"))))
    both = units.select(F.col(unit_id).alias("_unit")).join(
        blg, F.col("_unit") == F.col("_blg_unit"), "full_outer")
    left, right = F.col("_unit").isNotNull(), F.col("_blg_unit").isNotNull()

    def tally(condition: Column) -> Column:
        return F.sum(F.when(condition, 1).otherwise(0))

    return both.groupBy(label).agg(
        F.sum("building_count").alias("building_count"),
        tally(left & right).alias("match_count"),
        tally(left & ~right).alias("unit_only_count"),
        tally(~left & right).alias("building_only_count"))


def category_disagreement(units: DataFrame, label: str, category: str, atom: str,
                          equals: str | None = None) -> DataFrame:
    """Units whose two labels differ, and how many atoms they lie in."""
    differ = units.filter(F.col(label) != F.col(category))
    if equals is not None:
        differ = differ.filter(F.col(label) == equals)
    return differ.agg(F.count(F.lit(1)).alias("address_count"),
                      F.countDistinct(atom).alias("mb_count"))
