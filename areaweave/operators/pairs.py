"""Weighted many-to-many crosswalks between two boundary types."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areaweave.config import CROSSWALK_COLUMNS, EVERYONE, Pair, Registry, Residential
from areaweave.functions import round_half_even, to_numeric
from areaweave.operators.joins import lookup_join


def with_total(counts: DataFrame, by: Sequence[str], total: str = "total",
               n: str = "address_count") -> DataFrame:
    """Add each group's total as a column; NULL keys form a group like any other.

    Written as an aggregate joined back instead of a window: one ``from`` area
    may hold a large share of all rows, and a window would sort that whole
    group in one task.  The aggregate combines before its shuffle and reuses
    that of the counts.
    """
    return lookup_join(counts, counts.groupBy(*by).agg(F.sum(n).alias(total)), by)


def percent_of(part: Column, whole: Column) -> Column:
    """Share in percent: divide first, then scale."""
    return part.cast("double") / whole.cast("double") * F.lit(100.0)


def with_percent(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Turn counts into ``address_percent``; the test for zero is on the exact share."""
    shared = with_total(counts, by).withColumn(
        "_percent", percent_of(F.col("address_count"), F.col("total")))
    return (shared.filter(F.col("_percent") > 0.0)
            .withColumn("address_percent", to_numeric(F.col("_percent"), 4, 1))
            .drop("_percent", "total"))


def side_columns(registry: Registry, source: str, bdy: str, side: str) -> list[Column]:
    """Id and name of a boundary, named for one side of a pair."""
    boundary = registry[source].boundary(bdy)
    return [boundary.id_column().alias(f"{side}_id"), boundary.name_column().alias(f"{side}_name")]


def keep_residential(table: DataFrame, registry: Registry, source: str,
                     residential: Residential) -> DataFrame:
    values = residential.values(source)
    if values is None:
        return table
    category = registry[source].category
    if category is None:
        raise ValueError(f"source {source!r} has no category column")
    return table.filter(F.col(category).isin(*values))


def pair_units(tables: Mapping[str, DataFrame], registry: Registry, pair: Pair,
               residential: Residential = EVERYONE, flags: DataFrame | None = None) -> DataFrame:
    """One row per unit with both ids of a pair; filters run before the join."""
    source, target = registry[pair.from_source], registry[pair.to_source]
    left = keep_residential(tables[source.name], registry, source.name, residential)
    from_cols = side_columns(registry, source.name, pair.from_bdy, "from")
    to_cols = side_columns(registry, target.name, pair.to_bdy, "to")
    if source.name == target.name:
        units = left.select(F.col(source.unit_id).alias("unit_id"), *from_cols, *to_cols)
    else:
        right = keep_residential(tables[target.name], registry, target.name, residential)
        units = (left.select(F.col(source.unit_id).alias("unit_id"), *from_cols)
                 .filter("from_id is not null")
                 .join(right.select(F.col(target.unit_id).alias("unit_id"), *to_cols)
                       .filter("to_id is not null"), "unit_id"))
    if residential.by_flag:
        if flags is None:
            raise ValueError("a residential rule by flag needs the table of classified units")
        units = units.join(
            flags.filter("is_residential").select(F.col(source.unit_id).alias("unit_id")),
            "unit_id", "left_semi")
    return units.filter("from_id is not null and to_id is not null")


def label_pair(df: DataFrame, pair: Pair) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in pair._asdict().items()})


def count_pair(units: DataFrame) -> DataFrame:
    return (units.groupBy("from_id", "from_name", "to_id", "to_name")
            .agg(F.count(F.lit(1)).alias("address_count")))


def build_pair(tables: Mapping[str, DataFrame], registry: Registry, pair: Pair,
               residential: Residential = EVERYONE, flags: DataFrame | None = None) -> DataFrame:
    """Crosswalk rows of one pair.

    ``address_percent`` is the share of the ``from`` id's units, whatever name
    they carry; the result has the ten crosswalk columns.
    """
    counts = count_pair(pair_units(tables, registry, pair, residential, flags))
    return label_pair(with_percent(counts, ["from_id"]), pair).select(*CROSSWALK_COLUMNS)


def build_pair_for(tables: Mapping[str, DataFrame], registry: Registry, pair: Pair,
                   from_ids: Sequence[str], residential: Residential = EVERYONE) -> DataFrame:
    """Crosswalk of some ``from`` ids with the percent left unrounded."""
    units = pair_units(tables, registry, pair, residential).filter(F.col("from_id").isin(*from_ids))
    shared = with_total(count_pair(units), ["from_id"]).withColumn(
        "percent", percent_of(F.col("address_count"), F.col("total")))
    return label_pair(shared.drop("total"), pair).select(*CROSSWALK_COLUMNS[:-1], "percent")


def same_table_pair(units: DataFrame, from_label: str, from_id: str, from_name: str,
                    to_label: str, to_id: str, to_name: str) -> DataFrame:
    """Crosswalk between two columns of one tag table: every unit counts, NULL
    ids form a group of their own and the percent is not rounded."""
    counts = (units.select(F.col(from_id).alias("from_id"), F.col(from_name).alias("from_name"),
                           F.col(to_id).alias("to_id"), F.col(to_name).alias("to_name"))
              .groupBy("from_id", "from_name", "to_id", "to_name")
              .agg(F.count(F.lit(1)).alias("address_count")))
    shared = with_total(counts, ["from_id"]).withColumn(
        "percent_from_addresses", percent_of(F.col("address_count"), F.col("total")))
    return (shared.filter("percent_from_addresses > 0")
            .select(F.lit(from_label).alias("from_bdy"), "from_id", "from_name",
                    F.lit(to_label).alias("to_bdy"), "to_id", "to_name",
                    "address_count", "percent_from_addresses"))


def legacy_counts(units: DataFrame) -> DataFrame:
    """Counts by source and target id, name and state, with the source's total
    and a whole-number percent; shares that round to zero are dropped."""
    keys = ["source_id", "source_name", "source_state", "target_id", "target_name", "target_state"]
    counts = units.groupBy(*keys).agg(F.count(F.lit(1)).alias("address_count"))
    shared = with_total(counts, ["source_id"], "total_source_addresses")
    percent = percent_of(F.col("address_count"), F.col("total_source_addresses"))
    return (shared.withColumn("percent_source_addresses", round_half_even(percent, "smallint"))
            .filter("percent_source_addresses > 0"))
