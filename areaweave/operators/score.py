"""How well a crosswalk keeps areas together, and what that costs in error."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areaweave.config import CENSUS_2016, NESTED_LEVELS, PAIR_COLUMNS
from areaweave.functions import round_half_even, to_numeric


def _weighted() -> list:
    # Counts times stored percents in fixed point: the same sum in any order.
    count = F.col("address_count").cast("decimal(18,0)")
    return [F.sum(count * F.col("address_percent")).alias("weighted_address_count"),
            F.sum("address_count").alias("address_count")]


def score(crosswalk: DataFrame) -> DataFrame:
    """Mean percent per pair, weighted by units, as a whole number; in order of the pairs."""
    ratio = F.col("weighted_address_count").cast("double") / F.col("address_count").cast("double")
    return (crosswalk.groupBy(*PAIR_COLUMNS).agg(*_weighted())
            .select(*PAIR_COLUMNS, round_half_even(ratio, "smallint").alias("concordance_percent"))
            .orderBy(*PAIR_COLUMNS))


def weighted_percent_by_id(crosswalk: DataFrame, by: Sequence[str] = ("from_id",)) -> DataFrame:
    """Weighted mean percent of each ``from`` id."""
    ratio = F.col("weighted_address_count").cast("double") / F.col("address_count").cast("double")
    return (crosswalk.groupBy(*by).agg(*_weighted())
            .withColumn("weighted_percent", ratio))


def error_rate(crosswalk: DataFrame, indicators: DataFrame, source: str = CENSUS_2016,
               nested: Sequence[str] = NESTED_LEVELS) -> DataFrame:
    """Error of estimating an indicator through the crosswalk, per pair.

    ``indicators`` is long: ``bdy, region_id, value``.  Each pair inside
    ``source`` carries the value over to its ``to`` areas, compares it with
    the value published there and reports the summed difference in percent.
    Pairs of two nested levels have none by construction and are left out.
    """
    used = crosswalk.filter((F.col("from_source") == source) & (F.col("to_source") == source)
                            & ~(F.col("from_bdy").isin(*nested) & F.col("to_bdy").isin(*nested)))
    start = indicators.select(F.col("bdy").alias("from_bdy"), F.col("region_id").alias("from_id"),
                              F.col("value").cast("double").alias("value"))
    # The to_name is kept in the key: an id published under two names is compared twice.
    carried = (used.join(start, ["from_bdy", "from_id"])
               .groupBy(*PAIR_COLUMNS, "to_id", "to_name")
               .agg(round_half_even(F.sum(F.col("value") * F.col("address_percent").cast("double") / 100.0))
                    .alias("estimate")))
    end = indicators.select(F.col("bdy").alias("to_bdy"), F.col("region_id").alias("to_id"),
                            F.col("value").cast("double").alias("value"))
    error = F.try_divide(F.sum(F.abs(F.col("value") - F.col("estimate"))), F.sum("value")) * 100.0
    return (carried.join(end, ["to_bdy", "to_id"])
            .groupBy(*PAIR_COLUMNS).agg(to_numeric(error, 5, 1).alias("error_percent")))


def score_with_error(crosswalk: DataFrame, indicators: DataFrame, source: str = CENSUS_2016,
                     nested: Sequence[str] = NESTED_LEVELS) -> DataFrame:
    """The score table: ``error_percent`` is 0.0 for nested pairs of ``source``,
    measured for its other pairs, and NULL for every other source.  In order of the pairs.

    Equal to ``score`` with ``error_rate``, but the crosswalk is read once: its sums by pair and ``to`` area
    go on as two rows, one with the weights and one with the estimate, which alone meets the published values.
    """
    inside = (F.col("from_source") == source) & (F.col("to_source") == source)
    is_nested = inside & F.col("from_bdy").isin(*nested) & F.col("to_bdy").isin(*nested)
    # An id published twice carries both values over, as a join with both rows would.
    start = indicators.groupBy(F.col("bdy").alias("from_bdy"), F.col("region_id").alias("from_id")).agg(
        F.sum(F.col("value").cast("double")).alias("value"))
    shared = F.when(inside & ~is_nested, F.col("value") * F.col("address_percent").cast("double") / 100.0)
    sums = (crosswalk.join(start, ["from_bdy", "from_id"], "left")
            .groupBy(*PAIR_COLUMNS, "to_id", "to_name").agg(*_weighted(), F.sum(shared).alias("estimate")))
    none = F.lit(None)
    weights = F.struct(none.cast("string").alias("region_id"), F.col("weighted_address_count"), F.col("address_count"),
                       none.cast("bigint").alias("estimate"))
    carried = F.struct(F.col("to_id").alias("region_id"), none.cast("decimal(38,1)").alias("weighted_address_count"),
                       none.cast("bigint").alias("address_count"), round_half_even(F.col("estimate")).cast("bigint").alias("estimate"))
    weights = weights.withField("weighted_address_count", F.col("weighted_address_count").cast("decimal(38,1)"))
    rows = sums.select(*PAIR_COLUMNS, F.explode(F.when(F.col("estimate").isNull(), F.array(weights)).otherwise(
        F.array(weights, carried))).alias("r")).select(*PAIR_COLUMNS, "r.*")
    end = indicators.select(F.col("bdy").alias("to_bdy"), "region_id", F.col("value").cast("double").alias("value"))
    error = F.try_divide(F.sum(F.abs(F.col("value") - F.col("estimate"))),
                         F.sum(F.when(F.col("estimate").isNotNull(), F.col("value")))) * 100.0
    ratio = F.sum("weighted_address_count").cast("double") / F.sum("address_count").cast("double")
    scored = rows.join(end, ["to_bdy", "region_id"], "left").groupBy(*PAIR_COLUMNS).agg(
        round_half_even(ratio, "smallint").alias("concordance_percent"), to_numeric(error, 5, 1).alias("error_percent"))
    return (scored.withColumn("error_percent", F.when(is_nested, to_numeric(F.lit(0.0), 5, 1)).otherwise(F.col("error_percent")))
            .select(*PAIR_COLUMNS, "concordance_percent", "error_percent").orderBy(*PAIR_COLUMNS))


def compare_official(crosswalk: DataFrame, official: DataFrame, threshold: float | None = None,
                     from_column: str = "sa2_maincode_2016",
                     to_column: str = "sa2_code_2021") -> DataFrame:
    """One row of differences between official ratios and the crosswalk.

    Rows meet on the two ids alone; pass a slice to compare a single pair.
    ``threshold`` keeps only differences above that many percentage points.
    """
    theirs = official.select(F.col(from_column).alias("from_id"), F.col(to_column).alias("to_id"),
                             (F.col("ratio_from_to") * 100.0).alias("_official"))
    delta = crosswalk.join(theirs, ["from_id", "to_id"]).withColumn(
        "delta", F.col("_official") - F.col("address_percent").cast("double"))
    if threshold is not None:
        delta = delta.filter(F.abs("delta") > threshold)
    return delta.agg(
        F.count(F.lit(1)).alias("bdy_pair_count"),
        round_half_even(F.sqrt(F.avg(F.pow("delta", F.lit(2)))), "smallint").alias("rmse"),
        round_half_even(F.avg("delta"), "smallint").alias("mean_delta"),
        round_half_even(F.min("delta"), "smallint").alias("min_delta"),
        round_half_even(F.max("delta"), "smallint").alias("max_delta"),
        round_half_even(F.sum(F.abs("delta") * F.col("address_count")) / 100.0).alias("address_count"))
