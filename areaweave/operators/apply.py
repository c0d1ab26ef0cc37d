"""Using a crosswalk: slice it, carry a dataset over, join it with another."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areaweave.config import Pair
from areaweave.functions import concat_skip_nulls, round_half_even, to_numeric
from areaweave.operators.pairs import percent_of


def slice_pair(crosswalk: DataFrame, pair: Pair) -> DataFrame:
    """Rows of one pair; prunes partitions of a crosswalk written by pair."""
    return lookup(crosswalk, **pair._asdict())


def lookup(crosswalk: DataFrame, from_ids: Sequence[str] | None = None,
           to_ids: Sequence[str] | None = None, below_percent: float | None = None,
           **equals: str) -> DataFrame:
    """Rows matching the given columns, id lists and upper bound on the percent."""
    found = crosswalk
    for column, value in equals.items():
        found = found.filter(F.col(column) == value)
    if from_ids is not None:
        found = found.filter(F.col("from_id").isin(*from_ids))
    if to_ids is not None:
        found = found.filter(F.col("to_id").isin(*to_ids))
    if below_percent is not None:
        found = found.filter(F.col("address_percent") < below_percent)
    return found


def apportion(indicator: DataFrame, key: str, values: Sequence[str], crosswalk: DataFrame) -> DataFrame:
    """Carry value columns over to the crosswalk's ``to`` areas.

    Each value is spread by percent and summed to a whole number; next to it
    comes ``<value>_qa_count``, the plain sum of what contributed, and once the
    number of contributing rows.
    """
    percent = F.col("address_percent").cast("double")
    sums = [agg for v in values for agg in (
        round_half_even(F.sum(F.col(v).cast("double") * percent / 100.0)).alias(v),
        F.sum(v).alias(f"{v}_qa_count"))]
    joined = (indicator.select(F.col(key).alias("from_id"), *values)
              .join(crosswalk.select("from_id", "to_id", "to_name", "address_percent"), "from_id"))
    return joined.groupBy("to_id", "to_name").agg(*sums, F.count(F.lit(1)).alias("from_count"))


def rate(carried: DataFrame, value: str, other: DataFrame, other_key: str, other_value: str,
         rate_name: str = "rate_percent", how: str = "inner") -> DataFrame:
    """Carried-over ``value`` as a percent of another dataset's value.

    Also reports how much of the contributing total arrived in each area; areas
    in only one dataset drop out unless ``how`` says otherwise.
    """
    if how not in ("inner", "left", "right", "full"):
        raise ValueError(f"unsupported join type {how!r}")
    base = other.select(F.col(other_key).alias("to_id"), F.col(other_value))
    # NULL instead of an error where the divisor is zero.
    whole = F.nullif(F.col(other_value), F.lit(0))
    qa = F.nullif(F.col(f"{value}_qa_count"), F.lit(0))
    return (carried.join(base, "to_id", how)
            .select("to_id", "to_name", other_value, value,
                    to_numeric(percent_of(F.col(value), whole), 4, 1).alias(rate_name),
                    round_half_even(percent_of(F.col(value), qa), "smallint").alias("concordance_percent"),
                    "from_count"))


def rollup_indicator(raw: DataFrame, key: str, value: str, prefix: str = "",
                     name: str | None = None) -> DataFrame:
    """Sum raw rows per key; an optional prefix completes the published code."""
    summed = raw.groupBy(key).agg(F.sum(value).alias(name or value))
    return summed.withColumn(key, concat_skip_nulls(F.lit(prefix), F.col(key))) if prefix else summed
