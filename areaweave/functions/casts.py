"""Casts and text functions whose Spark default differs from the SQL semantics
the crosswalk is defined with."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_even(value: Column, to: str = "bigint") -> Column:
    """Float to integer, ties to even.  A bare Spark cast would truncate."""
    return F.rint(value.cast("double")).cast(to)


def to_numeric(value: Column, precision: int, scale: int) -> Column:
    """Float to a fixed-point number, ties away from zero; overflow raises."""
    return value.cast(f"decimal({precision},{scale})")


def concat_skip_nulls(*values: Column) -> Column:
    """Concatenation that treats NULL as empty text instead of returning NULL."""
    return F.concat_ws("", *values)


def name_before(value: Column, delimiter: str = " (") -> Column:
    """The text before the first delimiter: ``Dungog (A)`` gives ``Dungog``."""
    return F.split_part(value, F.lit(delimiter), F.lit(1))


def varchar(value: Column, length: int) -> Column:
    """Cast to text cut at ``length`` characters."""
    return F.substring(value.cast("string"), 1, length)


def strip_prefix(value: Column, length: int = 3) -> Column:
    """Drop a fixed-length code prefix: ``LGA10050`` gives ``10050``."""
    return F.substring(value, F.lit(length + 1), F.length(value))
