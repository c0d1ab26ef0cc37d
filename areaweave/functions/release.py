"""Quarterly release labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _label(date: Column, months_back: int) -> Column:
    # Releases come out in the second month of each quarter, so going back one
    # month lines them up with calendar quarters.
    day = F.add_months(date, -months_back)
    month = F.lpad((F.quarter(day) * 3 - 1).cast("string"), 2, "0")
    return F.concat(F.year(day).cast("string"), month)


def release_version(date: Column) -> Column:
    """Struct of the ``current`` and ``previous`` release (``YYYYMM``) on a date."""
    return F.struct(_label(date, 1).alias("current"), _label(date, 4).alias("previous"))
