"""Joining many rows to a table with one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_join(rows: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join ``rows``, a third of which may share one key, to ``lookup``.

    The join goes by a struct of the keys.  A lookup that was just aggregated or
    joined already lies by its plain keys and would be used as it lies; a hot key
    then stays in one task.  By struct, both sides come straight from a shuffle,
    which is what adaptive execution needs to split a hot key, or to broadcast the
    lookup where it proves small.  NULL keys match each other.
    """
    key = F.struct(*keys)
    right = lookup.withColumn("_key", key).drop(*keys)
    return rows.withColumn("_key", key).join(right, "_key", how).drop("_key")
