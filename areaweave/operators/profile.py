"""Unit counts by any keys, and population projected from unit growth."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areaweave.functions import round_half_even


def unit_profile(units: DataFrame, keys: Sequence[str], where: Column | None = None,
                 limit: int | None = None) -> DataFrame:
    """Units per combination of keys, ordered by the keys with NULL last and then
    by count, largest first.  ``limit`` makes it a top-k report."""
    kept = units if where is None else units.filter(where)
    counts = kept.groupBy(*keys).agg(F.count(F.lit(1)).alias("address_count"))
    ordered = counts.orderBy(*[F.col(k).asc_nulls_last() for k in keys], F.desc("address_count"))
    return ordered if limit is None else ordered.limit(limit)


def project_population(atoms: DataFrame, old_units: DataFrame, new_units: DataFrame,
                       atom_id: str = "mb_code", person: str = "person") -> DataFrame:
    """Scale each atom's population by the growth of its unit count.

    Atoms that had no units keep a projection of zero.
    """
    def per_atom(units: DataFrame, name: str) -> DataFrame:
        return units.groupBy(atom_id).agg(F.count(F.lit(1)).alias(name))

    projected = F.when(F.col("old_count") > 0,
                       round_half_even(F.try_divide(F.col(person).cast("double"),
                                                    F.col("old_count").cast("double")) * F.col("new_count")))
    return (atoms.join(per_atom(old_units, "old_count"), atom_id, "left")
            .join(per_atom(new_units, "new_count"), atom_id, "left")
            .withColumns({c: F.coalesce(c, F.lit(0)) for c in ("old_count", "new_count")})
            .withColumn("projected", F.coalesce(projected, F.lit(0))))
