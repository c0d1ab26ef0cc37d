"""Pairs of exactly nested levels: every smaller area lies whole in a larger one."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areaweave.config import CROSSWALK_COLUMNS, Boundary, level_pairs
from areaweave.functions import to_numeric


def units_per_atom(units: DataFrame, atom_key: str) -> DataFrame:
    return (units.select(F.col(atom_key).cast("string").alias("_atom"))
            .filter("_atom is not null")
            .groupBy("_atom").agg(F.count(F.lit(1)).alias("_units")))


def nested_pairs(atoms: DataFrame, units: DataFrame, source: str, atom_id: str, unit_atom: str,
                 levels: Sequence[str], columns: Mapping[str, Boundary]) -> DataFrame:
    """Crosswalk rows at 100 percent for every smaller/larger pair of ``levels``.

    Units are counted per atom before they meet the atoms, so a crowded atom
    costs one row, and all level pairs come from one pass over the atoms.
    There is no residential filter and no test for NULL ids.
    """
    weighted = atoms.join(units_per_atom(units, unit_atom),
                          F.col(atom_id).cast("string") == F.col("_atom"))
    pairs = F.array(*[
        F.struct(F.lit(a).alias("from_bdy"), columns[a].id_column().alias("from_id"),
                 columns[a].name_column().cast("string").alias("from_name"),
                 F.lit(b).alias("to_bdy"), columns[b].id_column().alias("to_id"),
                 columns[b].name_column().cast("string").alias("to_name"))
        for a, b in level_pairs(levels)])
    keys = ["from_bdy", "from_id", "from_name", "to_bdy", "to_id", "to_name"]
    counted = (weighted.select("_units", F.explode(pairs).alias("p")).select("p.*", "_units")
               .groupBy(*keys).agg(F.sum("_units").alias("address_count")))
    return (counted.withColumns({"from_source": F.lit(source), "to_source": F.lit(source),
                                 "address_percent": to_numeric(F.lit(100.0), 4, 1)})
            .select(*CROSSWALK_COLUMNS))
