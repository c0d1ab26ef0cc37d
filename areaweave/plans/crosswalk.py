"""All boundary pairs in one pass over the units.

Units are reduced to the distinct combinations of their tags with a weight.
Each combination then yields a row per pair, so one scan and one aggregate
serve every pair instead of one join and scan each.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areaweave.config import (
    CROSSWALK_COLUMNS, EVERYONE, PAIR_COLUMNS, Pair, Registry, Residential, Source,
)
from areaweave.operators.joins import lookup_join
from areaweave.operators.pairs import with_percent

WEIGHT = "_weight"


class AtomTags(NamedTuple):
    """Tags known per atom: the tag table, its code and the units' code column."""

    tags: DataFrame
    atom_id: str
    unit_atom: str


class _Layout:
    """Column names of the wide tag table."""

    def __init__(self, registry: Registry, pairs: Sequence[Pair], residential: Residential):
        used: dict[str, dict[str, None]] = {}
        for p in pairs:
            used.setdefault(p.from_source, {})[p.from_bdy.lower()] = None
            used.setdefault(p.to_source, {})[p.to_bdy.lower()] = None
        self.sources: list[Source] = [registry[name] for name in used]
        self.bdys = {name: list(bdys) for name, bdys in used.items()}
        self.residential = residential
        self._index = {s.name: i for i, s in enumerate(self.sources)}

    def name(self, source: str, bdy: str, part: str) -> str:
        return f"s{self._index[source]}_{bdy.lower()}_{part}"

    def home(self, source: str) -> str:
        return f"s{self._index[source]}_home"

    def project(self, source: Source) -> list[Column]:
        """The used boundaries of a source, and whether its category is kept."""
        columns = []
        for bdy in self.bdys[source.name]:
            boundary = source.boundary(bdy)
            columns += [boundary.id_column().alias(self.name(source.name, bdy, "id")),
                        boundary.name_column().alias(self.name(source.name, bdy, "name"))]
        values = self.residential.values(source.name)
        if values is not None:
            if source.category is None:
                raise ValueError(f"source {source.name!r} has no category column")
            columns.append(F.col(source.category).isin(*values).alias(self.home(source.name)))
        return columns

    def columns(self, source: Source) -> list[str]:
        names = [self.name(source.name, b, part) for b in self.bdys[source.name] for part in ("id", "name")]
        return names + ([self.home(source.name)] if self.residential.values(source.name) is not None else [])

    def row(self, index: int, pair: Pair) -> Column:
        """One pair's ids and names, or a NULL from_id if it does not apply."""
        keep = F.lit(True)
        for source in dict.fromkeys((pair.from_source, pair.to_source)):
            if self.residential.values(source) is not None:
                keep = keep & F.col(self.home(source))
        from_id = F.col(self.name(pair.from_source, pair.from_bdy, "id"))
        return F.struct(
            F.lit(index).alias("pair"), F.when(keep, from_id).alias("from_id"),
            F.col(self.name(pair.from_source, pair.from_bdy, "name")).alias("from_name"),
            F.col(self.name(pair.to_source, pair.to_bdy, "id")).alias("to_id"),
            F.col(self.name(pair.to_source, pair.to_bdy, "name")).alias("to_name"))


def _combinations(layout: _Layout, tagged: DataFrame) -> DataFrame:
    columns = [c for source in layout.sources for c in layout.columns(source)]
    return tagged.groupBy(*columns).agg(F.count(F.lit(1)).alias(WEIGHT))


def _from_unit_tables(layout: _Layout, tables: Mapping[str, DataFrame],
                      units: DataFrame | None) -> DataFrame:
    """Combinations of tag tables that are all keyed by unit.

    Left joins from the list of units keep its partitioning, so each tag table
    is shuffled once at most, and not at all if stored in buckets.
    """
    sides = [tables[s.name].select(F.col(s.unit_id).alias("unit_id"), *layout.project(s))
             for s in layout.sources]
    if units is None and len(sides) == 1:
        return _combinations(layout, sides[0])
    if units is None:
        units = reduce(DataFrame.unionByName, [side.select("unit_id") for side in sides]).distinct()
    return _combinations(layout, reduce(lambda left, side: left.join(side, "unit_id", "left"), sides, units))


def _from_atoms(layout: _Layout, units: DataFrame, unit_id: str, atoms: Mapping[str, AtomTags],
                tables: Mapping[str, DataFrame], flags: DataFrame | None) -> DataFrame:
    """Combinations where some sources' tags follow from the unit's atom.

    Units are counted by atom codes and the other tags first; the long atom tags
    join the combinations, not the units.
    """
    codes = {name: f"_code{i}" for i, name in enumerate(atoms)}
    base = units.select(F.col(unit_id).alias("unit_id"),
                        *[F.col(a.unit_atom).cast("string").alias(codes[name]) for name, a in atoms.items()])
    if flags is not None:
        base = base.join(flags, "unit_id", "left_semi")
    direct = [s for s in layout.sources if s.name not in atoms]
    for source in direct:
        side = tables[source.name].select(F.col(source.unit_id).alias("unit_id"), *layout.project(source))
        base = base.join(side, "unit_id", "left" if flags is not None else "full_outer")
    keys = [*codes.values(), *[c for source in direct for c in layout.columns(source)]]
    counted = base.groupBy(*keys).agg(F.count(F.lit(1)).alias(WEIGHT))
    for source in layout.sources:
        if source.name in atoms:
            a = atoms[source.name]
            code = codes[source.name]
            tags = a.tags.select(F.col(a.atom_id).cast("string").alias(code), *layout.project(source))
            counted = lookup_join(counted, tags.filter(F.col(code).isNotNull()), [code], "left")
    return counted.drop(*codes.values())


def _all_pairs(layout: _Layout, combinations: DataFrame, pairs: Sequence[Pair]) -> DataFrame:
    rows = F.array(*[layout.row(i, p) for i, p in enumerate(pairs)])
    counts = (combinations.select(WEIGHT, F.explode(rows).alias("p")).select("p.*", WEIGHT)
              .filter("from_id is not null and to_id is not null")
              .groupBy("pair", "from_id", "from_name", "to_id", "to_name")
              .agg(F.sum(WEIGHT).alias("address_count")))
    labels = F.array(*[F.struct(*[F.lit(v).alias(c) for c, v in p._asdict().items()]) for p in pairs])
    return (with_percent(counts, ["pair", "from_id"])
            .withColumn("_label", F.element_at(labels, F.col("pair") + 1))
            .select("*", *[F.col(f"_label.{c}").alias(c) for c in PAIR_COLUMNS])
            .select(*CROSSWALK_COLUMNS))


def _flagged(residential: Residential, flags: DataFrame | None, unit_id: str) -> DataFrame | None:
    if not residential.by_flag:
        return None
    if flags is None:
        raise ValueError("a residential rule by flag needs the table of classified units")
    return flags.filter("is_residential").select(F.col(unit_id).alias("unit_id"))


def build_all(tables: Mapping[str, DataFrame], registry: Registry, pairs: Sequence[Pair],
              residential: Residential = EVERYONE, flags: DataFrame | None = None,
              units: DataFrame | None = None) -> DataFrame:
    """Crosswalk rows of all pairs; equal to the union of ``build_pair``.

    Unit ids must be unique in each table, as for the tag tables they are.
    ``units`` is a table of all unit ids, worked out from the others if missing.
    """
    layout = _Layout(registry, pairs, residential)
    unit_id = layout.sources[0].unit_id
    listed = _flagged(residential, flags, unit_id)
    if listed is None and units is not None:
        listed = units.select(F.col(unit_id).alias("unit_id"))
    return _all_pairs(layout, _from_unit_tables(layout, tables, listed), pairs)


def build_all_from_atoms(units: DataFrame, unit_id: str, atoms: Mapping[str, AtomTags],
                         tables: Mapping[str, DataFrame], registry: Registry, pairs: Sequence[Pair],
                         residential: Residential = EVERYONE, flags: DataFrame | None = None) -> DataFrame:
    """Like ``build_all``, without first tagging every unit.

    ``atoms`` gives the sources whose tags hang on an atom code of ``units``;
    the other sources come from ``tables``, keyed by unit.
    """
    layout = _Layout(registry, pairs, residential)
    kept = _flagged(residential, flags, unit_id)
    return _all_pairs(layout, _from_atoms(layout, units, unit_id, atoms, tables, kept), pairs)
