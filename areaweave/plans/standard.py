"""The standard build: tag, weave, score, store, export, publish."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areaweave.config import (
    CENSUS_2016, CENSUS_2021, CROSSWALK_COLUMNS, DEFAULT_RESIDENTIAL_SOURCE, KEY_COLUMNS, LAYER_BDYS, NESTED_LEVELS,
    OPTIONAL_LAYERS, PAIR_COLUMNS, Boundary, Namespaces, Residential, admin_source_name, census_levels,
    residential_source, standard_pairs, standard_registry,
)
from areaweave.operators.nested import nested_pairs
from areaweave.operators.quality import assert_unique
from areaweave.operators.residential import building_zones, residential_units
from areaweave.operators.score import score_with_error
from areaweave.operators.spatial.layers import edges_from_wkb
from areaweave.operators.spatial.predicates import point_on_surface
from areaweave.operators.spatial.tagging import tag_atoms
from areaweave.plans.crosswalk import AtomTags, build_all_from_atoms
from areaweave.sources import export_csv, open_table, publish, replace_table

# Column names in the raw meshblock tables where they differ from
# the tag tables, table name patterns, and the default output names.
RAW_2016_COLUMNS = {"sa1_code16": "sa1_main16", "sa1_name16": "sa1_7dig16", "sa2_code16": "sa2_main16"}
RAW_2016_PATTERN, RAW_2021_PATTERN = "{}_2016_aust", "{}_2021_aust_gda94"
TAGS_2016, TAGS_2021 = "address_principal_census_2016_boundaries", "address_principal_census_2021_boundaries"
OUTPUT_TABLE, SCORE_TABLE = "boundary_concordance", "boundary_concordance_score"
CODE_16, NAME_16, CODE_21, NAME_21 = "{}_code16", "{}_name16", "{}_code_2021", "{}_name_2021"

# Geometry is kept at atom level; units per atom come by code alone.
ATOM_ID = {CENSUS_2016: "mb_code16", CENSUS_2021: "mb_code_2021"}
UNIT_ATOM = {CENSUS_2016: "mb_2016_code", CENSUS_2021: "mb_2021_code"}


def census_tables(spark: SparkSession, ns: Namespaces, census: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Meshblocks with the tag tables' column names, and the six other layers."""
    old = census == CENSUS_2016
    db, pattern = (ns.census_2016, RAW_2016_PATTERN) if old else (ns.census_2021, RAW_2021_PATTERN)
    atoms = spark.table(f"{db}.{pattern.format('mb')}")
    if old:
        atoms = atoms.withColumnsRenamed({raw: tag for tag, raw in RAW_2016_COLUMNS.items()})
    return atoms, {b: spark.table(f"{db}.{pattern.format(b)}") for b in LAYER_BDYS}


def census_edges(atoms: DataFrame, layers: Mapping[str, DataFrame], census: str) -> DataFrame:
    """Edge table of the meshblocks, as layer ``atom``, and the six other layers."""
    code, name = (CODE_16, NAME_16) if census == CENSUS_2016 else (CODE_21, NAME_21)
    shapes = {"atom": (atoms, ATOM_ID[census], ATOM_ID[census])} | {
        b: (layer, code.format(b), name.format(b)) for b, layer in layers.items()}
    return reduce(DataFrame.unionByName, [
        edges_from_wkb(df, b, F.col(i), F.col(n), F.col("geom")) for b, (df, i, n) in shapes.items()])


def census_atom_tags(atoms: DataFrame, edges: DataFrame, census: str, tie_break: bool = False) -> DataFrame:
    """Each meshblock with its own columns and the codes and names of six layers."""
    code, name = (CODE_16, NAME_16) if census == CENSUS_2016 else (CODE_21, NAME_21)
    atom_id = ATOM_ID[census]
    points = point_on_surface(edges.filter(F.col("layer") == "atom"))
    tags = tag_atoms(points.select(F.col("bdy_id").alias(atom_id), "px", "py"), edges.filter(F.col("layer") != "atom"),
                     LAYER_BDYS, atom_id, optional=OPTIONAL_LAYERS, tie_break=tie_break)
    renames = {f"{b}_id": code.format(b) for b in LAYER_BDYS} | {f"{b}_name": name.format(b) for b in LAYER_BDYS}
    return atoms.drop("geom").join(tags.withColumnsRenamed(renames), atom_id)


def census_indicators(spark: SparkSession, ns: Namespaces, bdys: Sequence[str], value: str = "g3") -> DataFrame:
    """Published populations of several boundary types as one long table."""
    return reduce(DataFrame.unionByName, [
        spark.table(f"{ns.indicators}.{b}_g01").select(
            F.lit(b).alias("bdy"), F.col("region_id").cast("string").alias("region_id"),
            F.col(value).cast("double").alias("value"))
        for b in bdys])


def standard_nested(atoms: DataFrame, units: DataFrame, census: str,
                    columns: Mapping[str, Boundary]) -> DataFrame:
    return nested_pairs(atoms, units, census, ATOM_ID[census], UNIT_ATOM[census], census_levels(census), columns)


def store_residential_units(spark: SparkSession, ns: Namespaces, name: str, keep: Sequence[str] = ("reliability", "state"),
                            buckets: int | None = None) -> DataFrame:
    """Classify all units by their buildings' zones and their meshblocks, store them as table ``name`` and check its key."""
    admin = ns.admin_db()
    old, new = spark.table(f"{admin}.abs_2016_mb"), spark.table(f"{admin}.abs_2021_mb")
    zones = building_zones(spark.table(f"{ns.buildings}.building_address"), spark.table(f"{ns.buildings}.buildings"))
    units = spark.table(f"{ns.units_db()}.address_principals")
    classified = residential_units(
        units, old.select(F.col("mb_16code").alias("mb_code"), "mb_category"),
        new.select(F.col("mb21_code").alias("mb_code"), F.col("mb_cat").alias("mb_category")), zones,
        keep=tuple(c for c in keep if c in units.columns))
    replace_table(classified, name, bucket=(buckets or buckets_for(units), "gnaf_pid"))
    return assert_unique(spark.table(name), ["gnaf_pid"])


# Units in one bucket of a tag table: some 100 MB of them, compressed.
UNITS_PER_BUCKET = 2_000_000


def buckets_for(units: DataFrame) -> int:
    """A power of two, so that tables of different releases still join bucket by bucket."""
    return 1 << max(2, (units.count() // UNITS_PER_BUCKET).bit_length())


def run_standard(spark: SparkSession, ns: Namespaces, residential: Residential | str = DEFAULT_RESIDENTIAL_SOURCE,
                 flags: DataFrame | None = None, export_path: str | None = None,
                 publish_to: str | None = None, buckets: int | None = None, tie_break: bool = False) -> None:
    """Build every standard table of a release.

    ``residential`` names a residential source, or is a rule, with the table of classified units in ``flags`` if
    it goes by flag.  The buildings' table is read if it is stored and else made first.  ``buckets`` of the unit
    tables are worked out from the number of units where they are not given.

    A meshblock whose point lies on the edge of two areas would give its units
    two rows, which stops the build; ``tie_break`` takes the smaller id instead.

    Steps hand over through stored tables, so a lost executor repeats one step's
    tasks, not the whole lineage.
    """
    db, registry, pairs = ns.units_db(), standard_registry(ns), standard_pairs(ns.release)
    units = spark.table(f"{db}.address_principals")
    buckets = buckets or buckets_for(units)
    if isinstance(residential, str):
        residential, table = residential_source(ns, residential)
        if residential.by_flag and flags is None:
            flags = (spark.table(table) if spark.catalog.tableExists(table)
                     else store_residential_units(spark, ns, table, buckets=buckets))
            assert_unique(flags, ["gnaf_pid"])
    tags, nested = {}, []
    for census, unit_table in ((CENSUS_2016, TAGS_2016), (CENSUS_2021, TAGS_2021)):
        atoms, layers = census_tables(spark, ns, census)
        atom_table, edge_table = f"{db}.{unit_table}_by_meshblock", f"{db}.{unit_table}_edges"
        replace_table(census_edges(atoms, layers, census), edge_table, ["layer"])
        replace_table(census_atom_tags(atoms, spark.table(edge_table), census, tie_break), atom_table)
        tags[census] = AtomTags(spark.table(atom_table), ATOM_ID[census], UNIT_ATOM[census])
        code = F.col(UNIT_ATOM[census]).cast("string").alias(ATOM_ID[census])
        replace_table(units.select("gid", "gnaf_pid", code).join(tags[census].tags, ATOM_ID[census]),
                      f"{db}.{unit_table}", bucket=(buckets, "gnaf_pid"))
        assert_unique(spark.table(f"{db}.{unit_table}"), ["gnaf_pid"])
        nested.append(standard_nested(atoms, units, census, registry[census].boundaries))

    admin = admin_source_name(ns.release)
    woven = build_all_from_atoms(units, "gnaf_pid", tags, {admin: open_table(spark, registry, admin)},
                                 registry, pairs, residential, flags)
    whole = reduce(DataFrame.unionByName, nested, woven)
    replace_table(whole, f"{db}.{OUTPUT_TABLE}", PAIR_COLUMNS)
    crosswalk = assert_unique(spark.table(f"{db}.{OUTPUT_TABLE}").select(*CROSSWALK_COLUMNS), KEY_COLUMNS)

    inside = [p for p in pairs if p.from_source == p.to_source == CENSUS_2016
              and not (p.from_bdy in NESTED_LEVELS and p.to_bdy in NESTED_LEVELS)]
    bdys = sorted({b for p in inside for b in (p.from_bdy, p.to_bdy)})
    replace_table(score_with_error(crosswalk, census_indicators(spark, ns, bdys)), f"{db}.{SCORE_TABLE}")
    scores = assert_unique(spark.table(f"{db}.{SCORE_TABLE}"), PAIR_COLUMNS)

    if export_path:
        export_csv(crosswalk, f"{export_path}/{OUTPUT_TABLE}", compress=True)
        export_csv(scores, f"{export_path}/{SCORE_TABLE}")
    if publish_to:
        publish(spark, {TAGS_2016: [], TAGS_2021: [], SCORE_TABLE: [], OUTPUT_TABLE: KEY_COLUMNS},
                db, publish_to)
