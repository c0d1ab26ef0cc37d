"""Sources, boundary pairs and residential rules.

A *source* is a table with one row per unit (an address) and a code and name
column for each boundary the unit lies in.  A *pair* names the two boundary
types to weave together.  Both are plain data, so any categorical partition of
units can be registered next to the standard census ones.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Boundary(NamedTuple):
    """SQL expressions giving a boundary's id and name in a source table."""

    id: str
    name: str

    def id_column(self) -> Column:
        return F.expr(self.id).cast("string")

    def name_column(self) -> Column:
        return F.expr(self.name)


class Pair(NamedTuple):
    from_source: str
    from_bdy: str
    to_source: str
    to_bdy: str


PAIR_COLUMNS = list(Pair._fields)
KEY_COLUMNS = ["from_source", "from_bdy", "from_id", "to_source", "to_bdy", "to_id"]
CROSSWALK_COLUMNS = [
    "from_source", "from_bdy", "from_id", "from_name",
    "to_source", "to_bdy", "to_id", "to_name",
    "address_count", "address_percent",
]


@dataclass(frozen=True)
class Source:
    """One unit-tag table: where it is and which boundaries it carries."""

    name: str
    boundaries: Mapping[str, Boundary]
    table: str | None = None
    unit_id: str = "gnaf_pid"
    category: str | None = None

    def boundary(self, bdy: str) -> Boundary:
        try:
            return self.boundaries[bdy.lower()]
        except KeyError:
            raise ValueError(f"boundary {bdy!r} is not in source {self.name!r}") from None


@dataclass(frozen=True)
class Registry:
    """The known sources, by name."""

    sources: Mapping[str, Source]

    @classmethod
    def of(cls, *sources: Source) -> Registry:
        return cls({s.name: s for s in sources})

    def __getitem__(self, name: str) -> Source:
        try:
            return self.sources[name]
        except KeyError:
            raise ValueError(f"unknown source {name!r}") from None

    def find(self, name: str) -> Source | None:
        return self.sources.get(name)


@dataclass(frozen=True)
class Residential:
    """Which units count as residential.

    ``categories`` maps a source to the atom categories that are kept.  A pair
    is filtered by it on each side whose source is listed, and not at all when
    neither is.  ``by_flag`` instead keeps, for every pair, the units whose
    boolean flag is true in a table of classified units.
    """

    categories: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    by_flag: bool = False

    def values(self, source: str) -> tuple[str, ...] | None:
        return self.categories.get(source)


EVERYONE = Residential()

# Meshblock categories whose addresses count as residential.
RESIDENTIAL_CATEGORIES = ("Residential", "Primary Production", "Other")

CENSUS_2016 = "abs 2016"
CENSUS_2021 = "abs 2021"

STANDARD_RESIDENTIAL = Residential({CENSUS_2021: RESIDENTIAL_CATEGORIES})

# Nested census levels, smallest first, and the boundary types
# each source's tag table has code and name columns for.
NESTED_LEVELS = ("sa1", "sa2", "sa3", "sa4", "gcc")
LAYER_BDYS = ("ced", "lga", "poa", "ra", "sed", "ucl")
OPTIONAL_LAYERS = ("sed",)

# Stands for the administrative source of the release in use.
ADMIN = "admin"

# The boundary pairs of the standard build.
STANDARD_PAIRS = (
    Pair(CENSUS_2016, "sa2", CENSUS_2016, "poa"),
    Pair(CENSUS_2016, "sa2", CENSUS_2016, "lga"),
    Pair(CENSUS_2016, "poa", CENSUS_2016, "sa4"),
    Pair(CENSUS_2016, "poa", CENSUS_2016, "sa3"),
    Pair(CENSUS_2016, "poa", CENSUS_2016, "sa2"),
    Pair(CENSUS_2016, "poa", CENSUS_2016, "lga"),
    Pair(CENSUS_2016, "sa3", CENSUS_2016, "lga"),
    Pair(CENSUS_2016, "lga", CENSUS_2016, "sa3"),
    Pair(CENSUS_2016, "lga", CENSUS_2016, "gccsa"),
    Pair(CENSUS_2016, "lga", CENSUS_2016, "ste"),
    Pair(CENSUS_2016, "lga", CENSUS_2016, "ra"),
    Pair(CENSUS_2021, "sa2", CENSUS_2021, "poa"),
    Pair(CENSUS_2021, "sa2", CENSUS_2021, "lga"),
    Pair(CENSUS_2021, "poa", CENSUS_2021, "sa4"),
    Pair(CENSUS_2021, "poa", CENSUS_2021, "sa3"),
    Pair(CENSUS_2021, "poa", CENSUS_2021, "sa2"),
    Pair(CENSUS_2021, "poa", CENSUS_2021, "lga"),
    Pair(CENSUS_2021, "sa3", CENSUS_2021, "lga"),
    Pair(CENSUS_2021, "lga", CENSUS_2021, "sa3"),
    Pair(CENSUS_2021, "lga", CENSUS_2021, "gccsa"),
    Pair(CENSUS_2021, "lga", CENSUS_2021, "state"),
    Pair(CENSUS_2021, "lga", CENSUS_2021, "ra"),
    Pair(CENSUS_2016, "sa2", ADMIN, "postcode"),
    Pair(CENSUS_2021, "sa2", ADMIN, "postcode"),
    Pair(ADMIN, "locality", CENSUS_2016, "sa2"),
    Pair(ADMIN, "locality", CENSUS_2016, "sa3"),
    Pair(ADMIN, "locality", CENSUS_2016, "lga"),
    Pair(ADMIN, "postcode", CENSUS_2016, "sa3"),
    Pair(ADMIN, "postcode", CENSUS_2016, "lga"),
    Pair(ADMIN, "lga", CENSUS_2016, "lga"),
    Pair(ADMIN, "lga", CENSUS_2016, "gccsa"),
    Pair(ADMIN, "locality", CENSUS_2021, "sa2"),
    Pair(ADMIN, "locality", CENSUS_2021, "sa3"),
    Pair(ADMIN, "locality", CENSUS_2021, "lga"),
    Pair(ADMIN, "postcode", CENSUS_2021, "sa3"),
    Pair(ADMIN, "postcode", CENSUS_2021, "lga"),
    Pair(ADMIN, "lga", CENSUS_2021, "lga"),
    Pair(ADMIN, "lga", CENSUS_2021, "gccsa"),
    Pair(ADMIN, "locality", ADMIN, "lga"),
    Pair(ADMIN, "postcode", ADMIN, "lga"),
    Pair(CENSUS_2016, "sa1", CENSUS_2021, "sa1"),
    Pair(CENSUS_2016, "sa2", CENSUS_2021, "sa2"),
    Pair(CENSUS_2016, "sa3", CENSUS_2021, "sa3"),
    Pair(CENSUS_2016, "sa4", CENSUS_2021, "sa4"),
    Pair(CENSUS_2016, "gcc", CENSUS_2021, "gccsa"),
)


def admin_source_name(release: str) -> str:
    return f"geoscape {release}"


def standard_pairs(release: str) -> list[Pair]:
    """The 45 pairs of the standard build for an administrative release."""
    admin = admin_source_name(release)
    return [Pair(*(admin if value == ADMIN else value for value in pair)) for pair in STANDARD_PAIRS]


def level_pairs(levels: Iterable[str]) -> list[tuple[str, str]]:
    """Every (smaller, larger) pair of an ordered list of nested levels."""
    ordered = list(levels)
    return [(a, b) for i, a in enumerate(ordered) for b in ordered[i + 1:]]


def census_levels(source: str) -> tuple[str, ...]:
    """Nested levels as the given census labels them: 2021 says ``gccsa``."""
    if source == CENSUS_2021:
        return tuple("gccsa" if level == "gcc" else level for level in NESTED_LEVELS)
    return NESTED_LEVELS


def census_2016_source(table: str | None = None) -> Source:
    bdys = {b: Boundary(f"{b}_code16", f"{b}_name16")
            for b in (*NESTED_LEVELS, *LAYER_BDYS, "ste")}
    bdys["gccsa"] = bdys["gcc"]
    bdys["mb"] = Boundary("mb_code16", "mb_cat16")
    return Source(CENSUS_2016, bdys, table, category="mb_cat16")


def census_2021_source(table: str | None = None) -> Source:
    bdys = {b: Boundary(f"{b}_code_2021", f"{b}_name_2021")
            for b in ("sa2", "sa3", "sa4", "gccsa", *LAYER_BDYS, "state")}
    bdys["sa1"] = Boundary("sa1_code_2021", "sa1_code_2021")
    bdys["mb"] = Boundary("mb_code_2021", "mb_category_2021")
    return Source(CENSUS_2021, bdys, table, category="mb_category_2021")


def admin_source(release: str, table: str | None = None) -> Source:
    return Source(
        admin_source_name(release),
        {
            "postcode": Boundary("postcode", "concat_ws('', postcode, ' ', state)"),
            "locality": Boundary("locality_pid", "locality_name"),
            "lga": Boundary("lga_pid", "lga_name"),
        },
        table,
    )


@dataclass(frozen=True)
class Namespaces:
    """Database names the standard build reads from and writes to."""

    release: str
    units: str | None = None
    admin: str | None = None
    census_2016: str = "census_2016_bdys"
    census_2021: str = "census_2021_bdys_gda94"
    indicators: str = "census_2016_data"
    buildings: str = "geoscape_202203"

    def units_db(self) -> str:
        return self.units or f"gnaf_{self.release}"

    def admin_db(self) -> str:
        return self.admin or f"admin_bdys_{self.release}"


def standard_registry(ns: Namespaces) -> Registry:
    """The three standard sources, in the databases of one release."""
    # Names of the unit-tag tables.
    db = ns.units_db()
    return Registry.of(
        census_2016_source(f"{db}.address_principal_census_2016_boundaries"),
        census_2021_source(f"{db}.address_principal_census_2021_boundaries"),
        admin_source(ns.release, f"{db}.address_principal_admin_boundaries"),
    )


class ResidentialSource(NamedTuple):
    """Where the standard build learns which units are residential: the rule and the table behind it."""

    rule: Residential
    table: str


# Names of the residential sources and of the table of classified units.
BUILDINGS = "geoscape"
CLASSIFIED_TABLE = "address_principals_buildings"
DEFAULT_RESIDENTIAL_SOURCE = CENSUS_2021


def residential_sources(ns: Namespaces) -> dict[str, ResidentialSource]:
    """The three residential sources of a release by name.

    Both census sources keep units by the meshblock categories of 2021; only the buildings bring flags of their own.
    """
    registry = standard_registry(ns)
    return {
        CENSUS_2021: ResidentialSource(STANDARD_RESIDENTIAL, registry[CENSUS_2021].table),
        CENSUS_2016: ResidentialSource(STANDARD_RESIDENTIAL, registry[CENSUS_2016].table),
        BUILDINGS: ResidentialSource(Residential(by_flag=True), f"{ns.buildings}.{CLASSIFIED_TABLE}"),
    }


def residential_source(ns: Namespaces, name: str) -> ResidentialSource:
    try:
        return residential_sources(ns)[name]
    except KeyError:
        raise ValueError(f"unknown residential source {name!r}") from None
