"""Weave boundary sets together: weighted crosswalks on Spark DataFrames."""

from areaweave.config import (
    EVERYONE, STANDARD_RESIDENTIAL, Boundary, Namespaces, Pair, Registry, Residential, Source,
    admin_source, census_2016_source, census_2021_source, standard_pairs, standard_registry,
)
from areaweave.operators.apply import apportion, lookup, rate, rollup_indicator, slice_pair
from areaweave.operators.legacy import Override, apply_overrides, legacy_pair, legacy_units
from areaweave.operators.nested import nested_pairs
from areaweave.operators.pairs import build_pair, build_pair_for, same_table_pair
from areaweave.operators.profile import project_population, unit_profile
from areaweave.operators.quality import (
    assert_unique, dropped_units, duplicate_keys, null_violations, percent_totals, row_parity,
)
from areaweave.operators.residential import (
    building_zones, category_disagreement, reconcile, residential_flag, residential_units,
)
from areaweave.operators.score import (
    compare_official, error_rate, score, score_with_error, weighted_percent_by_id,
)
from areaweave.operators.spatial.layers import (
    collect_parts, edges_from_rings, edges_from_vertices, edges_from_wkb, orient, ring,
)
from areaweave.operators.spatial.measures import (
    albers, area_by_key, atoms_touching, centroids, geometry_diff, overlap, overlap_report,
    percent_overlap, polygons_meet, project_albers, unmatched,
)
from areaweave.operators.spatial.predicates import point_in_polygon_join, point_on_surface
from areaweave.operators.spatial.tagging import (
    legacy_pair_spatial, name_mismatches, one_way_matches, tag_atoms, tag_units, two_way_match, zonal_sum,
)
from areaweave.plans.crosswalk import AtomTags, build_all, build_all_from_atoms
from areaweave.plans.standard import run_standard

__all__ = [name for name in dir() if not name.startswith("_")]
