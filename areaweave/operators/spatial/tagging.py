"""Tagging atoms and units with the boundaries they lie in."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areaweave.functions import name_before
from areaweave.operators.joins import lookup_join
from areaweave.operators.legacy import legacy_rows
from areaweave.operators.pairs import legacy_counts
from areaweave.operators.spatial.measures import overlap
from areaweave.operators.spatial.predicates import (
    hits, lone_matches, lone_parts, point_in_polygon_join, point_on_surface,
)
from areaweave.sources.steps import step_table


def tag_atoms(atom_points: DataFrame, layers: DataFrame, names: Sequence[str], atom_id: str,
              optional: Sequence[str] = (), tie_break: bool = False) -> DataFrame:
    """Each atom with ``<layer>_id`` and ``<layer>_name`` of every layer.

    All layers go through one spatial join.  An atom outside a layer drops out
    unless the layer is optional; one on a shared edge comes out once per
    boundary, or with the smallest id when ``tie_break`` is set.
    """
    matches = point_in_polygon_join(atom_points, layers, atom_id)
    # An atom's matches are as many as boundaries cover one point.
    found = matches.groupBy(atom_id).agg(*[
        F.array_sort(F.collect_set(F.when(F.col("layer") == name, F.struct("bdy_id", "bdy_name")))).alias(name)
        for name in names])
    for name in names:
        hits = F.slice(F.col(name), 1, 1) if tie_break else F.col(name)
        spread = F.explode_outer(hits) if name in optional else F.explode(hits)
        found = found.withColumn(name, spread)
    return found.select(atom_id, *[c for name in names for c in (
        F.col(f"{name}.bdy_id").alias(f"{name}_id"), F.col(f"{name}.bdy_name").alias(f"{name}_name"))])


def tag_units(units: DataFrame, atoms: DataFrame, layers: DataFrame, names: Sequence[str],
              unit_id: str, unit_atom: str, atom_id: str, atom_points: DataFrame | None = None,
              optional: Sequence[str] = (), tie_break: bool = False,
              unit_atom_length: int | None = None) -> DataFrame:
    """Units with their atom's own columns and its boundaries in every layer.

    Geometry is only worked out per atom; the many units follow in an equi-join
    on the atom code.  ``atom_points`` defaults to a point inside each polygon of
    the layer named ``atom`` in ``layers``.
    """
    if atom_points is None:
        atom_points = point_on_surface(layers.filter(F.col("layer") == "atom")).select(
            F.col("bdy_id").alias(atom_id), "px", "py")
    wanted = layers.filter(F.col("layer").isin(*names))
    tags = atoms.join(tag_atoms(atom_points, wanted, names, atom_id, optional, tie_break), atom_id)
    code = F.col(unit_atom).cast("string")
    if unit_atom_length is not None:
        code = F.substring(code, 1, unit_atom_length)
    tagged = units.select(unit_id, code.alias(atom_id)).filter(F.col(atom_id).isNotNull())
    return lookup_join(tagged, tags, [atom_id])


def zonal_sum(points: DataFrame, layer: DataFrame, values: Sequence[str], point_id: str,
              attributes: DataFrame | None = None) -> DataFrame:
    """Sum of the points' values per boundary; ``attributes`` adds columns by id."""
    types = points.select(*[F.sum(v).alias(v) for v in values]).schema
    # Values are added up by cell and by boundary before anything else is joined.
    found = hits(points.filter(F.col(point_id).isNotNull()), layer, point_id, sums=values)
    keys = ["bdy_id", "bdy_name"]
    found = found.groupBy(*keys).agg(*[F.sum(v).cast(types[v].dataType).alias(v) for v in values])
    if attributes is None:
        return found
    keys += [c for c in attributes.columns if c != "bdy_id"]
    return found.join(attributes, "bdy_id").groupBy(*keys).agg(
        *[F.sum(v).cast(types[v].dataType).alias(v) for v in values])


def two_way_match(layer_a: DataFrame, layer_b: DataFrame, short_b_names: bool = True) -> DataFrame:
    """Pairs of boundaries where a point inside one lies in the other.

    ``match_count`` is 2 when it holds both ways.
    """
    def shown(name: Column) -> Column:
        return name_before(name) if short_b_names else name

    sides = [(lone_parts(layer), layer, step_table(point_on_surface(layer), "inner")) for layer in (layer_a, layer_b)]
    matches = lone_matches(*sides).withColumn("b_name", shown(F.col("b_name")))
    # Pairs with a boundary of several parts, or one that shares its id, may come up more than once and are counted.
    rest = [(layer.join(lone, "bdy_id", "left_anti"), points.join(lone, "bdy_id", "left_anti")) for lone, layer, points in sides]

    def found(points: DataFrame, layer: DataFrame, names: Sequence[str]) -> DataFrame:
        own = points.select(F.struct("bdy_id", "bdy_name").alias("p"), "px", "py")
        return point_in_polygon_join(own, layer, "p").selectExpr(*[f"{c} as {n}" for c, n in zip(
            ("p.bdy_id", "p.bdy_name", "bdy_id", "bdy_name"), names, strict=True)])

    a_names, b_names = ["a_id", "a_name"], ["b_id", "b_name"]
    counted = []
    for (lone, layer, points), other, names, (more, more_points) in (
            (sides[1], sides[0], [*a_names, *b_names], (rest[1][0], rest[0][1])),
            (sides[0], sides[1], [*b_names, *a_names], (rest[0][0], rest[1][1]))):
        if not more.isEmpty():
            counted.append(found(other[2], more, names))
        if not more_points.isEmpty():
            counted.append(found(more_points, layer.join(lone, "bdy_id", "left_semi"), names))
    if counted:
        every = reduce(DataFrame.unionByName, counted).withColumn("b_name", shown(F.col("b_name")))
        matches = matches.unionByName(every.groupBy(*a_names, *b_names).agg(F.count(F.lit(1)).alias("match_count")))
    return matches


def name_mismatches(matches: DataFrame) -> DataFrame:
    return matches.filter(F.col("a_name") != F.col("b_name"))


def one_way_matches(matches: DataFrame) -> DataFrame:
    return matches.filter(F.col("match_count") < 2)


def legacy_pair_spatial(atom_points: DataFrame, units: DataFrame, targets: DataFrame,
                        source_layer: DataFrame, target_layer: DataFrame,
                        source_type: str, target_type: str, atom_id: str = "mb_code",
                        unit_id: str = "unit_id") -> DataFrame:
    """Legacy crosswalk whose source ids come from a spatial join, with the
    overlap of the two shapes beside each pair; no other pairs of shapes are looked at.

    ``units`` has ``unit_id, state`` and the atom code; ``targets`` has
    ``unit_id, target_id, target_name, target_state``.
    """
    tagged = (units.join(point_in_polygon_join(atom_points, source_layer, atom_id), atom_id)
              .select(unit_id, F.col("bdy_id").alias("source_id"),
                      name_before(F.col("bdy_name")).alias("source_name"),
                      F.col("state").alias("source_state")))
    counts = legacy_counts(tagged.join(targets, unit_id))
    rows = legacy_rows(counts, source_type, target_type)
    pairs = rows.select(F.col("source_id").alias("a_id"), F.col("target_id").alias("b_id")).distinct()
    # Over several layers, a pair's shapes are all those of its two ids.
    shared = overlap(source_layer, target_layer, wanted=pairs).groupBy(
        F.col("a_id").alias("source_id"), F.col("b_id").alias("target_id")).agg(
        F.sum("area").alias("overlap_area"), *[
            (F.sum(F.col(c) * F.col("area")) / F.sum("area")).alias(f"overlap_{c[1]}") for c in ("cx", "cy")])
    # Both shapes must exist, even where they do not overlap.
    return (rows.join(source_layer.select(F.col("bdy_id").alias("source_id")), "source_id", "left_semi")
            .join(target_layer.select(F.col("bdy_id").alias("target_id")), "target_id", "left_semi")
            .join(shared, ["source_id", "target_id"], "left")
            .withColumn("overlap_area", F.coalesce("overlap_area", F.lit(0.0))))
