"""Logical tables of the engine, mapped onto the star-schema test tables.

Orders are the units, customers the atoms; nations, regions, segments,
suppliers and parts play the boundaries.
"""

from __future__ import annotations

import struct
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from areaweave import Boundary, Pair, Registry, Residential, Source, edges_from_rings, edges_from_wkb, ring

MONEY = "decimal(18,2)"

REGISTRY = Registry.of(
    Source("cust", {
        "nation": Boundary("nation_id", "nation_name"),
        "region": Boundary("region_id", "region_name"),
        # NULL ids, and ids that go by a different name in each region.
        "segment": Boundary("nullif(segment, 'BUILDING')", "concat_ws('', segment, ' ', region_name)"),
    }, unit_id="unit_id"),
    Source("supp", {
        "nation": Boundary("nation_id", "nation_name"),
        "region": Boundary("region_id", "region_name"),
    }, unit_id="unit_id", category="category"),
    Source("part", {
        "part": Boundary("part_id", "part_name"),
        "brand": Boundary("brand_id", "brand_id"),
        "type": Boundary("type_id", "type_id"),
    }, unit_id="unit_id"),
)
RESIDENTIAL = Residential({"supp": ("1-URGENT", "2-HIGH", "3-MEDIUM")})
PAIRS = [
    Pair("cust", "nation", "cust", "segment"),
    Pair("cust", "segment", "cust", "nation"),
    Pair("cust", "nation", "supp", "nation"),
    Pair("supp", "nation", "cust", "segment"),
    Pair("supp", "region", "supp", "nation"),
    Pair("cust", "region", "part", "part"),
    Pair("part", "brand", "cust", "nation"),
    Pair("part", "type", "supp", "region"),
]


@lru_cache(maxsize=None)
def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A test table; its footer is read once per session."""
    return spark.read.parquet(f"{sf}/{name}.parquet")


def places(spark: SparkSession, sf: str) -> DataFrame:
    """Nations with their region."""
    nation, region = read(spark, sf, "nation"), read(spark, sf, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", F.col("n_nationkey").cast("string").alias("nation_id"), F.col("n_name").alias("nation_name"),
        F.col("r_regionkey").cast("string").alias("region_id"), F.col("r_name").alias("region_name"))


def cust_units(spark: SparkSession, sf: str) -> DataFrame:
    orders, customer = read(spark, sf, "orders"), read(spark, sf, "customer")
    return (orders.join(customer, orders.o_custkey == customer.c_custkey)
            .join(places(spark, sf), F.col("c_nationkey") == F.col("n_nationkey"))
            .select(F.col("o_orderkey").alias("unit_id"), "nation_id", "nation_name", "region_id", "region_name",
                    F.col("c_mktsegment").alias("segment"), F.col("c_custkey").alias("atom_id"),
                    F.col("o_orderpriority").alias("category"), F.col("o_orderstatus").alias("status"),
                    F.col("o_totalprice").cast(MONEY).alias("price")))


def _first_line(spark: SparkSession, sf: str, column: str) -> DataFrame:
    return (read(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("unit_id"))
            .agg(F.min(column).alias(column)))


def supp_units(spark: SparkSession, sf: str) -> DataFrame:
    supplier, orders = read(spark, sf, "supplier"), read(spark, sf, "orders")
    return (_first_line(spark, sf, "l_suppkey")
            .join(orders.select(F.col("o_orderkey").alias("unit_id"), F.col("o_orderpriority").alias("category")),
                  "unit_id")
            .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
            .join(places(spark, sf), F.col("s_nationkey") == F.col("n_nationkey"))
            .select("unit_id", "nation_id", "nation_name", "region_id", "region_name", "category"))


def part_units(spark: SparkSession, sf: str) -> DataFrame:
    part = read(spark, sf, "part")
    return (_first_line(spark, sf, "l_partkey").join(part, F.col("l_partkey") == F.col("p_partkey"))
            .select("unit_id", F.col("p_partkey").cast("string").alias("part_id"), F.col("p_name").alias("part_name"),
                    F.col("p_brand").alias("brand_id"), F.col("p_type").alias("type_id")))


def tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {"cust": cust_units(spark, sf), "supp": supp_units(spark, sf), "part": part_units(spark, sf)}


def indicators(spark: SparkSession, sf: str) -> DataFrame:
    """Order value by nation, region and segment."""
    units = cust_units(spark, sf)
    ids = F.array(*[F.struct(F.lit(b).alias("bdy"), REGISTRY["cust"].boundary(b).id_column().alias("region_id"))
                    for b in ("nation", "region", "segment")])
    return (units.select("price", F.explode(ids).alias("i")).select("i.*", "price").filter("region_id is not null")
            .groupBy("bdy", "region_id").agg(F.sum("price").cast("double").alias("value")))


def atom_points(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as points on a 100 by 100 plane, a tenth apart."""
    key = F.col("c_custkey")
    return read(spark, sf, "customer").select(
        key.alias("atom_id"), (key * 37 % 1000 / 10.0).alias("px"), (key * 91 % 1000 / 10.0).alias("py"),
        F.col("c_acctbal").cast(MONEY).alias("balance"))


def box(x: Column, y: Column, side: float, **kwargs) -> Column:
    return ring([(x, y), (x + side, y), (x + side, y + side), (x, y + side)], **kwargs)


def ell(x: Column, y: Column, side: float) -> Column:
    """A square without its top right quadrant."""
    half = side / 2
    return ring([(x, y), (x + side, y), (x + side, y + half), (x + half, y + half), (x + half, y + side), (x, y + side)])


def nation_squares(spark: SparkSession, sf: str, layer: str = "square") -> DataFrame:
    x, y = F.col("n_nationkey") % 5 * 20, F.floor(F.col("n_nationkey") / 5) * 20
    return edges_from_rings(read(spark, sf, "nation"), layer, F.col("n_nationkey"),
                            F.concat("n_name", F.lit(" (C)")), F.array(box(x, y, 20)))


def nation_ells(spark: SparkSession, sf: str, layer: str = "ell") -> DataFrame:
    x, y = F.col("n_nationkey") % 5 * 20, F.floor(F.col("n_nationkey") / 5) * 20
    return edges_from_rings(read(spark, sf, "nation"), layer, F.col("n_nationkey"), F.col("n_name"),
                            F.array(ell(x, y, 20)))


def nation_frames(spark: SparkSession, sf: str, layer: str = "frame") -> DataFrame:
    """Squares shifted by 7 with a hole of side 6 in the middle."""
    x, y = F.col("n_nationkey") % 5 * 20 + 7, F.floor(F.col("n_nationkey") / 5) * 20 + 7
    return edges_from_rings(read(spark, sf, "nation"), layer, F.col("n_nationkey"), F.col("n_name"),
                            F.array(box(x, y, 20), box(x + 7, y + 7, 6, ring_id=1, is_hole=True)))


def region_blocks(spark: SparkSession, sf: str, layer: str = "block") -> DataFrame:
    """Regions as multipart shapes: the squares of their nations."""
    x, y = F.col("n_nationkey") % 5 * 20, F.floor(F.col("n_nationkey") / 5) * 20
    return edges_from_rings(read(spark, sf, "nation").join(
        read(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")), layer,
        F.col("r_regionkey"), F.col("r_name"), F.array(box(x, y, 20, part_id=F.col("n_nationkey"))))


def _supplier_corner() -> tuple[Column, Column]:
    return F.col("s_suppkey") * 13 % 90, F.col("s_suppkey") * 29 % 90


def supplier_ells(spark: SparkSession, sf: str, layer: str = "depot") -> DataFrame:
    x, y = _supplier_corner()
    return edges_from_rings(read(spark, sf, "supplier"), layer, F.col("s_suppkey"), F.col("s_name"),
                            F.array(ell(x, y, 10)))


def supplier_frames(spark: SparkSession, sf: str, layer: str = "yard") -> DataFrame:
    """Squares with a hole; the name column holds the nation."""
    x, y = _supplier_corner()
    return edges_from_rings(read(spark, sf, "supplier"), layer, F.col("s_suppkey"), F.col("s_nationkey"),
                            F.array(box(x, y, 10), box(x + 3, y + 3, 5, ring_id=1, is_hole=True)))


def supplier_squares(spark: SparkSession, sf: str, odd_as_ells: bool = False) -> DataFrame:
    x, y = _supplier_corner()
    whole = F.array(box(x, y, 10))
    rings = F.when(F.col("s_suppkey") % 2 == 1, F.array(ell(x, y, 10))).otherwise(whole) if odd_as_ells else whole
    return edges_from_rings(read(spark, sf, "supplier"), "store", F.col("s_suppkey"), F.col("s_name"), rings)


def supplier_vertices(spark: SparkSession, sf: str) -> DataFrame:
    """Supplier squares as numbered corners, running clockwise."""
    x, y = _supplier_corner()
    turn = F.array(*[F.struct((x + dx).cast("double").alias("x"), (y + dy).cast("double").alias("y"))
                     for dx, dy in ((0, 0), (0, 10), (10, 10), (10, 0), (0, 0))])
    return (read(spark, sf, "supplier").select(
        F.lit("store").alias("layer"), F.col("s_suppkey").cast("string").alias("bdy_id"), F.col("s_name").alias("bdy_name"),
        F.lit(0).alias("part_id"), F.lit(0).alias("ring_id"), F.lit(False).alias("is_hole"),
        F.posexplode(turn).alias("seq", "corner")).select("*", "corner.x", "corner.y").drop("corner"))


def atom_squares(spark: SparkSession, sf: str) -> DataFrame:
    """The unit square around each customer's point."""
    points = atom_points(spark, sf)
    return edges_from_rings(points, "atom", F.col("atom_id"),
                            F.concat(F.lit("Atom "), F.col("atom_id").cast("string"), F.lit(" (A)")),
                            F.array(box(F.floor("px"), F.floor("py"), 1)))


def slanted(edges: DataFrame) -> DataFrame:
    """The plane sheared both ways: no edge stays level or upright, areas stay, corners stay whole numbers."""
    return edges.selectExpr("*", *[f"x{n} + 2 * y{n} as u{n}" for n in (1, 2)], *[f"x{n} + 3 * y{n} as v{n}" for n in (1, 2)]
                            ).drop("x1", "y1", "x2", "y2").withColumnsRenamed({"u1": "x1", "v1": "y1", "u2": "x2", "v2": "y2"})


def slanted_points(spark: SparkSession, sf: str) -> DataFrame:
    """Customers' points on the sheared plane, ten times as large, where all are whole numbers."""
    key = F.col("c_custkey")
    return read(spark, sf, "customer").select(key.alias("atom_id"), (key * 37 % 1000).alias("x"), (key * 91 % 1000).alias("y")
                                              ).selectExpr("atom_id", "double(x + 2 * y) as px", "double(x + 3 * y) as py")


def enlarged(edges: DataFrame, times: int) -> DataFrame:
    return edges.withColumns({c: F.col(c) * times for c in ("x1", "y1", "x2", "y2")})


def supplier_triangles(spark: SparkSession, sf: str, second: bool = False) -> DataFrame:
    """Triangles, and with ``second`` others that touch the middle of their slanted sides with a corner.

    The second ones of odd suppliers reach inside.
    """
    x, y = _supplier_corner()
    if second:
        by = F.col("s_suppkey") % 2
        corners = [(x + 4 - by, y + 2 - by), (x + 9 - by, y + 3 - by), (x + 6 - by, y + 7 - by)]
    else:
        corners = [(x, y), (x + 8, y), (x, y + 4)]
    return edges_from_rings(read(spark, sf, "supplier"), "second" if second else "first", F.col("s_suppkey"), F.col("s_name"),
                            F.array(ring(corners)))


def supplier_islets(spark: SparkSession, sf: str) -> DataFrame:
    """Supplier squares; odd ones have an islet of side 1e-4."""
    x, y = _supplier_corner()
    islet = box(x + 20, y + 20, 1e-4, part_id=F.lit(1))
    rings = F.when(F.col("s_suppkey") % 2 == 1, F.array(box(x, y, 10), islet)).otherwise(F.array(box(x, y, 10)))
    return edges_from_rings(read(spark, sf, "supplier"), "store", F.col("s_suppkey"), F.col("s_name"), rings)


@F.pandas_udf(BinaryType())
def _square_wkb(x: pd.Series, y: pd.Series, side: pd.Series) -> pd.Series:
    return pd.Series([struct.pack("<BIII10d", 1, 3, 1, 5, u, v, u + s, v, u + s, v + s, u, v + s, u, v)
                      for u, v, s in zip(x, y, side, strict=True)])


def nation_stores(spark: SparkSession, sf: str) -> DataFrame:
    """Nations as the squares of their suppliers, one row of well-known binary each; squares of a nation overlap."""
    x, y = _supplier_corner()
    rows = read(spark, sf, "supplier").select("s_suppkey", "s_nationkey", _square_wkb(
        x.cast("double"), y.cast("double"), F.lit(10.0)).alias("geom"))
    return edges_from_wkb(rows, "stores", F.col("s_nationkey"), F.lit("stores"), F.col("geom"), feature=F.col("s_suppkey"))


def zones(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as buildings with a planning zone by type."""
    kind = F.col("p_type")
    zone = (F.when(kind == "ECONOMY", "Low Density Residential").when(kind == "STANDARD", None)
            .when(kind == "PROMO", "Mixed Use").when(kind == "LARGE", "Rural").otherwise("Industrial"))
    return read(spark, sf, "part").select(F.col("p_partkey").alias("building_pid"), zone.alias("planning_zone"))


def building_address(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "lineitem").select(F.col("l_orderkey").alias("address_detail_pid"),
                                              F.col("l_partkey").alias("building_pid"), "l_returnflag")


def addresses(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as addresses; priorities as atoms of both censuses."""
    return read(spark, sf, "orders").select(
        F.col("o_orderkey").alias("gnaf_pid"), F.col("o_orderstatus").alias("state"),
        F.col("o_orderpriority").alias("mb_2016_code"), F.col("o_orderpriority").alias("mb_2021_code"))


def atom_categories(spark: SparkSession, sf: str) -> DataFrame:
    """Category per priority: residential, commercial or not known."""
    code = F.col("o_orderpriority")
    category = F.when(code == "1-URGENT", "Residential").when(code == "5-LOW", None).otherwise("Commercial")
    return read(spark, sf, "orders").select(code.alias("mb_code"), category.alias("mb_category")).distinct()
