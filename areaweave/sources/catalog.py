"""Catalog tables: look up, replace, append, copy to another database."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from areaweave.config import Registry
from areaweave.operators.quality import assert_unique


def find_table(registry: Registry, name: str) -> str | None:
    """Table name of a source, or None if the source is unknown."""
    source = registry.find(name)
    return source.table if source else None


def open_table(spark: SparkSession, registry: Registry, name: str) -> DataFrame:
    """The tag table of a registered source."""
    table = registry[name].table
    if table is None:
        raise ValueError(f"source {name!r} has no table")
    return spark.table(table)


class Layout(NamedTuple):
    """How a table is stored: partition columns, number of buckets, bucket and sort columns."""

    partition_by: tuple[str, ...] = ()
    buckets: int = 0
    bucket_by: tuple[str, ...] = ()
    sort_by: tuple[str, ...] = ()


def layout_of(spark: SparkSession, name: str) -> Layout:
    """A table's layout as the catalog has it."""
    parts = tuple(c.name for c in spark.catalog.listColumns(name) if c.isPartition)
    facts = {r["col_name"]: r["data_type"] for r in spark.sql(f"describe table extended {name}").collect()}

    def columns(fact: str) -> tuple[str, ...]:
        return tuple(c.strip().strip("`") for c in facts.get(fact, "[]").strip("[]").split(",") if c.strip())

    return Layout(parts, int(facts.get("Num Buckets", 0)), columns("Bucket Columns"), columns("Sort Columns"))


def _write(df: DataFrame, name: str, layout: Layout) -> None:
    """Rows are dealt out by bucket or rebalanced by partition first, so that there is not a file for each task
    and bucket or partition, and a partition that is too big for one task is split."""
    if layout.buckets:
        df = df.repartition(layout.buckets, *layout.bucket_by)
    elif layout.partition_by:
        df = df.hint("rebalance", *layout.partition_by)
    writer = df.write.mode("overwrite").format("parquet")
    if layout.partition_by:
        writer = writer.partitionBy(*layout.partition_by)
    if layout.buckets:
        writer = writer.bucketBy(layout.buckets, *layout.bucket_by)
        if layout.sort_by:
            writer = writer.sortBy(*layout.sort_by)
    writer.saveAsTable(name)


def replace_table(df: DataFrame, name: str, partition_by: Sequence[str] = (),
                  bucket: tuple[int, str] | None = None) -> None:
    """Create a table from a query, replacing an older one.

    ``bucket`` is (buckets, column): tag tables bucketed by unit id join each
    other without a shuffle.
    """
    count, columns = (bucket[0], (bucket[1],)) if bucket else (0, ())
    _write(df, name, Layout(tuple(partition_by), count, columns, columns))


def append_table(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> None:
    """Add rows to a table, making it if need be.

    With ``partition_by``, such as the columns of a pair, the partitions that ``df`` has rows in are written whole:
    adding a pair once more replaces it, so a step that is repeated leaves the table as it was.  An older table
    must be partitioned by the same columns.
    """
    spark = df.sparkSession
    if not partition_by:
        df.write.mode("append").format("parquet").saveAsTable(name)
    elif not spark.catalog.tableExists(name):
        _write(df, name, Layout(tuple(partition_by)))
    else:
        stored = spark.table(name)
        layout = layout_of(spark, name)
        if layout.partition_by != tuple(partition_by):
            raise ValueError(f"table {name} is partitioned by {list(layout.partition_by)}, not by {list(partition_by)}")
        mode, before = "spark.sql.sources.partitionOverwriteMode", spark.conf.get("spark.sql.sources.partitionOverwriteMode")
        spark.conf.set(mode, "dynamic")
        try:
            df.select(*stored.columns).hint("rebalance", *partition_by).write.mode("overwrite").insertInto(name)
        finally:
            spark.conf.set(mode, before)


def publish(spark: SparkSession, tables: Mapping[str, Sequence[str]], from_db: str, to_db: str,
            partition_by: Mapping[str, Sequence[str]] | None = None) -> None:
    """Copy tables as they are, rows and layout, to another database and check their keys there.

    ``tables`` maps a table name to its key columns; no keys, no check.  Partitions, buckets and sort columns are
    those that the catalog has, so copies join as the originals do; ``partition_by`` names other partitions.
    """
    spark.sql(f"create database if not exists {to_db}")
    for name, keys in tables.items():
        layout = layout_of(spark, f"{from_db}.{name}")
        if partition_by and name in partition_by:
            layout = layout._replace(partition_by=tuple(partition_by[name]))
        _write(spark.table(f"{from_db}.{name}"), f"{to_db}.{name}", layout)
        if keys:
            assert_unique(spark.table(f"{to_db}.{name}"), keys)
