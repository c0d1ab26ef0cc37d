"""Helpers shared by the operators: columns, written intermediate tables and partition counts."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from areaweave.sources.steps import shared_folder

#: ASCII white space, as a Java regular expression.
SPACES = r"[ \t\n\x0B\f\r]+"
BLANK = r"[^ \t\n\x0B\f\r]"


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under this package's own names, whatever else the table holds."""
    return df.select(*[df[f"`{source}`"].alias(name) for name, source in columns.items()])


def words_of(text: Column) -> Column:
    """Words between ASCII white space; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def ascii_lower(text: Column) -> Column:
    """Lower case for A to Z alone."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/areaweave-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts lineage, survives lost executors."""
    spark, path = df.sparkSession, new_folder(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._areaweave_path = path
    return out


def drop_stored(df: DataFrame) -> None:
    """Remove the files behind a frame from ``stored`` that nothing reads any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df._areaweave_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def partitions_for(df: DataFrame, column: str, mb: float, least: int = 1) -> int:
    """So many partitions that each has about ``mb`` MB of the text in ``column``, which is measured."""
    size = df.agg(F.sum(F.octet_length(df[f"`{column}`"]))).first()[0] or 0
    return int(max(least, size / (mb * 1e6)))


def wide(spark: SparkSession) -> int:
    """As many partitions as the session shuffles to, one for each core at least."""
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
