"""From raw documents to packed sequences: rules, near-duplicates, benchmark passages, secrets, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows that the stage before has kept; ``run``
writes each stage's rows and reads them again.  All stages but the last return the columns of
``documents``, whatever else the table has; the last returns the pieces of every document with
their sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areaweave.llm import decontamination, packing, quality_rules, secret_scan, simhash
from areaweave.llm.common import stored
from areaweave.llm.queries import table, tokenizer_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Words in a shingle, and the bits in which fingerprints of near-duplicates may differ.
SHINGLE, RADIUS = 4, 4


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that satisfy every rule."""
    return quality_rules.accepted(docs.select(*COLUMNS))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group that fingerprints within the radius connect, one row of it."""
    return simhash.first_of_each(docs.select(*COLUMNS), RADIUS, SHINGLE)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by a passage of the benchmark."""
    return decontamination.clean(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts masked and their lengths counted again."""
    docs = docs.select(*COLUMNS)
    _, forest = secret_scan.scan(docs)
    return secret_scan.redact(docs, forest).withColumn("n_chars", F.length("text").cast("bigint"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 4096 tokens."""
    return packing.pack(docs, tokenizer_path(), capacity=4096, end_id=1)


STAGES = [("quality_rules", quality), ("simhash_dedup", near_duplicates), ("decontamination", benchmark),
          ("secret_scan", secrets), ("packing", packed)]
#: Fingerprints, a fitted forest and tokens are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
