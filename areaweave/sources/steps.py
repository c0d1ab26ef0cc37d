"""Tables that one step of a job leaves for the next, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder.  On a cluster it must be set; a local session makes a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="areaweave-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def step_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written and read back: a long plan is worked out once, and a lost executor repeats one step's tasks."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/areaweave-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
