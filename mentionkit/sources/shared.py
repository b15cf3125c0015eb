"""Where intermediate results are kept so that they outlive an executor."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints, or one of our own in local mode."""
    folder = spark.conf.get(_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {_SETTING} to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="mentionkit-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder


def new_folder(spark: SparkSession, purpose: str) -> str:
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def store(df: DataFrame, purpose: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write a frame to the shared folder and read it back: cut lineage, computed once."""
    spark = df.sparkSession
    path = new_folder(spark, purpose)
    df.write.option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
