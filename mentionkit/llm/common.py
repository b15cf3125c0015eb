"""What the operators of this subpackage share: table reads, word rules, Arrow batch bounds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
"""A word: what stands between ASCII white space. ``bytes.split()`` follows the same rule."""

BATCH_ROWS = 1000
BATCH_BYTES = 16 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound what a Python worker holds at once, whatever the length of the texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def text_of(name: str = "text") -> Column:
    """The text column with NULL read as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))
