"""From raw documents to a training mix: quality, near-duplicates, benchmark leaks, secrets, source weights.

Each stage takes (spark, docs, sf_dir) and returns a frame, which is written as Parquet in the shared folder and read again as the next
one's documents. All but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mentionkit.llm import decontamination, mixing, quality, secrets, simhash
from mentionkit.llm.common import read
from mentionkit.sources.shared import store


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the base rules or the trees reject."""
    return quality.kept_documents(docs, read(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of linked fingerprints, the one of least id."""
    return simhash.one_per_group(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold most of a benchmark item."""
    return decontamination.clean_documents(docs, read(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every secret by a mark; the documents stay."""
    return secrets.redacted(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per copy that the mix takes."""
    return mixing.mixed_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark_leaks),
    ("secret scan", secret_scan),
    ("source mix", source_mix),
]

# trees, fingerprints and draws are beyond SQL; tests/llm compares run() with a plain version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{i}")
    return docs
