"""Exact histogram of encoded lengths, from which totals, quantiles and truncated totals follow for every context limit.

Every whole text is encoded once and only its length leaves the task; lengths are counted before they are shuffled. Suffix sums run over
distinct lengths, of which there are at most as many as the longest text has tokens: within blocks of lengths first, then over the
few sums of the blocks.

The vocabulary is a file of ranks, given by path, that every executor can open. Defined results: NULL and empty texts have length 0; repeated
rows count as often as they occur; special tokens' strings in a text are ordinary text; no documents give no rows.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mentionkit.llm.common import small_batches, text_of
from mentionkit.sources.shared import store

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how byte-level BPE of this vocabulary cuts a text before merging
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_BLOCK = 1024


@lru_cache(maxsize=2)
def _encoding(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def with_length(docs: DataFrame, name: str = "length", path: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """Add the number of tokens of each text."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("long")
    def lengths(texts: pd.Series) -> pd.Series:
        encode = _encoding(path, pattern).encode_ordinary
        return pd.Series([len(encode(t)) for t in texts], dtype="int64")

    return docs.withColumn(name, lengths(text_of()))


def histogram(docs: DataFrame, path: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """``length, docs`` for every length that occurs."""
    return with_length(docs.select("text"), "length", path, pattern).groupBy("length").agg(F.count(F.lit(1)).alias("docs"))


def with_sums(counts: DataFrame) -> DataFrame:
    """A histogram with what answers every limit.

    ``docs_from``, ``tokens_from``: documents at least that long, and their tokens; ``total_docs``, ``total_tokens``; ``truncated_total``:
    tokens left if every document is cut to ``length``; ``quantile``: share of documents at most that long.
    """
    counts = store(counts.select("length", "docs", (F.col("length") * F.col("docs")).alias("tokens")), "lengths")
    rows = counts.withColumn("_block", F.floor(F.col("length") / _BLOCK))
    blocks = rows.groupBy("_block").agg(F.sum("docs").alias("_d"), F.sum("tokens").alias("_t"))
    after = Window.partitionBy().orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    blocks = blocks.select(
        "_block",
        F.coalesce(F.sum("_d").over(after), F.lit(0)).alias("_d"),
        F.coalesce(F.sum("_t").over(after), F.lit(0)).alias("_t"),
        F.sum("_d").over(whole).alias("total_docs"),
        F.sum("_t").over(whole).alias("total_tokens"),
    )
    within = Window.partitionBy("_block").orderBy(F.desc("length"))
    rows = (
        rows.join(blocks, "_block")
        .withColumn("docs_from", F.sum("docs").over(within) + F.col("_d"))
        .withColumn("tokens_from", F.sum("tokens").over(within) + F.col("_t"))
    )
    below = F.col("total_tokens") - F.col("tokens_from")
    return rows.select(
        "length", "docs", "docs_from", "tokens_from", "total_docs", "total_tokens",
        (below + F.col("length") * F.col("docs_from")).alias("truncated_total"),
        ((F.col("total_docs") - F.col("docs_from") + F.col("docs")) / F.col("total_docs")).alias("quantile"),
    )


def answers(sums: DataFrame, limits: list[int]) -> DataFrame:
    """For the given context limits: documents that fit, tokens left after truncation, tokens lost."""

    def first_above(limit: int):
        """The first length above a limit says it all: what lies below it fits."""
        return F.min_by(F.struct("docs_from", "tokens_from"), F.when(F.col("length") > limit, F.col("length")))

    cases = F.array(*[F.struct(F.lit(int(x)).cast("long").alias("limit"), first_above(x).alias("first")) for x in limits])
    row = sums.agg(F.max("total_docs").alias("n"), F.max("total_tokens").alias("t"), cases.alias("c")).select("n", "t", F.inline("c"))
    over, longer = F.coalesce("first.docs_from", F.lit(0)), F.coalesce("first.tokens_from", F.lit(0))
    kept = F.col("t") - longer + F.col("limit") * over
    return row.select("limit", (F.col("n") - over).alias("docs_that_fit"), kept.alias("truncated_total"), (F.col("t") - kept).alias("tokens_lost"))


def length_report(docs: DataFrame, path: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    return with_sums(histogram(docs, path, pattern))
