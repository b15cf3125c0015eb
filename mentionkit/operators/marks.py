"""High-water marks: how far a source has been read.

Marks are kept per source key (for example per search term). A single mark over
all keys would skip the rows of a key whose last delivery failed.

Rows that a mark does not settle are compared with what has landed, by key. A key filter says beforehand on which days of
ingestion a key may have landed: per day a table of bits, of which each key sets two. A key whose bits are not set on a day has
not landed on it, so only days with both bits are opened, and the comparison there is exact.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mentionkit.operators.keys import lookup, not_in


def high_water_mark(df: DataFrame, time: Column) -> DataFrame:
    """One row with the latest time; NULL for an empty frame."""
    return df.agg(F.max(time).alias("mark"))


def read_mark(df: DataFrame | None, time: Column) -> datetime | None:
    """The mark as a value; None if the table does not exist or is empty."""
    return None if df is None else high_water_mark(df, time).first()["mark"]


def marks_by_key(df: DataFrame, keys: Sequence[str], time: Column) -> DataFrame:
    """Latest time per key; reduced in each task before the shuffle."""
    return df.groupBy(*keys).agg(F.max(time).alias("mark"))


def newer_than(df: DataFrame, time: Column, mark: datetime | None) -> DataFrame:
    """Rows strictly after the mark. A literal mark on a stored column reaches the scan."""
    return df if mark is None else df.filter(time > F.lit(mark))


def newer_than_marks(
    df: DataFrame,
    marks: DataFrame,
    keys: Sequence[str],
    time: Column,
    keep_undated: bool = False,
) -> DataFrame:
    """Rows strictly after the mark of their own key; keys without a mark keep all rows."""
    joined = lookup(df, marks, keys)
    fresh = F.col("mark").isNull() | (time > F.col("mark"))
    if keep_undated:
        fresh = fresh | time.isNull()
    return joined.filter(fresh).drop("mark")


FILTER_WORDS = 1 << 20
"""Words of 64 bits in a day's filter; a day that fills most of them is opened for every key, which costs time only."""
_HASHES = 2


def row_key(keys: Sequence[str], columns: Sequence[str]) -> Column:
    """The hash of what tells a row apart: its keys, or all that a source gives, ``columns``, if it has no first key."""
    content = [c for c in columns if c != "ingested_at"]
    return F.when(F.col(keys[0]).isNotNull(), F.xxhash64(*keys)).otherwise(F.xxhash64(*content))


def _bits(key: Column) -> Column:
    """Where a key's bits lie: structs of number, word and mask."""

    def place(k: int) -> Column:
        h = F.xxhash64(key, F.lit(k))
        mask = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(h, F.lit(64)).cast("int"))
        return F.struct(F.lit(k).alias("k"), F.pmod(F.shiftright(h, 6), F.lit(FILTER_WORDS)).cast("int").alias("word"), mask.alias("bits"))

    return F.array(*[place(k) for k in range(_HASHES)])


def key_filter(df: DataFrame, key: Column) -> DataFrame:
    """``day, word, bits`` of rows with ``ingested_at``; filters of the same day are used together."""
    rows = df.select(F.to_date("ingested_at").alias("day"), F.explode(_bits(key)).alias("b"))
    return rows.groupBy("day", F.col("b.word").alias("word")).agg(F.bit_or("b.bits").alias("bits"))


def days_of_keys(keyed: DataFrame, filters: DataFrame) -> DataFrame:
    """``_key, day``: the days on which a key of ``keyed``, column ``_key``, may have landed. Filters are read, not shuffled, if the keys are few."""
    wanted = keyed.select("_key").distinct().select("_key", F.explode(_bits(F.col("_key"))).alias("b")).select("_key", "b.*")
    met = filters.withColumnRenamed("bits", "_set").join(wanted, "word").filter(F.col("_set").bitwiseAND(F.col("bits")) != 0)
    hits = met.groupBy("_key", "day").agg(F.bit_or(F.call_function("shiftleft", F.lit(1), F.col("k"))).alias("all"))
    return hits.filter(F.col("all") == (1 << _HASHES) - 1).select("_key", "day")


def unsettled(df: DataFrame, marks: DataFrame, mark_keys: Sequence[str], time: Column) -> DataFrame:
    """``df`` with ``_after``: true for rows after the mark of their own key, which cannot have landed; the rest is at the mark, late or undated."""
    marked = lookup(df, marks, mark_keys)
    return marked.withColumn("_after", F.col("mark").isNull() | F.coalesce(time > F.col("mark"), F.lit(False))).drop("mark")


def unlanded(before: DataFrame, landed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that ``landed`` does not hold: compared by ``keys``, and a row without its first key by all columns but those that a run adds."""
    identified = F.col(keys[0]).isNotNull()
    content = [c for c in before.columns if c != "ingested_at"]
    parts = [
        not_yet_landed(before.filter(identified), landed, keys),
        not_yet_landed(before.filter(~identified), landed.filter(~identified), content),
    ]
    return reduce(DataFrame.unionByName, parts)


def not_yet_landed(df: DataFrame, landed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is new, whatever their time: also takes rows that arrive late."""
    return not_in(df, landed, keys, nulls_equal=True)
