"""Row identity: deduplication, anti-joins and joins to small tables.

Rows of a key are reduced inside each task before the shuffle, so a hot key does not land in one task; joins leave
the choice of a broadcast, by bytes, and the split of skewed partitions to adaptive execution.
No function here starts a job.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Within the silver table of one source, and over all sources: ids of two sources may be equal.
MENTION_KEY = ("post_id", "tool")
SCORED_KEY = ("source", "post_id", "tool")

SALTS = 32


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """One row per key: the first by ``order``, ties broken by the other columns.

    The rank filter becomes a group limit before the shuffle, so each task sends
    at most one row per key, however many copies a key has.
    """
    rest = [F.col(c) for c in df.columns if c not in keys]
    if not order and not rest:
        return df.distinct()
    window = Window.partitionBy(*keys).orderBy(*order, *rest)
    return df.withColumn("_row", F.row_number().over(window)).filter("_row = 1").drop("_row")


def _same(keys: Sequence[str], nulls_equal: bool = True) -> Column:
    """Equal keys; the other side's carry a prefix."""
    theirs = [F.col(f"_their_{k}") for k in keys]
    return reduce(and_, [F.col(k).eqNullSafe(t) if nulls_equal else F.col(k) == t for k, t in zip(keys, theirs)])


def _theirs(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({k: f"_their_{k}" for k in keys})


def not_in(df: DataFrame, existing: DataFrame, keys: Sequence[str], nulls_equal: bool = False) -> DataFrame:
    """Rows of ``df`` whose key is not in ``existing``.

    Only the key columns of ``existing`` are read; they are reduced to distinct
    keys on the way to the shuffle that the join uses as well. Keys that may be NULL need ``nulls_equal``, or rows
    without one are always new; other keys share shuffles with their neighbours only without it.
    """
    return df.join(_theirs(existing.select(*keys).distinct(), keys), _same(keys, nulls_equal), "left_anti")


def among(df: DataFrame, wanted: DataFrame, keys: Sequence[str], nulls_equal: bool = False) -> DataFrame:
    """Rows of ``df`` whose key is in ``wanted``; keys that may be NULL need ``nulls_equal``."""
    return df.join(_theirs(wanted.select(*keys).distinct(), keys), _same(keys, nulls_equal), "left_semi")


def not_in_history(increment: DataFrame, history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Like ``not_in`` for a stored increment that is small next to what it is checked against.

    The history is first cut down to the keys of the increment. The size of a stored increment is known from its files,
    so a short one is broadcast and earlier keys do not travel; a long one meets them in a shuffle. Keys are not NULL.
    """
    return not_in(increment, among(history.select(*keys), increment, keys), keys)


_SIEVE_BITS = 16
"""Bits per key in the table of a sieve."""
_SIEVE_WORDS = 1 << 20
"""At most so many words of 64 bits, 8 MiB. A fuller table lets more through, which costs a shuffle of those rows only."""


def may_be_in(listed: DataFrame, keys: Sequence[str], count: int) -> Column:
    """Whether a row's key may be among the ``count`` keys of the stored frame ``listed``; false is certain.

    The keys set one bit each in a table that is computed once and sent to the tasks like a literal, so no row is shuffled for the test.
    """
    if not count:
        return F.lit(False)
    words = min(_SIEVE_WORDS, 1 << math.ceil(math.log2(max(1, count * _SIEVE_BITS / 64))))

    slot = F.pmod(F.xxhash64(*keys), F.lit(words * 64))
    word, mask = F.shiftright(slot, 6).cast("int"), F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(slot, F.lit(64)).cast("int"))
    bits = listed.select(word.alias("word"), mask.alias("mask")).groupBy("word").agg(F.bit_or("mask").alias("bits"))
    table = listed.sparkSession.range(words).join(bits, F.col("id") == F.col("word"), "left")
    numbered = F.collect_list(F.struct("id", F.coalesce("bits", F.lit(0).cast("bigint")).alias("bits")))
    whole = table.agg(F.transform(F.array_sort(numbered), lambda w: w["bits"])).scalar()
    return F.get(whole, word).bitwiseAND(mask) != 0


def key_counts(df: DataFrame, keys: Sequence[str], existing: DataFrame | None = None, nulls_equal: bool = False) -> DataFrame:
    """The keys of ``df``, their number of rows ``copies``, and ``wanted``: true if ``existing`` does not have the key. Key columns only are read."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    return counts.withColumn("wanted", F.lit(True)) if existing is None else unless_in(counts, existing, keys, nulls_equal)


def unless_in(counts: DataFrame, existing: DataFrame, keys: Sequence[str], nulls_equal: bool = False) -> DataFrame:
    """``keys, copies, wanted``: keys that ``existing`` has are not wanted."""
    theirs = _theirs(existing.select(*keys).distinct(), keys).withColumn("_there", F.lit(True))
    return counts.join(theirs, _same(keys, nulls_equal), "left").select(*keys, "copies", F.col("_there").isNull().alias("wanted"))


def pick(df: DataFrame, seen: DataFrame, keys: Sequence[str], order: Sequence[Column] = (), nulls_equal: bool = False) -> DataFrame:
    """One row per wanted key, the first by ``order`` as in ``keep_first``, without a shuffle of most rows.

    ``seen`` is stored and has every key of ``df`` once, with its number of rows ``copies`` and whether it is ``wanted``. A row that cannot
    be a copy or unwanted is taken where it lies, one that cannot be wanted is left there; only the others, which are few unless keys repeat, are
    compared exactly. Counts ``seen``, so it starts a job. Rows whose key has a NULL are taken with ``nulls_equal`` only.
    """
    wanted = F.col("wanted")
    doubtful = ~wanted | (F.col("copies") > 1)
    asked, doubts = seen.agg(F.count_if(wanted), F.count_if(doubtful)).first()
    in_doubt = may_be_in(seen.filter(doubtful), keys, doubts)
    if not nulls_equal:
        df = df.filter(reduce(and_, [F.col(k).isNotNull() for k in keys]))
    at_once = df.filter(~in_doubt)
    rest = df.filter(in_doubt & may_be_in(seen.filter(wanted), keys, asked))
    return at_once.unionByName(keep_first(among(rest, seen.filter(wanted), keys, nulls_equal), keys, order))


def lookup(df: DataFrame, table: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join a looked-up table; a row without a key meets the entry without one."""
    if how not in ("left", "inner"):
        raise ValueError(f"unsupported join type {how!r}")
    return df.join(_theirs(table, keys), _same(keys), how).drop(*[f"_their_{k}" for k in keys])
