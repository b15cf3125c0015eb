"""Mentions against an alias table too large to be written into an expression.

Substring containment has no join key of its own. It gets one: an alias can only
occur in a text that holds the alias's first few characters, so texts and aliases
meet on that anchor and the pairs that meet are checked for containment.

A table of bits, set for the anchors of the aliases, is tested where the text lies, in numpy
over all positions of a text at once, so only starts that can be an anchor are cut out and reach the join. It has one size; when most of its bits are
set it lets more through, which costs time only, as the join that follows is exact.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mentionkit.operators.keys import lookup

ANCHOR_CHARS = 6
TABLE_WORDS = 1 << 15
"""Words of 64 bits in the table of anchors: 256 KiB, the size at any number of aliases."""
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_SLICE = 1 << 18
"""Characters of a text that are looked at together."""


def _hasher() -> Callable[[str, int], Iterator[tuple[int, np.ndarray]]]:
    """A function of its own, so that it travels with the tasks and they need not import this module."""

    def hashes(text: str, n: int) -> Iterator[tuple[int, np.ndarray]]:
        """A hash of each substring of ``n`` characters, in slices of bounded size: first position, hashes."""
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        for at in range(0, len(codes) - n + 1, _SLICE):
            part = codes[at : at + _SLICE + n - 1].astype(np.uint64)
            h = np.zeros(len(part) - n + 1, np.uint64)
            for k in range(n):
                h = h * _FACTOR + part[k : k + len(h)]
            yield at, ((h ^ (h >> np.uint64(32))) * _FACTOR) >> np.uint64(24)

    return hashes


def _bit_table(anchored: DataFrame) -> np.ndarray:
    """The bits of the column ``_anchor`` as words, set on the executors; at most ``TABLE_WORDS`` values are collected."""
    hashes = _hasher()

    @F.pandas_udf("long")
    def hashed(anchors: pd.Series) -> pd.Series:
        return pd.Series([int(next(hashes(a, len(a)))[1][0]) if a else None for a in anchors], dtype="Int64")

    place = F.pmod(hashed(F.col("_anchor")), F.lit(TABLE_WORDS * 64))
    mask = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod("slot", F.lit(64)).cast("int"))
    slots = anchored.select(place.alias("slot")).filter("slot IS NOT NULL")
    bits = np.zeros(TABLE_WORDS, np.int64)
    for r in slots.groupBy(F.shiftright("slot", 6).alias("word")).agg(F.bit_or(mask).alias("bits")).collect():
        bits[r["word"]] = r["bits"]
    return bits.view(np.uint64)


def possible_anchors(texts: DataFrame, keys: Sequence[str], lowered: str, anchored: DataFrame, lengths: Sequence[int]) -> DataFrame:
    """``keys, _anchor``: the distinct substrings of each text, of the given lengths, that may be an anchor."""
    bits, wanted = _bit_table(anchored), sorted(n for n in lengths if n)
    slots_mask = np.uint64(len(bits) * 64 - 1)
    always, hashes = [""] if 0 in lengths else [], _hasher()

    def starts(text: str) -> list[str]:
        found = set(always)
        for n in wanted:
            for at, found_hashes in hashes(text, n):
                slots = found_hashes & slots_mask
                hit = (bits[slots >> np.uint64(6)] >> (slots & np.uint64(63))) & np.uint64(1)
                found.update(text[at + i : at + i + n] for i in np.flatnonzero(hit).tolist())
        return sorted(found)

    @F.pandas_udf("array<string>")
    def candidates(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([[] if t is None else starts(t) for t in batch], dtype=object)

    cut = texts.select(*keys, F.explode_outer(candidates(F.col(lowered))).alias("_anchor"))
    return cut.filter(F.col("_anchor").isNotNull())


def alias_hits(
    texts: DataFrame,
    keys: Sequence[str],
    lowered: str,
    aliases: DataFrame,
) -> DataFrame:
    """(keys, tool, alias, tier) for every alias that occurs in a text, once per key.

    ``keys`` has to identify the text: copies under one key are checked as one if
    they are equal, and apart if they are not.
    """
    anchored = aliases.withColumn("_anchor", F.left("alias", F.lit(ANCHOR_CHARS)))
    # at most ANCHOR_CHARS values
    lengths = [r["n"] for r in anchored.select(F.length("_anchor").alias("n")).distinct().collect()] or [ANCHOR_CHARS]

    hashed = texts.select(*keys, lowered, F.xxhash64(lowered).alias("_text"))
    # the text stays behind: only its hash travels with the anchors, and texts are shuffled once, to be checked
    narrow = possible_anchors(hashed, [*keys, "_text"], lowered, anchored, lengths)
    per_text = lookup(narrow, anchored, ["_anchor"], "inner").drop("_anchor").distinct()
    checked = hashed.join(per_text, [*keys, "_text"])
    return checked.filter(F.contains(F.col(lowered), F.col("alias"))).select(*keys, "tool", "alias", "tier").distinct()


def mentions_by_table(
    texts: DataFrame,
    keys: Sequence[str],
    lowered: str,
    aliases: DataFrame,
    has_context: Column,
    is_excluded: Column,
) -> DataFrame:
    """(keys, tool): the matching rules of the expression form, aliases taken from a table."""
    usable = texts.filter((F.length(lowered) > 0) & ~is_excluded).withColumn("_context", has_context)
    hits = alias_hits(usable, [*keys, "_context"], lowered, aliases)
    counted = hits.filter((F.col("tier") == "strong") | F.col("_context"))
    return counted.select(*keys, "tool").distinct()
