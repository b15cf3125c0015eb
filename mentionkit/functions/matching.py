"""Entity matching as column expressions: no UDF, no shuffle.

Rules, in order: an empty text matches nothing; a text with an exclusion phrase
matches nothing; a strong alias matches its entity; a weak alias matches its
entity if the text holds a context keyword as well. Aliases are raw substrings
of the lowercased text unless ``word_boundary`` is set.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mentionkit.catalog import EntityCatalog

# Above this number of needles one literal array is searched instead of chaining
# comparisons, which keeps the generated code small.
MAX_CHAINED_NEEDLES = 64


def contains_any(lowered: Column, needles: Sequence[str], word_boundary: bool = False) -> Column:
    """True if any needle occurs in the (already lowercased) text."""
    if not needles:
        return F.lit(False)
    if word_boundary:
        alternatives = "|".join(re.escape(n) for n in needles)
        return lowered.rlike(rf"(?<![\p{{L}}\p{{N}}])(?:{alternatives})(?![\p{{L}}\p{{N}}])")
    if len(needles) > MAX_CHAINED_NEEDLES:
        return F.exists(F.lit(list(needles)), lambda n: F.contains(lowered, n))
    return reduce(or_, [F.contains(lowered, F.lit(n)) for n in needles])


def _blocked_by(catalog: EntityCatalog, aliases: Sequence[str], scope: str) -> list[str]:
    """Exclusion phrases that act on one entity."""
    if scope == "text":
        return []
    return [p for p in catalog.exclusions if any(a in p for a in aliases)]


def match_entities(
    lowered: Column,
    catalog: EntityCatalog,
    has_context: Column | None = None,
    word_boundary: bool = False,
    exclusion_scope: str = "text",
) -> Column:
    """Names of the entities in a lowercased text: sorted, distinct, never NULL.

    ``lowered`` is read once per alias; hand in a materialised column (see
    ``with_matches``). ``exclusion_scope="entity"`` lets an exclusion phrase block
    only the entities whose alias it contains, instead of the whole text.
    """
    if exclusion_scope not in ("text", "entity"):
        raise ValueError(f"unknown exclusion_scope {exclusion_scope!r}")
    if has_context is None:
        has_context = contains_any(lowered, catalog.context, word_boundary)

    found = []
    for e in catalog.sorted_entities:
        hit = contains_any(lowered, e.strong, word_boundary)
        if e.weak:
            hit = hit | (contains_any(lowered, e.weak, word_boundary) & has_context)
        blocked = _blocked_by(catalog, e.strong + e.weak, exclusion_scope)
        if blocked:
            hit = hit & ~contains_any(lowered, blocked, word_boundary)
        found.append(F.when(hit, F.lit(e.name)))

    none = F.array().cast("array<string>")
    # array_except drops the NULLs of the misses inside generated code
    matched = F.array_except(F.array(*found), F.array(F.lit(None).cast("string")))
    usable = F.length(lowered) > 0
    if exclusion_scope == "text" and catalog.exclusions:
        usable = usable & ~contains_any(lowered, catalog.exclusions, word_boundary)
    return F.when(usable, matched).otherwise(none)


def with_matches(
    df: DataFrame,
    text: Column,
    catalog: EntityCatalog,
    output: str = "matched_tools",
    **options,
) -> DataFrame:
    """Add the array of matched entities.

    Lowercasing and the context test go into columns of their own, which the
    optimizer keeps because several expressions read them.
    """
    word_boundary = options.get("word_boundary", False)
    staged = df.withColumn("_lowered", F.lower(text))
    staged = staged.withColumn("_context", contains_any(F.col("_lowered"), catalog.context, word_boundary))
    matched = match_entities(F.col("_lowered"), catalog, F.col("_context"), **options)
    return staged.withColumn(output, matched).drop("_lowered", "_context")


def explode_matches(df: DataFrame, matches: str = "matched_tools", output: str = "tool") -> DataFrame:
    """One row per (input row, entity); rows without a match go.

    A plain ``explode`` makes the optimizer infer ``size(matches) > 0`` and push it
    to the scan, where it would run the cleaning and the matching once more per
    alias. The outer form with a filter on its output runs them once.
    """
    return df.withColumn(output, F.explode_outer(matches)).drop(matches).filter(F.col(output).isNotNull())
