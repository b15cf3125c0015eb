"""Bronze rows to silver mentions: clean, match, one row per (post, entity)."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mentionkit import schemas
from mentionkit.catalog import EntityCatalog
from mentionkit.functions.matching import explode_matches, with_matches
from mentionkit.functions.text import clean_text
from mentionkit.functions.times import parse_iso
from mentionkit.operators.keys import MENTION_KEY, among, keep_first, key_counts, lookup, pick
from mentionkit.sources.shared import store


@dataclass(frozen=True)
class Source:
    """How the rows of one source become silver rows.

    ``columns`` maps silver columns to bronze expressions.
    """

    name: str
    bronze_table: str
    silver_table: str
    columns: Mapping[str, Callable[[], Column]] = field(repr=False)
    markdown: bool = False
    title_stands_in: bool = False


HACKERNEWS = Source(
    name="hackernews",
    bronze_table="hn_raw",
    silver_table="hn_clean",
    columns={
        "post_id": lambda: F.col("object_id"),
        "author": lambda: F.col("author"),
        "score": lambda: F.col("points"),
        "num_comments": lambda: F.col("num_comments"),
        "url": lambda: F.col("url"),
        "created_at": lambda: parse_iso(F.col("hn_created_at")),
    },
)
REDDIT = Source(
    name="reddit",
    bronze_table="reddit_raw",
    silver_table="reddit_clean",
    columns={
        "post_id": lambda: F.col("object_id"),
        "author": lambda: F.col("author"),
        "score": lambda: F.col("score"),
        "num_comments": lambda: F.col("num_comments"),
        "url": lambda: F.col("permalink"),
        "created_at": lambda: F.col("reddit_created_utc"),
    },
    markdown=True,
    title_stands_in=True,
)
PRODUCTHUNT = Source(
    name="producthunt",
    bronze_table="producthunt_raw",
    silver_table="producthunt_clean",
    columns={
        "post_id": lambda: F.col("object_id"),
        "author": lambda: F.col("author"),
        "score": lambda: F.col("votes_count"),
        "num_comments": lambda: F.col("num_comments"),
        "url": lambda: F.col("url"),
        "created_at": lambda: parse_iso(F.col("ph_created_at")),
    },
)
SOURCES = (HACKERNEWS, REDDIT, PRODUCTHUNT)


def normalise(bronze: DataFrame, source: Source) -> DataFrame:
    """Rename and cast to silver columns, title and text cleaned; no matching yet."""
    title = clean_text(F.col("title"), source.markdown)
    text = clean_text(F.col("text"), source.markdown)
    cleaned = bronze.withColumns({"_title": title, "_text": text})
    body = F.coalesce("_text", "_title") if source.title_stands_in else F.col("_text")
    columns = {name: make() for name, make in source.columns.items()}
    for counter in ("score", "num_comments"):
        columns[counter] = columns[counter].try_cast("int")
    return cleaned.select(
        *[column.alias(name) for name, column in columns.items()],
        F.lit(source.name).alias("source"),
        "object_type",
        F.col("_title").alias("title"),
        body.alias("text"),
        "ingested_at",
        F.concat_ws(" ", "_title", "_text").alias("_match_text"),
    )


def launch_guard(mentions: DataFrame, catalog: EntityCatalog, time: str = "created_at") -> DataFrame:
    """Drop mentions dated before their entity existed.

    The start date itself is kept; an undated mention is dropped if its entity has
    a start date; an entity without one is not guarded.
    """
    start = catalog.start_of(F.col("tool"))
    return mentions.filter(start.isNull() | (F.col(time) >= start))


def launch_guard_by_table(mentions: DataFrame, starts: DataFrame, time: str = "created_at") -> DataFrame:
    """The same guard for start dates kept as a table (tool, launch_date)."""
    joined = lookup(mentions, starts, ["tool"])
    start = F.col("launch_date")
    return joined.filter(start.isNull() | (F.col(time) >= start)).drop("launch_date")


def find_mentions(normalised: DataFrame, catalog: EntityCatalog, **options) -> DataFrame:
    """One row per (row, matched entity), guarded by start dates; stateless, so fit for streams.

    Rows without an id are left out: see ``without_id``.
    """
    normalised = normalised.filter(F.col("post_id").isNotNull())
    matched = with_matches(normalised, F.col("_match_text"), catalog, **options).drop("_match_text")
    return launch_guard(explode_matches(matched), catalog)


def without_id(bronze: DataFrame, source: Source) -> DataFrame:
    """Bronze rows that refinement rejects, as nothing tells their mentions apart."""
    return bronze.filter(source.columns["post_id"]().isNull())


def latest_copy(mentions: DataFrame) -> DataFrame:
    """One row per (post, entity): the copy ingested last."""
    return keep_first(mentions, MENTION_KEY, [F.desc_nulls_last("ingested_at")])


def new_mentions(mentions: DataFrame, silver: DataFrame) -> DataFrame:
    """What ``latest_copy`` gives for stored mentions, without those that ``silver`` has; texts do not travel, but for copies."""
    seen = store(key_counts(mentions, MENTION_KEY, among(silver.select(*MENTION_KEY), mentions, MENTION_KEY)), "mention-keys")
    return pick(mentions, seen, MENTION_KEY, [F.desc_nulls_last("ingested_at")])


def refine(
    bronze: DataFrame,
    source: Source,
    catalog: EntityCatalog,
    cleaned_at: datetime | Column | None = None,
    **options,
) -> DataFrame:
    """Bronze rows of one source to silver rows, unique by (post_id, tool).

    The guard runs before deduplication, which is the only shuffle.
    """
    mentions = latest_copy(find_mentions(normalise(bronze, source), catalog, **options))
    return as_silver(mentions, cleaned_at)


def as_silver(mentions: DataFrame, cleaned_at: datetime | Column | None = None) -> DataFrame:
    if cleaned_at is None:
        cleaned_at = F.current_timestamp()
    elif not isinstance(cleaned_at, Column):
        cleaned_at = F.lit(cleaned_at)
    silver = mentions.withColumn("cleaned_at", cleaned_at).select(*schemas.SILVER.names)
    return schemas.validate_silver(silver)


def union_sources(*frames: DataFrame) -> DataFrame:
    """All rows of several silver frames, columns matched by name."""
    return reduce(DataFrame.unionByName, frames)
