"""Best and worst posts per tool, exact batches of pending rows, display order."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mentionkit.operators.aggregates import SCORE, scored_only
from mentionkit.operators.keys import MENTION_KEY, SCORED_KEY, keep_first
from mentionkit.sources.shared import store

# Posts per tool and end, labels, rows per scoring batch.
TOP_POSTS = 5
MOST_POSITIVE = "most_positive"
MOST_NEGATIVE = "most_negative"
BATCH_ROWS = 500

_PARTS_PER_POST = 16
"""Parts of the rows per post of an end; more of them let fewer rows through that are not at an end."""

_TOP_COLUMNS = ("tool", "source", "title", "url", SCORE, "created_at", "post_id")


def top_bottom_posts(scored: DataFrame, k: int = TOP_POSTS) -> DataFrame:
    """The k best and the k worst scored posts of every tool.

    Each branch keeps its own rank only, so that the rank filter becomes a group
    limit: every task sends at most k rows per tool to the shuffle, also for a tool
    that holds most of the rows. Equal scores are ordered by post and source.
    """
    return top_bottom_ends(scored, k).drop("post_id")


def top_bottom_ends(scored: DataFrame, k: int = TOP_POSTS) -> DataFrame:
    """``top_bottom_posts`` with the id of the post: at most 2 k rows per tool, of which any number of sets can be merged."""
    posts = near_the_ends(scored, k)

    def end(order: Column, category: str) -> DataFrame:
        window = Window.partitionBy("tool").orderBy(order, "post_id", "source")
        return (
            posts.withColumn("_rank", F.row_number().over(window))
            .filter(F.col("_rank") <= k)
            .drop("_rank")
            .withColumn("category", F.lit(category))
        )

    return end(F.desc(SCORE), MOST_POSITIVE).unionByName(end(F.asc(SCORE), MOST_NEGATIVE))


def near_the_ends(scored: DataFrame, k: int = TOP_POSTS) -> DataFrame:
    """The rows that may be among the k best or worst of their tool, so that these alone are sorted; all rows of a tool that has few.

    Posts are dealt out by a hash of their id. The best rows of k parts are k rows, so no row below the k-th best of them can be among the k best.
    """
    posts = scored_only(scored).select(*_TOP_COLUMNS)
    part = F.pmod(F.xxhash64("post_id"), F.lit(_PARTS_PER_POST * k)).alias("_part")
    parts = posts.groupBy("tool", part).agg(F.max(SCORE).alias("high"), F.min(SCORE).alias("low"))
    kth = [F.get(F.sort_array(F.collect_list(c), asc=c == "low"), F.lit(k - 1)).alias(f"_{c}") for c in ("high", "low")]
    # one row per catalog entity, which is null-safe as rows without one are ranked, too
    limits = F.broadcast(parts.groupBy(F.col("tool").alias("_their_tool")).agg(*kth))
    s, high, low = F.col(SCORE), F.col("_high"), F.col("_low")
    met = posts.join(limits, F.col("tool").eqNullSafe(F.col("_their_tool")), "left")
    return met.filter(high.isNull() | (s >= high) | (s <= low)).select(*_TOP_COLUMNS)


def merge_ends(*ends: DataFrame, k: int = TOP_POSTS) -> DataFrame:
    """The k best and worst posts of all that any of the frames holds; a post that several hold, or that is at both ends, counts once."""
    rows = reduce(DataFrame.unionByName, [e.select(*_TOP_COLUMNS) for e in ends])
    return top_bottom_ends(keep_first(rows, SCORED_KEY), k)


def in_batches(pending: DataFrame, rows: int = BATCH_ROWS, keys: Sequence[str] = MENTION_KEY) -> DataFrame:
    """All rows with the number of their ``batch``: exactly ``rows`` rows each by key order, but for the last.

    The rows are dealt out by key range and stored; a row's place is its place within its range after the rows of
    all earlier ranges, of which there are as many as partitions.
    """
    dealt = store(pending.repartitionByRange(*keys).withColumn("_range", F.spark_partition_id()), "batches")
    before = Window.partitionBy().orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    ranges = ranges.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    rest = [c for c in pending.columns if c not in keys]
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*keys, *rest)) + F.col("_before") - 1
    numbered = dealt.join(ranges, "_range").withColumn("batch", F.floor(place / rows).cast("long"))
    return numbered.select(*pending.columns, "batch")


def violations_in_order(violations: DataFrame, keys: Sequence[str] = MENTION_KEY) -> DataFrame:
    """Every violating row, by key; how many are shown is up to the display."""
    return violations.orderBy(*keys)


# How each report is read. A table has no lasting order, so it is applied on reading.
REPORT_ORDER = {
    "sentiment_by_tool_daily": ("post_date desc", "tool"),
    "sentiment_by_tool_source": ("tool", "source"),
    "tool_leaderboard": ("avg_sentiment desc", "tool"),
    "sentiment_trend_weekly": ("tool", "week_start desc"),
    "top_posts_by_tool": ("tool", "category", "sentiment_score desc"),
    "scoring_summary": ("rows_scored desc", "tool"),
}


def in_report_order(report: DataFrame, name: str) -> DataFrame:
    return report.orderBy(*[F.expr(c.removesuffix(" desc")).desc() if c.endswith(" desc") else F.col(c) for c in REPORT_ORDER[name]])
