"""Sentiment aggregates.

Every table can be built from scored rows directly. Rebuilding all of them goes
through ``daily_rollup``: one pass over the scored rows leaves one row per
(tool, source, day) with sums and counts, from which the trend, source, ranking
and weekly tables follow without another look at the rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mentionkit.functions.scores import exact, is_negative, is_neutral, is_positive, percent, rounded_mean
from mentionkit.functions.times import post_date, week_start

SCORE = "sentiment_score"


# beyond the range of any scale, and of the decimals that means are taken over
MAX_SCORE = 1e15


def is_usable(score: Column) -> Column:
    """NaN, which would rank above every number, and what is too large to be added exactly count as no score."""
    return F.abs(score) < MAX_SCORE


def scored_only(scored: DataFrame) -> DataFrame:
    """Rows with a usable score."""
    return scored.filter(is_usable(F.col(SCORE)))


def daily_rollup(scored: DataFrame) -> DataFrame:
    """Additive measures per (tool, source, day); partly summed in each task before the shuffle."""
    s = F.col(SCORE)
    return (
        scored_only(scored)
        .groupBy("tool", "source", post_date(F.col("created_at")).alias("post_date"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(exact(s)).alias("total"),
            F.min(s).alias("low"),
            F.max(s).alias("high"),
            F.count_if(is_positive(s)).alias("positive"),
            F.count_if(is_negative(s)).alias("negative"),
            F.count_if(is_neutral(s)).alias("neutral"),
        )
    )


def _mean() -> Column:
    return F.sum("total") / F.sum("n")


def daily_from_rollup(rollup: DataFrame) -> DataFrame:
    n = F.sum("n")
    return rollup.groupBy("tool", "post_date").agg(
        n.alias("post_count"),
        rounded_mean(_mean(), 3).alias("avg_sentiment"),
        percent(F.sum("positive"), n).alias("positive_pct"),
        percent(F.sum("negative"), n).alias("negative_pct"),
        percent(F.sum("neutral"), n).alias("neutral_pct"),
    )


def by_source_from_rollup(rollup: DataFrame) -> DataFrame:
    return rollup.groupBy("tool", "source").agg(
        F.sum("n").alias("post_count"),
        rounded_mean(_mean(), 3).alias("avg_sentiment"),
        F.round(F.min("low"), 3).alias("min_sentiment"),
        F.round(F.max("high"), 3).alias("max_sentiment"),
    )


def leaderboard_from_rollup(rollup: DataFrame) -> DataFrame:
    n = F.sum("n")
    per_tool = rollup.groupBy("tool").agg(
        n.alias("total_mentions"),
        _mean().alias("_mean"),
        percent(F.sum("positive"), n).alias("positive_pct"),
    )
    return _ranked(per_tool)


def weekly_from_rollup(rollup: DataFrame) -> DataFrame:
    per_week = rollup.groupBy("tool", week_start(F.col("post_date")).alias("week_start")).agg(
        F.sum("n").alias("post_count"), rounded_mean(_mean(), 3).alias("avg_sentiment")
    )
    return _with_change(per_week)


def sentiment_daily(scored: DataFrame) -> DataFrame:
    """Per tool and day: posts, mean score, share of positive, negative and neutral posts."""
    s, n = F.col(SCORE), F.count(F.lit(1))
    return (
        scored_only(scored)
        .groupBy("tool", post_date(F.col("created_at")).alias("post_date"))
        .agg(
            n.alias("post_count"),
            rounded_mean(F.avg(exact(s)), 3).alias("avg_sentiment"),
            percent(F.count_if(is_positive(s)), n).alias("positive_pct"),
            percent(F.count_if(is_negative(s)), n).alias("negative_pct"),
            percent(F.count_if(is_neutral(s)), n).alias("neutral_pct"),
        )
    )


def sentiment_by_source(scored: DataFrame) -> DataFrame:
    s = F.col(SCORE)
    return (
        scored_only(scored)
        .groupBy("tool", "source")
        .agg(
            F.count(F.lit(1)).alias("post_count"),
            rounded_mean(F.avg(exact(s)), 3).alias("avg_sentiment"),
            F.round(F.min(s), 3).alias("min_sentiment"),
            F.round(F.max(s), 3).alias("max_sentiment"),
        )
    )


def leaderboard(scored: DataFrame) -> DataFrame:
    """Tools ranked by unrounded mean score; equal means share a rank and leave a gap."""
    s, n = F.col(SCORE), F.count(F.lit(1))
    per_tool = (
        scored_only(scored)
        .groupBy("tool")
        .agg(n.alias("total_mentions"), F.avg(exact(s)).alias("_mean"), percent(F.count_if(is_positive(s)), n).alias("positive_pct"))
    )
    return _ranked(per_tool)


def _ranked(per_tool: DataFrame) -> DataFrame:
    # one row per catalog entity is left here, so a single partition is enough
    rank = F.rank().over(Window.orderBy(F.desc("_mean")))
    return per_tool.select(
        "tool",
        "total_mentions",
        rounded_mean(F.col("_mean"), 3).alias("avg_sentiment"),
        "positive_pct",
        rank.cast("bigint").alias("sentiment_rank"),
    )


def weekly_trend(scored: DataFrame) -> DataFrame:
    """Per tool and week: posts, mean score, change from the previous week that has posts."""
    per_week = (
        scored_only(scored)
        .groupBy("tool", week_start(F.col("created_at")).alias("week_start"))
        .agg(F.count(F.lit(1)).alias("post_count"), rounded_mean(F.avg(exact(F.col(SCORE))), 3).alias("avg_sentiment"))
    )
    return _with_change(per_week)


def _with_change(per_week: DataFrame) -> DataFrame:
    previous = F.lag("avg_sentiment").over(Window.partitionBy("tool").orderBy("week_start"))
    change = F.round(F.col("avg_sentiment") - previous, 3)
    return per_week.withColumn("sentiment_change_from_prior_week", change)


def scoring_summary(scored: DataFrame) -> DataFrame:
    """Rows and mean score per tool; rows without a score are counted, too."""
    usable = F.when(is_usable(F.col(SCORE)), F.col(SCORE))
    return scored.groupBy("tool").agg(
        F.count(F.lit(1)).alias("rows_scored"), rounded_mean(F.avg(exact(usable)), 2).alias("avg_sentiment")
    )


def table_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """One row per table: name and row count."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, counts)
