"""Data-quality checks on scored mentions.

Range, null rate, start dates and emptiness come from one aggregate over the
table; only the uniqueness check needs a shuffle of its own. Both can be kept as
a state: counts per day, which add up, and the keys known to repeat.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mentionkit import schemas
from mentionkit.catalog import EntityCatalog
from mentionkit.functions.times import post_date
from mentionkit.operators.aggregates import SCORE
from mentionkit.operators.keys import MENTION_KEY, among, lookup, not_in

# Score range and the share of missing scores that is still accepted.
LOWEST, HIGHEST = -1, 1
MAX_NULL_PCT = 5.0


def is_out_of_range(score: Column) -> Column:
    return score.isNotNull() & ((score < LOWEST) | (score > HIGHEST))


def is_before_launch(catalog: EntityCatalog) -> Column:
    return F.col("created_at") < catalog.start_of(F.col("tool")).cast("timestamp")


def out_of_range(scored: DataFrame) -> DataFrame:
    return scored.filter(is_out_of_range(F.col(SCORE)))


def before_launch(scored: DataFrame, starts: DataFrame) -> DataFrame:
    """Rows older than the start date of their own tool, for start dates kept as a table."""
    joined = lookup(scored, starts, ["tool"], "inner")
    return joined.filter(F.col("created_at") < F.col("launch_date").cast("timestamp"))


def duplicate_keys(scored: DataFrame, keys: Sequence[str] = MENTION_KEY) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return scored.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def null_rate(scored: DataFrame) -> DataFrame:
    """Missing scores: number, rows in all and percentage (0 for an empty table)."""
    total, nulls = F.count(F.lit(1)), F.count_if(F.col(SCORE).isNull())
    return scored.agg(
        nulls.alias("null_scores"),
        total.alias("total_rows"),
        F.coalesce(F.round(F.try_divide(nulls * 100, total), 2), F.lit(0.0)).alias("null_pct"),
    )


def _metric_counts(catalog: EntityCatalog) -> dict[str, Column]:
    s = F.col(SCORE)
    return {
        "total_rows": F.count(F.lit(1)),
        "out_of_range": F.count_if(is_out_of_range(s)),
        "null_scores": F.count_if(s.isNull()),
        "before_launch": F.count_if(is_before_launch(catalog)),
    }


def _with_null_pct(counts: DataFrame) -> DataFrame:
    return counts.withColumn("null_pct", F.coalesce(F.round(F.try_divide(F.col("null_scores") * 100, "total_rows"), 2), F.lit(0.0)))


def quality_metrics(scored: DataFrame, catalog: EntityCatalog) -> DataFrame:
    """One row with the counts behind the checks, from one pass."""
    return _with_null_pct(scored.agg(*[c.alias(name) for name, c in _metric_counts(catalog).items()]))


def metrics_by_day(scored: DataFrame, catalog: EntityCatalog) -> DataFrame:
    """The same counts per day of ``created_at``; they add up. Rows without a time have a day of their own, NULL."""
    counts = [c.alias(name) for name, c in _metric_counts(catalog).items()]
    return scored.groupBy(post_date(F.col("created_at")).alias("post_date")).agg(*counts)


def summed_metrics(by_day: DataFrame) -> DataFrame:
    """The row of ``quality_metrics`` from counts per day."""
    names = ("total_rows", "out_of_range", "null_scores", "before_launch")
    return _with_null_pct(by_day.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in names]))


def merge_repeated(before: DataFrame, scored: DataFrame, touched: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys, n`` of the keys that occur more than once, brought up to date.

    ``before`` holds those known so far, ``touched`` the distinct keys, stored, of all rows added since. A key can only have become a repeated one if it
    is touched, so the rows of these are counted again, and the rest stays as it was. The table's keys are cut to the touched ones first: few of them
    are broadcast, by the size of their files, and earlier keys do not travel.
    """
    again = duplicate_keys(among(scored.select(*keys), touched, keys, nulls_equal=True), keys)
    return not_in(before, touched, keys, nulls_equal=True).unionByName(again)


def quality_report(
    scored: DataFrame,
    catalog: EntityCatalog,
    max_null_pct: float = MAX_NULL_PCT,
    keys: Sequence[str] = MENTION_KEY,
) -> DataFrame:
    """One row per check: violations, rows looked at, whether it passed, what was found.

    A column that is missing is a violation of its own and counts as NULL in the other checks.
    """
    missing = missing_scored_columns(scored)
    scored = scored.withColumns({c: F.lit(None).cast(schemas.SCORED[c].dataType) for c in missing})
    return report_from(quality_metrics(scored, catalog), duplicate_keys(scored, keys), max_null_pct, keys, missing)


def report_from(
    metrics: DataFrame,
    repeated: DataFrame,
    max_null_pct: float = MAX_NULL_PCT,
    keys: Sequence[str] = MENTION_KEY,
    missing: Sequence[str] = (),
) -> DataFrame:
    """The report from the counts of ``quality_metrics`` and the repeated keys, which may come from the table or from a state."""
    share = F.concat(F.lit("rows without a score ("), "null_pct", F.lit(f" %), above {max_null_pct:g} %"))
    checks = [
        ("columns", "missing", F.col("missing") == 0, f"missing columns: {', '.join(missing)}"),
        ("score_range", "out_of_range", F.col("out_of_range") == 0, "rows with a score outside [-1, 1]"),
        ("null_rate", "null_scores", F.col("null_pct") <= max_null_pct, share),
        ("launch_dates", "before_launch", F.col("before_launch") == 0, "rows dated before the launch of their tool"),
        ("not_empty", "empty", F.col("total_rows") > 0, "empty table"),
    ]
    rows = [
        F.struct(
            F.lit(name).alias("check"),
            F.col(count).alias("violations"),
            F.col("total_rows").alias("total"),
            passed.alias("passed"),
            F.when(~passed, F.concat_ws(" ", F.col(count), issue if isinstance(issue, Column) else F.lit(issue))).alias("detail"),
        )
        for name, count, passed, issue in checks
    ]
    metrics = metrics.withColumns({
        "empty": F.when(F.col("total_rows") == 0, 1).otherwise(0).cast("bigint"),
        "missing": F.lit(len(missing)).cast("bigint"),
    })
    one_pass = metrics.select(F.inline(F.array(*rows)))

    counted = repeated.agg(F.count(F.lit(1)).alias("violations"), F.coalesce(F.sum("n"), F.lit(0)).alias("total"))
    unique = counted.select(
        F.lit("unique_keys").alias("check"),
        "violations",
        "total",
        (F.col("violations") == 0).alias("passed"),
        F.when(F.col("violations") > 0, F.concat_ws(" ", "violations", F.lit(f"repeated ({', '.join(keys)}) pairs"))).alias("detail"),
    )
    return one_pass.unionByName(unique)


def missing_scored_columns(scored: DataFrame) -> list[str]:
    return schemas.missing_columns(scored, schemas.SCORED)


def issue_summary(report: DataFrame) -> DataFrame:
    """One row: number of failed checks and their details joined by '; ' (NULL if all passed)."""
    failed = F.filter(F.sort_array(F.collect_list(F.struct("check", "passed", "detail"))), lambda c: ~c["passed"])
    return report.agg(failed.alias("failed")).select(
        F.size("failed").cast("bigint").alias("failed_checks"),
        F.when(F.size("failed") > 0, F.concat_ws("; ", F.transform("failed", lambda c: c["detail"]))).alias("issues"),
    )


def assert_quality(report: DataFrame) -> None:
    """Raise if a check failed; for callers that want a bad table to stop the run."""
    summary = issue_summary(report).first()
    if summary["failed_checks"]:
        raise ValueError(summary["issues"])

