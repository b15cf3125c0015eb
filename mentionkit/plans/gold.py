"""Silver to scored mentions, quality checks, report tables."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mentionkit import schemas
from mentionkit.catalog import EntityCatalog
from mentionkit.functions.times import post_date
from mentionkit.operators import aggregates as agg
from mentionkit.operators import quality
from mentionkit.operators.audit import FAILED, SUCCESS, AuditLog
from mentionkit.operators.keys import SCORED_KEY, not_in
from mentionkit.operators.ranking import merge_ends, near_the_ends, top_bottom_ends, top_bottom_posts
from mentionkit.operators.refine import HACKERNEWS, REDDIT, Source, union_sources
from mentionkit.operators.scoring import Scorer, ScoringRun, score_pending
from mentionkit.sources.shared import store
from mentionkit.sources.tables import Tables

SCORED_TABLE = "sentiment_scored"
ROLLUP_TABLE, TOP_STATE, REPORT_DAYS = "rollup_by_day", "top_posts_state", "report_days"
QUALITY_DAYS, REPEATED_KEYS = "quality_by_day", "repeated_keys"
OPEN, FOLDED, CHECKED = "open", "folded", "checked"
GOLD, QUALITY, ALL_SOURCES = "gold", "gold_dq_check", "all"
# sources scored unless others are named
SCORED_SOURCES = (HACKERNEWS, REDDIT)


def score_sources(
    tables: Tables,
    scorer: Scorer,
    sources: Sequence[Source] = SCORED_SOURCES,
    scored_table: str = SCORED_TABLE,
    **limits,
) -> ScoringRun:
    """Score the pending rows of the given sources' silver tables, as far as these exist."""
    with AuditLog(tables).step(ALL_SOURCES, GOLD) as step:
        there = [tables.read(s.silver_table) for s in sources if tables.exists(s.silver_table)]
        if not there:
            tables.ensure(scored_table, schemas.SCORED)
            return ScoringRun(scored=0, remaining=0, batches=0)
        silver = union_sources(*there)
        run = score_pending(silver, tables, scored_table, scorer, before=lambda rows: open_days(tables, rows), **limits)
        step.rows = run.scored
    return run


def check_quality(tables: Tables, catalog: EntityCatalog, scored_table: str = SCORED_TABLE) -> DataFrame:
    """Run the checks over all scored rows and log the outcome; a failed check is logged, not raised."""
    return _logged(tables, quality.quality_report(tables.read(scored_table), catalog, keys=SCORED_KEY))


def _logged(tables: Tables, report: DataFrame) -> DataFrame:
    report = store(report, "quality")
    total = report.filter("check = 'not_empty'").first()["total"]
    issues = quality.issue_summary(report).first()["issues"]
    AuditLog(tables).log(ALL_SOURCES, QUALITY, total, FAILED if issues else SUCCESS, issues)
    return report


def report_frames(scored: DataFrame) -> dict[str, DataFrame]:
    """The five report tables from two looks at the scored rows.

    Four follow from the daily roll-up, which is stored once; it has one row per
    (tool, source, day). The best and worst posts need the rows themselves.
    """
    return _from_rollup(store(agg.daily_rollup(scored), "rollup"), top_bottom_posts(scored))


def _from_rollup(rollup: DataFrame, top: DataFrame) -> dict[str, DataFrame]:
    return {
        "sentiment_by_tool_daily": agg.daily_from_rollup(rollup),
        "sentiment_by_tool_source": agg.by_source_from_rollup(rollup),
        "tool_leaderboard": agg.leaderboard_from_rollup(rollup),
        "sentiment_trend_weekly": agg.weekly_from_rollup(rollup),
        "top_posts_by_tool": top,
    }


def _replace_reports(tables: Tables, frames: dict[str, DataFrame]) -> DataFrame:
    for name, frame in frames.items():
        tables.replace(frame, name)
    return agg.table_counts({name: tables.read(name) for name in frames})


def rebuild_reports(tables: Tables, scored_table: str = SCORED_TABLE) -> DataFrame:
    """Replace the report tables, from all scored rows, and return their row counts."""
    return _replace_reports(tables, report_frames(tables.read(scored_table)))


# -- reports by increment ---------------------------------------------------------------


def open_days(tables: Tables, pending: DataFrame) -> str:
    """Note the days that a run is about to score rows of, before it appends any. Returns the run's name.

    A day stays open until a fold has taken it in, so a run that dies, at any place, leaves no row out of the reports.
    """
    run = uuid.uuid4().hex
    tables.ensure(REPORT_DAYS, schemas.REPORT_DAY_SCHEMA)
    days = pending.select(post_date(F.col("created_at")).alias("day")).distinct()
    tables.append(_noted(days, run, OPEN), REPORT_DAYS)
    return run


def _noted(days: DataFrame, run: str, state: str) -> DataFrame:
    now = datetime.now(timezone.utc)
    return days.select(F.lit(run).alias("run"), F.col("day"), F.lit(state).alias("state"), F.lit(now).alias("run_timestamp"))


def fold_reports(tables: Tables, scored_table: str = SCORED_TABLE) -> DataFrame:
    """Bring the report tables up to date with the days that runs have touched since the last fold, and return their row counts.

    The roll-up is a table of a few rows per day. The touched days are summed up again from their scored rows, and take the place of what the
    roll-up has for them, so a fold that is repeated, or that finds half the work done, gives the same. It is written whole, as the reports read it
    whole, since folders of a few rows each cost far more than the rows. The best and worst posts are a state of a few
    rows per tool that is merged with those of the touched days. Four reports follow from the roll-up, the fifth from the state; scored rows of other days
    are not read if the scored table is laid out by the day of ``created_at``, and skipped by statistics if not. The first fold takes in all rows.
    """
    todo = _still_open(tables, FOLDED)
    first = not (tables.exists(ROLLUP_TABLE) and tables.exists(TOP_STATE))
    touched = tables.read(scored_table) if first else _touched_rows(tables, scored_table, todo)
    rollup = store(agg.daily_rollup(touched), "rollup")
    if not first:
        rollup = rollup.unionByName(not_in(tables.read(ROLLUP_TABLE), rollup, ["post_date"], nulls_equal=True))
    tables.replace(rollup, ROLLUP_TABLE)
    # the few rows that both ends are taken from
    ends = top_bottom_ends(store(near_the_ends(touched), "near-ends"))
    if not first:
        ends = merge_ends(tables.read(TOP_STATE), ends)
    # written first, as it is read from the table that it replaces
    tables.replace(store(ends, "top-state"), TOP_STATE)
    counts = _replace_reports(tables, _from_rollup(tables.read(ROLLUP_TABLE), tables.read(TOP_STATE).drop("post_id")))
    _close(tables, todo, FOLDED)
    return counts


def _still_open(tables: Tables, state: str) -> DataFrame:
    """``run, day`` of the runs that have not come to ``state``."""
    tables.ensure(REPORT_DAYS, schemas.REPORT_DAY_SCHEMA)
    log = tables.read(REPORT_DAYS)
    done = log.filter(F.col("state") == state).select("run").distinct()
    return store(log.filter(F.col("state") == OPEN).join(done, "run", "left_anti").select("run", "day"), "report-days")


def _touched_rows(tables: Tables, scored_table: str, todo: DataFrame) -> DataFrame:
    # at most one per day of the reports' life
    days = [r["day"] for r in todo.select("day").distinct().collect()]
    return tables.read_days(scored_table, days, "created_at")


def _close(tables: Tables, todo: DataFrame, state: str) -> None:
    runs = todo.select("run", F.lit(None).cast("date").alias("day")).distinct()
    tables.append(runs.select("run", "day", F.lit(state).alias("state"), F.lit(datetime.now(timezone.utc)).alias("run_timestamp")), REPORT_DAYS)


def fold_quality(tables: Tables, catalog: EntityCatalog, scored_table: str = SCORED_TABLE) -> DataFrame:
    """The checks of ``check_quality``, logged likewise, from a state that is brought up to date with the days touched since the last check.

    Counts are kept per day: the touched days are counted again from their rows and take the place of what was there, so a check that died or is repeated
    gives the same. Repeated keys are kept in a table: only keys of touched days are counted again. Of other days, key columns alone are read, and no
    key of them is shuffled if the touched ones are few. The first check takes in all rows, and so does one after the start dates have changed.
    """
    if quality.missing_scored_columns(tables.read(scored_table)):
        return check_quality(tables, catalog, scored_table)
    todo = _still_open(tables, CHECKED)
    starts = hashlib.sha256(repr(sorted((tool, day.isoformat()) for tool, day in catalog.starts.items())).encode()).hexdigest()
    first = not (tables.exists(QUALITY_DAYS) and tables.exists(REPEATED_KEYS))
    if not first:
        first = not tables.read(QUALITY_DAYS).filter(F.col("starts") != starts).isEmpty()
    scored = tables.read(scored_table)
    touched = scored if first else _touched_rows(tables, scored_table, todo)
    if first:
        repeated = quality.duplicate_keys(scored, SCORED_KEY)
    else:
        keys = store(touched.select(*SCORED_KEY).distinct(), "touched-keys")
        repeated = quality.merge_repeated(tables.read(REPEATED_KEYS), scored, keys, SCORED_KEY)
    days = store(quality.metrics_by_day(touched, catalog).withColumn("starts", F.lit(starts)), "quality-days")
    if not first:
        days = days.unionByName(not_in(tables.read(QUALITY_DAYS), days, ["post_date"], nulls_equal=True))
    # written first, as both are read from the tables that they replace
    tables.replace(store(days, "quality-days"), QUALITY_DAYS)
    tables.replace(store(repeated, "repeated-keys"), REPEATED_KEYS)
    report = _logged(tables, quality.report_from(quality.summed_metrics(tables.read(QUALITY_DAYS)), tables.read(REPEATED_KEYS), keys=SCORED_KEY))
    _close(tables, todo, CHECKED)
    return report
