"""Bronze to silver, one increment per run."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from mentionkit import schemas
from mentionkit.catalog import EntityCatalog
from mentionkit.operators.audit import FAILED, AuditLog
from mentionkit.operators.marks import read_mark
from mentionkit.operators.refine import Source, as_silver, find_mentions, new_mentions, normalise, without_id
from mentionkit.sources.shared import store
from mentionkit.sources.tables import Tables

SILVER, REJECTED = "silver", "silver_rejected"
MARK_TABLE = "refine_marks"


def stored_mark(tables: Tables, source: Source) -> datetime | None:
    """How far bronze has been read.

    Kept apart from the silver rows, so that an increment without a single match
    is not read again. Falls back to the silver rows of older runs.
    """
    marks = tables.read_if_exists(MARK_TABLE)
    if marks is not None:
        own = marks.filter((F.col("source") == source.name) & (F.col("layer") == SILVER))
        mark = read_mark(own, F.col("mark"))
        if mark is not None:
            return mark
    return read_mark(tables.read_if_exists(source.silver_table), F.col("ingested_at"))


def refine_source(
    tables: Tables,
    source: Source,
    catalog: EntityCatalog,
    cleaned_at: datetime | None = None,
    look_back: timedelta = timedelta(0),
    **options,
) -> int:
    """Refine the bronze rows ingested since the last run and append the new mentions.

    Rows at the mark are read again, as a second delivery may carry the same time; ``look_back`` re-reads that much
    more before it for rows that were committed late. Mentions already in silver are left out by key, so re-reading,
    or running again after a crash between the two writes, adds nothing twice. Rows without an id are rejected; their
    number is logged if there are any.
    """
    with AuditLog(tables).step(source.name, SILVER) as step:
        time = F.col("ingested_at")
        mark = stored_mark(tables, source)
        since = mark - look_back if mark is not None else None
        fresh = tables.read_since(source.bronze_table, since)
        # the upper end is fixed first: rows that arrive meanwhile belong to the next run
        upper = read_mark(fresh, time)
        if upper is None:
            return 0
        cleaned_at = cleaned_at or datetime.now(timezone.utc)
        tables.ensure(source.silver_table, schemas.SILVER)
        fresh = fresh.filter(time <= F.lit(upper))
        rejected = without_id(fresh.filter(time > F.lit(mark)) if mark is not None else fresh, source).count()
        if rejected:
            AuditLog(tables).log(source.name, REJECTED, rejected, FAILED, f"{rejected} rows without an id")
        mentions = store(find_mentions(normalise(fresh, source), catalog, **options), "increment")
        new = as_silver(new_mentions(mentions, tables.read(source.silver_table)), cleaned_at)
        step.rows = tables.append(new, source.silver_table, evolve=True)
        row = (source.name, SILVER, upper, cleaned_at)
        tables.append(tables.spark.createDataFrame([row], schemas.MARK_SCHEMA), MARK_TABLE)
    return step.rows
