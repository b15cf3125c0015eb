"""Landed payloads to bronze tables: what is new, appended once, logged.

Beside the bronze tables stand the marks, the key filters (which days may hold a key) and the lines that are no payload. A run writes the filter of its
rows before the rows: if it dies in between, a day is opened that need not be, and nothing lands twice. Bronze tables are therefore written through this
module, or by ``note_keys`` and an append.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mentionkit import schemas
from mentionkit.functions.times import parse_iso
from mentionkit.operators.audit import FAILED, AuditLog
from mentionkit.operators.keys import among, keep_first, key_counts, not_in, pick, unless_in
from mentionkit.operators.marks import days_of_keys, key_filter, marks_by_key, not_yet_landed, read_mark, row_key, unlanded, unsettled
from mentionkit.operators.refine import HACKERNEWS, PRODUCTHUNT, REDDIT, Source
from mentionkit.sources import landing
from mentionkit.sources.shared import store
from mentionkit.sources.tables import Tables

BRONZE, BRONZE_REJECTED = "bronze", "bronze_rejected"
LANDING_MARKS = "landing_marks"
KEY_FILTERS = "landing_filters"
REJECTED_LINES = "bronze_rejected_lines"

# what tells a source's rows apart; the first is its id
ROW_KEYS = {
    HACKERNEWS.name: ("object_id", "query_tool", "hn_created_at"),
    REDDIT.name: ("object_id", "query_tool", "subreddit", "reddit_created_utc"),
    # a post stands for its comments
    PRODUCTHUNT.name: ("object_id",),
}
_RAW = {HACKERNEWS.name: schemas.HN_RAW, REDDIT.name: schemas.REDDIT_RAW}


def land_hackernews(tables: Tables, pages: DataFrame, ingested_at: datetime | None = None) -> int:
    time, keys = parse_iso(F.col("hn_created_at")), ROW_KEYS[HACKERNEWS.name]
    pages = keep_rejected(tables, pages, HACKERNEWS, ingested_at)
    return _append(tables, lambda: _new(tables, landing.hn_rows(pages, ingested_at), HACKERNEWS, ["query_tool"], time, keys), schemas.HN_RAW, HACKERNEWS)


def land_reddit(tables: Tables, submissions: DataFrame, ingested_at: datetime | None = None) -> int:
    time, keys = F.col("reddit_created_utc"), ROW_KEYS[REDDIT.name]
    submissions = keep_rejected(tables, submissions, REDDIT, ingested_at)
    rows = landing.reddit_rows(submissions, ingested_at)
    return _append(tables, lambda: _new(tables, rows, REDDIT, ["subreddit", "query_tool"], time, keys), schemas.REDDIT_RAW, REDDIT)


def land_producthunt(tables: Tables, pages: DataFrame, ingested_at: datetime | None = None) -> int:
    """New posts with their comments; the post alone decides, as comments are younger than what they belong to."""
    pages = keep_rejected(tables, pages, PRODUCTHUNT, ingested_at)
    posts = store(_once(landing.producthunt_posts(pages), ["id"]), "payload")
    if tables.exists(PRODUCTHUNT.bronze_table):
        is_post = F.col("object_type") == "post"
        mark = read_mark(landing_marks(tables, PRODUCTHUNT, [], parse_iso(F.col("ph_created_at")), is_post), F.col("mark"))
        after = F.lit(False) if mark is None else F.coalesce(parse_iso(F.col("createdAt")) > F.lit(mark), F.lit(False))
        before = posts.filter(~after).withColumn("_key", F.xxhash64("id"))
        hits, landed = _opened(tables, before, PRODUCTHUNT)
        ids = landed.filter(is_post).select(F.col("object_id").alias("id"))
        posts = posts.filter(after).unionByName(_unmet(before, hits)).unionByName(not_yet_landed(_met(before, hits), ids, ["id"]))
    return _append(tables, lambda: store(landing.producthunt_rows(posts, ingested_at), "landing"), schemas.PRODUCTHUNT_RAW, PRODUCTHUNT)


def keep_rejected(tables: Tables, payload: DataFrame, source: Source, ingested_at: datetime | None = None) -> DataFrame:
    """Put the lines that are no payload in their table, each once per file, and log their number. Returns the payload, parsed once."""
    if landing.rejected_lines(payload, source.name) is None:
        return payload
    payload = store(payload, "payload-lines")
    lines = landing.rejected_lines(payload, source.name, ingested_at)
    tables.ensure(REJECTED_LINES, schemas.REJECTED)
    # a line may come twice in a file; that it is broken is known by then
    lines = lines.dropDuplicates(["source", "file", "line"])
    known = tables.read(REJECTED_LINES).filter(F.col("source") == source.name)
    count = tables.append(not_in(lines, known, ["source", "file", "line"], nulls_equal=True), REJECTED_LINES)
    if count:
        AuditLog(tables).log(source.name, BRONZE_REJECTED, count, FAILED, f"{count} lines that are no payload")
    return landing.payloads(payload)


def _once(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A payload may hold a row twice; rows without an id are told apart by content.

    The time of creation belongs to the key. It does not change, so where ids are unique it splits nothing.
    """
    identified = F.col(keys[0]).isNotNull()
    content = [c for c in rows.columns if c != "ingested_at"]
    return keep_first(rows.filter(identified), keys).unionByName(keep_first(rows.filter(~identified), content))


def _new(
    tables: Tables,
    rows: DataFrame,
    source: Source,
    mark_keys: Sequence[str],
    time: Column,
    keys: Sequence[str],
) -> DataFrame:
    """The rows to land, one per key; ``rows`` are stored first, so a payload is parsed once.

    The marks are kept by key columns, and so is the time: keys alone are judged, and texts do not travel, but for copies and rows without an id.
    """
    rows = store(rows, "landing")
    marks = landing_marks(tables, source, mark_keys, time)
    identified = F.col(keys[0]).isNotNull()
    counts, nameless = key_counts(rows.filter(identified), keys), _once(rows.filter(~identified), keys)
    if marks is not None:
        judged = store(unsettled(counts.select(*keys, "copies"), marks, mark_keys, time), "payload-keys")
        nameless = store(unsettled(nameless, marks, mark_keys, time), "payload")
        key = row_key(keys, _RAW[source.name].names)
        # the key of identified rows, as in the filter
        named_before = judged.filter(~F.col("_after")).withColumn("_key", F.xxhash64(*keys))
        before = nameless.filter(~F.col("_after")).withColumn("_key", key).drop("_after")
        hits, landed = _opened(tables, named_before.select("_key").unionAll(before.select("_key")), source)
        counts = unless_in(judged, among(landed.select(*keys), _met(named_before, hits), keys, nulls_equal=True), keys, nulls_equal=True)
        nameless = nameless.filter("_after").drop("_after").unionByName(_unmet(before, hits)).unionByName(unlanded(_met(before, hits), landed, keys))
    return pick(rows.filter(identified), store(counts, "payload-keys"), keys, nulls_equal=True).unionByName(nameless)


def _opened(tables: Tables, keyed: DataFrame, source: Source) -> tuple[DataFrame, DataFrame]:
    """Which of the column ``_key`` may have landed on some day, and what has landed on these days."""
    hits = store(days_of_keys(keyed, key_filters(tables, source)), "filter-hits")
    # at most one per day of the table's life
    days = [r["day"] for r in hits.select("day").distinct().collect()]
    return hits.select(F.col("_key").alias("_hit")).distinct(), tables.read_days(source.bronze_table, days)


def _met(before: DataFrame, hits: DataFrame) -> DataFrame:
    return before.join(hits, F.col("_key") == F.col("_hit"), "left_semi").drop("_key")


def _unmet(before: DataFrame, hits: DataFrame) -> DataFrame:
    """Rows whose key has landed on no day."""
    return before.join(hits, F.col("_key") == F.col("_hit"), "left_anti").drop("_key")


def key_filters(tables: Tables, source: Source) -> DataFrame:
    """``day, word, bits`` of the source; built from the whole bronze table where that is older than its filter."""
    tables.ensure(KEY_FILTERS, schemas.KEY_FILTER_SCHEMA)
    own = tables.read(KEY_FILTERS).filter(F.col("source") == source.name)
    if own.isEmpty():
        note_keys(tables, tables.read(source.bronze_table), source)
        own = tables.read(KEY_FILTERS).filter(F.col("source") == source.name)
    return own.drop("source")


def note_keys(tables: Tables, rows: DataFrame, source: Source) -> None:
    """Write the filter of bronze rows that are about to be appended."""
    if source.name == PRODUCTHUNT.name:
        rows = rows.filter(F.col("object_type") == "post")
        key = F.xxhash64("object_id")
    else:
        key = row_key(ROW_KEYS[source.name], _RAW[source.name].names)
    tables.ensure(KEY_FILTERS, schemas.KEY_FILTER_SCHEMA)
    tables.append(key_filter(rows, key).withColumn("source", F.lit(source.name)), KEY_FILTERS)


def landing_marks(
    tables: Tables,
    source: Source,
    keys: Sequence[str],
    time: Column,
    counts: Column | None = None,
) -> DataFrame | None:
    """Mark per source key of what has landed; None before the first run.

    The bronze table stays the truth. What it held at the last run is summed up in a
    small table, so only rows ingested since then are read again; those at the border
    are read twice, which a maximum does not mind.
    """
    if not tables.exists(source.bronze_table):
        return None
    tables.ensure(LANDING_MARKS, schemas.LANDING_MARK_SCHEMA)
    own = F.col("source") == source.name
    covered = read_mark(tables.read(LANDING_MARKS).filter(own), F.col("covered_until"))
    tail = tables.read_since(source.bronze_table, covered)
    if counts is not None:
        tail = tail.filter(counts)
    fresh = tail.groupBy(*keys).agg(F.max(time).alias("mark"), F.max("ingested_at").alias("covered_until"))
    tables.append(fresh.withColumn("source", F.lit(source.name)), LANDING_MARKS)
    return marks_by_key(tables.read(LANDING_MARKS).filter(own), keys, F.col("mark"))


def _append(tables: Tables, found: Callable[[], DataFrame], schema: T.StructType, source: Source) -> int:
    with AuditLog(tables).step(source.name, BRONZE) as step:
        rows = found()
        tables.ensure(source.bronze_table, schema)
        note_keys(tables, rows, source)
        step.rows = tables.append(rows, source.bronze_table, evolve=True)
    return step.rows
