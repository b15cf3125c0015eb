"""Registered queries and their SQL twins, all over whole tables."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mentionkit.catalog import Entity, EntityCatalog, catalog_key_gaps
from mentionkit.functions import scores
from mentionkit.functions.matching import contains_any, explode_matches, with_matches
from mentionkit.functions.text import clean_text
from mentionkit.functions.times import iso_to_epoch
from mentionkit.operators import aggregates as agg
from mentionkit.operators import marks, quality, ranking, refine
from mentionkit.operators.audit import AuditLog
from mentionkit.operators.containment import mentions_by_table
from mentionkit.operators.keys import MENTION_KEY, keep_first
from mentionkit.operators.scoring import as_scored, lexicon_scorer, model_scorer, pending, score_pending
from mentionkit.plans import gold
from mentionkit.plans.land import REJECTED_LINES, land_hackernews
from mentionkit.plans.run import LAND, run_all
from mentionkit.plans.silver import refine_source
from mentionkit.schemas import HN_PAGE, REDDIT_RAW, REDDIT_SUBMISSION
from mentionkit.sources import landing
from mentionkit.sources.shared import new_folder, store
from mentionkit.sources.tables import Tables
from mentionkit.streaming import streams
from workload import frames
from workload.frames import CATALOG, EVENT_CATALOG, NEGATIVE, POSITIVE, RUN_TIME, TOOLS, clean_sql, lexicon_sql, matches_sql, scored, scored_sql, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def _fresh_tables(spark: SparkSession, **layout) -> Tables:
    """Tables of their own for one call, so that calls do not meet."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return Tables(spark, prefix=f"mk_{uuid.uuid4().hex[:12]}_", **layout)


def _kept(tables: Tables, result: DataFrame) -> DataFrame:
    """The result, stored; the tables of the call are dropped."""
    rows = store(result, "result")
    for found in tables.spark.catalog.listTables():
        if found.name.startswith(tables.prefix):
            tables.drop(found.name.removeprefix(tables.prefix))
    return rows


# -- scans and text ------------------------------------------------------------


@query("scan_posts", frames.HN_BRONZE)
def _(spark, sf):
    return frames.hn_bronze(spark, sf)


@query("clean_html", f"SELECT page_id, {clean_sql('html')} AS text FROM pages")
def _(spark, sf):
    return table(spark, sf, "pages").select("page_id", clean_text(F.col("html")).alias("text"))


@query("clean_markdown", f"SELECT doc_id, {clean_sql('text', markdown=True)} AS text FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", clean_text(F.col("text"), markdown=True).alias("text"))


@query("clean_conversations", f"SELECT conv_id, turn, {clean_sql('text')} AS text FROM conversations")
def _(spark, sf):
    return table(spark, sf, "conversations").select("conv_id", "turn", clean_text(F.col("text")).alias("text"))


@query(
    "time_functions",
    """
    SELECT object_id, url, epoch(strptime(hn_created_at, '%Y-%m-%dT%H:%M:%SZ'))::BIGINT AS epoch_seconds,
           strptime(hn_created_at, '%Y-%m-%dT%H:%M:%SZ')::DATE AS post_date,
           date_trunc('week', strptime(hn_created_at, '%Y-%m-%dT%H:%M:%SZ'))::TIMESTAMP AS week_start,
           try_strptime(title, '%Y-%m-%d') AS not_a_time
    FROM (""" + frames.HN_BRONZE + ")",
)
def _(spark, sf):
    from mentionkit.functions.times import parse_iso, post_date, week_start

    created = parse_iso(F.col("hn_created_at"))
    return frames.hn_bronze(spark, sf).select(
        "object_id",
        "url",
        iso_to_epoch(F.col("hn_created_at")).alias("epoch_seconds"),
        post_date(created).alias("post_date"),
        week_start(created).alias("week_start"),
        parse_iso(F.col("title")).alias("not_a_time"),
    )


# -- matching --------------------------------------------------------------------

STRONG = EntityCatalog((Entity("T1", ("license", "the ring")), Entity("T2", ("sch",))))
WEAK = EntityCatalog((Entity("T2", (), ("eau",)), Entity("v0", (), ("ring",))), context=("ai",))
WORDS = EntityCatalog((Entity("T1", ("license", "the")), Entity("T2", ("und", "la"), ("de",))), context=("est", "die"))

_DOCS = "(SELECT doc_id, lower(text) AS l FROM documents)"


def _matched(spark: SparkSession, sf: str, catalog: EntityCatalog, **options) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return with_matches(docs, F.col("text"), catalog, **options)


@query(
    "match_strong",
    f"""
    SELECT doc_id, tool FROM {_DOCS}, (VALUES ('T1'), ('T2')) t(tool)
    WHERE CASE tool WHEN 'T1' THEN contains(l, 'license') OR contains(l, 'the ring') ELSE contains(l, 'sch') END
    """,
)
def _(spark, sf):
    return explode_matches(_matched(spark, sf, STRONG)).select("doc_id", "tool")


@query(
    "match_weak_context",
    f"""
    SELECT doc_id, tool FROM {_DOCS}, (VALUES ('T2'), ('v0')) t(tool)
    WHERE contains(l, 'ai') AND contains(l, CASE tool WHEN 'T2' THEN 'eau' ELSE 'ring' END)
    """,
)
def _(spark, sf):
    return explode_matches(_matched(spark, sf, WEAK)).select("doc_id", "tool")


@query(
    "match_exclusion",
    f"""
    SELECT doc_id, contains(l, '@') AS excluded, count(tool) AS tools FROM {_DOCS}
    LEFT JOIN {TOOLS} ON {matches_sql()} GROUP BY ALL
    """,
)
def _(spark, sf):
    excluded = contains_any(F.lower("text"), CATALOG.exclusions)
    return _matched(spark, sf, CATALOG).select(
        "doc_id", excluded.alias("excluded"), F.size("matched_tools").cast("bigint").alias("tools")
    )


@query(
    "match_multi",
    f"""
    SELECT doc_id, string_agg(tool, ',' ORDER BY tool) AS tools FROM {_DOCS}
    LEFT JOIN {TOOLS} ON {matches_sql()} GROUP BY doc_id
    """,
)
def _(spark, sf):
    joined = F.nullif(F.array_join("matched_tools", ","), F.lit(""))
    # a filter on the result would be pushed below and match a second time
    return _matched(spark, sf, CATALOG).select("doc_id", joined.alias("tools"))


@query(
    "match_word_boundary",
    f"""
    WITH d AS (SELECT doc_id, regexp_replace(l, '[^\\p{{L}}\\p{{N}}]+', '  ', 'g') AS w FROM {_DOCS}),
    p AS (SELECT doc_id, ' ' || w || ' ' AS w FROM d)
    SELECT doc_id, tool FROM p, (VALUES ('T1'), ('T2')) t(tool)
    WHERE CASE tool WHEN 'T1' THEN contains(w, ' license ') OR contains(w, ' the ')
      ELSE contains(w, ' und ') OR contains(w, ' la ')
           OR (contains(w, ' de ') AND (contains(w, ' est ') OR contains(w, ' die '))) END
    """,
)
def _(spark, sf):
    return explode_matches(_matched(spark, sf, WORDS, word_boundary=True)).select("doc_id", "tool")


@query("match_by_alias_table", f"SELECT doc_id, tool FROM {_DOCS}, {TOOLS} WHERE {matches_sql()}")
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.lower("text").alias("lowered"))
    lowered = F.col("lowered")
    return mentions_by_table(
        docs,
        ["doc_id"],
        "lowered",
        CATALOG.aliases_df(spark),
        contains_any(lowered, CATALOG.context),
        contains_any(lowered, CATALOG.exclusions),
    )


# -- refinement ------------------------------------------------------------------


def _mentions(spark: SparkSession, sf: str) -> DataFrame:
    """Unguarded mentions of the documents, copies included."""
    bronze = refine.normalise(frames.hn_bronze(spark, sf), refine.HACKERNEWS)
    return explode_matches(with_matches(bronze, F.col("_match_text"), CATALOG)).drop("_match_text")


_MENTIONS = f"""
SELECT object_id AS post_id, tool, launch_date, strptime(hn_created_at, '%Y-%m-%dT%H:%M:%SZ') AS created_at,
       ingested_at, x AS text, t0 AS title
FROM (SELECT *, lower(concat_ws(' ', t0, x)) AS l
      FROM (SELECT * EXCLUDE (title, text), {clean_sql('title')} AS t0, {clean_sql('text')} AS x FROM ({frames.HN_BRONZE}))),
     {TOOLS} WHERE {matches_sql()}
"""


@query("explode_mentions", f"SELECT post_id, tool, created_at, text FROM ({_MENTIONS})")
def _(spark, sf):
    return _mentions(spark, sf).select("post_id", "tool", "created_at", "text")


@query("dedup_mentions", f"SELECT post_id, tool, max(ingested_at) AS ingested_at FROM ({_MENTIONS}) GROUP BY ALL")
def _(spark, sf):
    return refine.latest_copy(_mentions(spark, sf)).select("post_id", "tool", "ingested_at")


_GUARDED = f"""
SELECT post_id, tool, created_at, ingested_at FROM ({_MENTIONS}) WHERE launch_date IS NULL OR created_at >= launch_date
"""


@query("launch_guard", _GUARDED)
def _(spark, sf):
    return refine.launch_guard(_mentions(spark, sf), CATALOG).select("post_id", "tool", "created_at", "ingested_at")


@query("launch_guard_by_table", _GUARDED)
def _(spark, sf):
    guarded = refine.launch_guard_by_table(_mentions(spark, sf), CATALOG.starts_df(spark))
    return guarded.select("post_id", "tool", "created_at", "ingested_at")


def _silver_hn(spark: SparkSession, sf: str) -> DataFrame:
    return refine.refine(frames.hn_bronze(spark, sf), refine.HACKERNEWS, CATALOG, RUN_TIME)


def _silver_reddit(spark: SparkSession, sf: str) -> DataFrame:
    return refine.refine(frames.reddit_bronze(spark, sf), refine.REDDIT, CATALOG, RUN_TIME)


def _silver_producthunt(spark: SparkSession, sf: str) -> DataFrame:
    return refine.refine(frames.producthunt_bronze(spark, sf), refine.PRODUCTHUNT, CATALOG, RUN_TIME)


query("silver_hackernews", frames.SILVER_HN)(_silver_hn)
query("silver_reddit", frames.SILVER_REDDIT)(_silver_reddit)
query("silver_producthunt", frames.SILVER_PRODUCTHUNT)(_silver_producthunt)

_SILVER_ALL = f"({frames.SILVER_HN}) UNION ALL ({frames.SILVER_REDDIT}) UNION ALL ({frames.SILVER_PRODUCTHUNT})"


@query("union_sources", f"SELECT source, tool, post_id, url, score FROM ({_SILVER_ALL})")
def _(spark, sf):
    silver = refine.union_sources(_silver_hn(spark, sf), _silver_reddit(spark, sf), _silver_producthunt(spark, sf))
    return silver.select("source", "tool", "post_id", "url", "score")


# -- landing and increments --------------------------------------------------------


@query("land_hackernews", frames.HN_LANDED)
def _(spark, sf):
    return landing.hn_rows(frames.hn_pages(spark, sf), RUN_TIME)


@query("land_reddit", frames.REDDIT_LANDED)
def _(spark, sf):
    return landing.reddit_rows(frames.reddit_submissions(spark, sf), RUN_TIME)


@query("land_producthunt", frames.PRODUCTHUNT_LANDED)
def _(spark, sf):
    posts = landing.producthunt_posts(frames.producthunt_pages(spark, sf))
    return landing.producthunt_rows(posts, RUN_TIME)


@query(
    "land_hackernews_increment",
    f"""
    WITH landed AS (SELECT query_tool, max(hn_created_at) AS mark FROM ({frames.HN_BRONZE})
                    WHERE hn_created_at < '2024-06-01' GROUP BY ALL)
    SELECT l.* FROM ({frames.HN_LANDED}) l LEFT JOIN landed USING (query_tool) WHERE mark IS NULL OR hn_created_at > mark
    """,
)
def _(spark, sf):
    """Rows after the mark of their search term, the table holding the time before June 2024."""
    from mentionkit.functions.times import parse_iso

    time = parse_iso(F.col("hn_created_at"))
    landed = frames.hn_bronze(spark, sf).filter(F.col("hn_created_at") < "2024-06-01")
    found = marks.marks_by_key(landed, ["query_tool"], time)
    return landing.hn_new(landing.hn_rows(frames.hn_pages(spark, sf), RUN_TIME), found)


@query(
    "land_reddit_increment",
    f"""
    WITH landed AS (SELECT subreddit, query_tool, max(reddit_created_utc) AS mark FROM ({frames.REDDIT_BRONZE})
                    WHERE reddit_created_utc < TIMESTAMP '2023-03-01' AND subreddit = 'user' GROUP BY ALL)
    SELECT l.* FROM ({frames.REDDIT_LANDED}) l LEFT JOIN landed USING (subreddit, query_tool)
    WHERE mark IS NULL OR reddit_created_utc > mark
    """,
)
def _(spark, sf):
    """One subreddit was landed up to March, the other never: its rows are all new."""
    bronze = frames.reddit_bronze(spark, sf)
    landed = bronze.filter((F.col("reddit_created_utc") < "2023-03-01") & (F.col("subreddit") == "user"))
    found = marks.marks_by_key(landed, ["subreddit", "query_tool"], F.col("reddit_created_utc"))
    return landing.reddit_new(landing.reddit_rows(frames.reddit_submissions(spark, sf), RUN_TIME), found)


@query(
    "land_producthunt_increment",
    f"""
    WITH l AS ({frames.PRODUCTHUNT_LANDED})
    SELECT * FROM l WHERE split_part(object_id, '-', 1) IN (
      SELECT object_id FROM l WHERE object_type = 'post' AND (ph_created_at IS NULL OR ph_created_at > '2023-04-01T00:00:00Z'))
    """,
)
def _(spark, sf):
    """Posts after a mark, or undated, with all their comments."""
    posts = landing.producthunt_new(landing.producthunt_posts(frames.producthunt_pages(spark, sf)), datetime(2023, 4, 1))
    return landing.producthunt_rows(posts, RUN_TIME)


@query("high_water_mark", "SELECT max(ts) AS mark FROM events")
def _(spark, sf):
    return marks.high_water_mark(table(spark, sf, "events"), F.col("ts").cast("timestamp"))


@query("marks_by_key", "SELECT event_type, user_id, max(ts) AS mark FROM events GROUP BY ALL")
def _(spark, sf):
    return marks.marks_by_key(table(spark, sf, "events"), ["event_type", "user_id"], F.col("ts").cast("timestamp"))


@query("incremental_filter", "SELECT event_id, ts, value FROM events WHERE ts > TIMESTAMP '2024-01-15'")
def _(spark, sf):
    events = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "value")
    return marks.newer_than(events, F.col("ts"), datetime(2024, 1, 15))


@query(
    "increment_by_key",
    """
    WITH landed AS (SELECT event_type, user_id, max(ts) AS mark FROM events WHERE value < 20 GROUP BY ALL)
    SELECT event_id, event_type, user_id, ts FROM events LEFT JOIN landed USING (event_type, user_id)
    WHERE mark IS NULL OR ts > mark
    """,
)
def _(spark, sf):
    events = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    keys = ["event_type", "user_id"]
    found = marks.marks_by_key(events.filter("value < 20"), keys, F.col("ts"))
    rows = events.select("event_id", *keys, "ts")
    return marks.newer_than_marks(rows, found, keys, F.col("ts"))


@query(
    "late_arrivals",
    f"""
    SELECT object_id, url FROM ({frames.HN_BRONZE}) WHERE object_id NOT IN
      (SELECT md5(text) FROM documents JOIN labels USING (doc_id))
    """,
)
def _(spark, sf):
    """Rows whose key has not landed, whatever their time; the labelled documents have."""
    labelled = table(spark, sf, "documents").join(table(spark, sf, "labels").select("doc_id"), "doc_id", "left_semi")
    landed = labelled.select(F.md5("text").alias("object_id"))
    return marks.not_yet_landed(frames.hn_bronze(spark, sf), landed, ["object_id"]).select("object_id", "url")


# -- scoring -----------------------------------------------------------------------


@query("scorable_filter", "SELECT doc_id FROM documents WHERE length(text) > 10")
def _(spark, sf):
    return table(spark, sf, "documents").filter(scores.is_scorable(F.col("text"))).select("doc_id")


_SCORED_KEYS = """
SELECT 'hackernews' AS source, md5(text) AS post_id, tool FROM documents JOIN labels USING (doc_id), (VALUES ('T1'), ('T2')) t(tool)
"""


def _scored_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled documents count as scored for two of the three tools."""
    labelled = table(spark, sf, "documents").join(table(spark, sf, "labels").select("doc_id"), "doc_id", "left_semi")
    tools = F.explode(F.array(F.lit("T1"), F.lit("T2"))).alias("tool")
    return labelled.select(F.lit("hackernews").alias("source"), F.md5("text").alias("post_id"), tools)


_PENDING = f"""
SELECT * FROM ({frames.SILVER_HN}) s WHERE length(text) > 10
  AND NOT EXISTS (SELECT 1 FROM ({_SCORED_KEYS}) g WHERE g.source = s.source AND g.post_id = s.post_id AND g.tool = s.tool)
"""


@query("pending_mentions", f"SELECT post_id, tool, text, created_at FROM ({_PENDING})")
def _(spark, sf):
    todo = pending(_silver_hn(spark, sf), _scored_keys(spark, sf))
    return todo.select("post_id", "tool", "text", "created_at")


@query(
    "batch_limit",
    f"""
    SELECT post_id, tool, sentiment_score, (row_number() OVER (ORDER BY post_id, tool) - 1) // 500 AS batch
    FROM ({scored_sql()})
    """,
)
def _(spark, sf):
    """All rows, in exact batches."""
    rows = scored(spark, sf).select("post_id", "tool", "sentiment_score")
    return ranking.in_batches(rows)


def _prompt_sql(text: str) -> str:
    template = scores.PROMPT_TEMPLATE.replace("'", "''").replace("{tool}", "' || tool || '")
    return "'" + template.replace("{text}", f"' || replace({text}, '</text>', '< /text>') || '") + "'"


@query("prompt_text", f"SELECT post_id, tool, {_prompt_sql('text')} AS prompt FROM ({frames.SILVER_HN})")
def _(spark, sf):
    prompt = scores.build_prompt(F.col("text"), F.col("tool"))
    return _silver_hn(spark, sf).select("post_id", "tool", prompt.alias("prompt"))


@query("prompt_whole_text", f"SELECT post_id, tool, {_prompt_sql('text')} AS prompt FROM ({frames.SILVER_PRODUCTHUNT})")
def _(spark, sf):
    prompt = scores.build_prompt(F.col("text"), F.col("tool"))
    return _silver_producthunt(spark, sf).select("post_id", "tool", prompt.alias("prompt"))


_REPLY = """CASE event_type WHEN 'click' THEN value::DECIMAL(10, 2)::VARCHAR WHEN 'view' THEN 'Score: ' || props
 WHEN 'purchase' THEN '  -' || value::DECIMAL(10, 2)::VARCHAR || '  ' WHEN 'signup' THEN 'NaN'
 WHEN 'error' THEN CASE WHEN user_id % 2 = 0 THEN '' ELSE '-Infinity' END END"""


@query(
    "parse_score",
    f"""
    SELECT event_id, CASE WHEN isfinite(try_cast(reply AS DOUBLE)) THEN try_cast(reply AS DOUBLE) END AS score
    FROM (SELECT event_id, {_REPLY} AS reply FROM events)
    """,
)
def _(spark, sf):
    """Replies as a model may give them: plain, padded, prose, empty, not a number."""
    number = F.col("value").cast("decimal(10,2)").cast("string")
    reply = (
        F.when(F.col("event_type") == "click", number)
        .when(F.col("event_type") == "view", F.concat(F.lit("Score: "), "props"))
        .when(F.col("event_type") == "purchase", F.concat(F.lit("  -"), number, F.lit("  ")))
        .when(F.col("event_type") == "signup", F.lit("NaN"))
        .when(F.col("event_type") == "error", F.when(F.col("user_id") % 2 == 0, F.lit("")).otherwise(F.lit("-Infinity")))
    )
    return table(spark, sf, "events").select("event_id", scores.parse_score(reply).alias("score"))


@query("lexicon_score", f"SELECT doc_id, {lexicon_sql('text')} AS score FROM documents")
def _(spark, sf):
    score = scores.lexicon_score(F.col("text"), POSITIVE, NEGATIVE)
    return table(spark, sf, "documents").select("doc_id", score.alias("score"))


_SCORED_DOCS = f"""
SELECT post_id, source, tool, title, text, author, score, num_comments, url, created_at,
       {lexicon_sql('text')} AS sentiment_score
FROM ({frames.SILVER_HN}) WHERE length(text) > 10
"""


def _scored_docs(spark: SparkSession, sf: str) -> DataFrame:
    return as_scored(lexicon_scorer(POSITIVE, NEGATIVE)(pending(_silver_hn(spark, sf), None)))


query("scored_mentions", _SCORED_DOCS)(_scored_docs)


@query(
    "model_scored_mentions",
    f"""
    SELECT post_id, tool, round(length({_prompt_sql('text')}) / 2000.0::DOUBLE, 4) AS sentiment_score
    FROM ({frames.SILVER_HN}) WHERE length(text) > 10
    """,
)
def _(spark, sf):
    """A stand-in model, called in Arrow batches, that rates a prompt by its length."""

    def reply_to(prompts: list[str]) -> list[str]:
        return [f" {len(p) / 2000:.6f}" for p in prompts]

    rated = model_scorer(reply_to)(pending(_silver_hn(spark, sf), None))
    return rated.select("post_id", "tool", F.round("sentiment_score", 4).alias("sentiment_score"))


@query("resumable_scoring", _SCORED_DOCS)
def _(spark, sf):
    """Stop after two batches, resume, run once more with nothing left."""
    tables = _fresh_tables(spark)
    tables.append(_silver_hn(spark, sf), refine.HACKERNEWS.silver_table)
    silver = tables.read(refine.HACKERNEWS.silver_table)
    scorer = lexicon_scorer(POSITIVE, NEGATIVE)
    first = score_pending(silver, tables, gold.SCORED_TABLE, scorer, batch_rows=100, max_batches=2)
    left = max(1, first.remaining // 2)
    score_pending(silver, tables, gold.SCORED_TABLE, scorer, batch_rows=left)
    score_pending(silver, tables, gold.SCORED_TABLE, scorer)
    return _kept(tables, tables.read(gold.SCORED_TABLE))


# -- aggregates ----------------------------------------------------------------------

_S = f"({scored_sql()})"
_DAILY = f"""
SELECT tool, created_at::DATE AS post_date, count(*) AS post_count, round(avg(sentiment_score::DECIMAL(38, 15)), 3) AS avg_sentiment,
       round(count(*) FILTER (sentiment_score > 0.2) / count(*) * 100, 1) AS positive_pct,
       round(count(*) FILTER (sentiment_score < -0.2) / count(*) * 100, 1) AS negative_pct,
       round(count(*) FILTER (sentiment_score BETWEEN -0.2 AND 0.2) / count(*) * 100, 1) AS neutral_pct
FROM {{}} WHERE sentiment_score IS NOT NULL GROUP BY ALL
"""
_BY_SOURCE = """
SELECT tool, source, count(*) AS post_count, round(avg(sentiment_score::DECIMAL(38, 15)), 3) AS avg_sentiment,
       round(min(sentiment_score), 3) AS min_sentiment, round(max(sentiment_score), 3) AS max_sentiment
FROM {} WHERE sentiment_score IS NOT NULL GROUP BY ALL
"""
_LEADERBOARD = """
SELECT tool, count(*) AS total_mentions, round(avg(sentiment_score::DECIMAL(38, 15)), 3) AS avg_sentiment,
       round(count(*) FILTER (sentiment_score > 0.2) / count(*) * 100, 1) AS positive_pct,
       rank() OVER (ORDER BY avg(sentiment_score::DECIMAL(38, 15)) DESC) AS sentiment_rank
FROM {} WHERE sentiment_score IS NOT NULL GROUP BY tool
"""
_WEEKLY = """
SELECT *, round(avg_sentiment - lag(avg_sentiment) OVER (PARTITION BY tool ORDER BY week_start), 3)
          AS sentiment_change_from_prior_week
FROM (SELECT tool, date_trunc('week', created_at)::TIMESTAMP AS week_start, count(*) AS post_count,
             round(avg(sentiment_score::DECIMAL(38, 15)), 3) AS avg_sentiment
      FROM {} WHERE sentiment_score IS NOT NULL GROUP BY ALL)
"""
_TOP = """
SELECT tool, source, title, url, sentiment_score, created_at, 'most_positive' AS category
FROM (SELECT *, row_number() OVER (PARTITION BY tool ORDER BY sentiment_score DESC, post_id, source) AS r
      FROM {0} WHERE sentiment_score IS NOT NULL) WHERE r <= 5
UNION ALL
SELECT tool, source, title, url, sentiment_score, created_at, 'most_negative'
FROM (SELECT *, row_number() OVER (PARTITION BY tool ORDER BY sentiment_score, post_id, source) AS r
      FROM {0} WHERE sentiment_score IS NOT NULL) WHERE r <= 5
"""


@query("sentiment_daily", _DAILY.format(_S))
def _(spark, sf):
    return agg.sentiment_daily(scored(spark, sf))


@query("sentiment_by_source", _BY_SOURCE.format(_S))
def _(spark, sf):
    return agg.sentiment_by_source(scored(spark, sf))


@query("leaderboard", _LEADERBOARD.format(_S))
def _(spark, sf):
    return agg.leaderboard(scored(spark, sf))


@query("weekly_trend", _WEEKLY.format(_S))
def _(spark, sf):
    return agg.weekly_trend(scored(spark, sf))


@query("top_bottom_posts", _TOP.format(_S))
def _(spark, sf):
    return ranking.top_bottom_posts(scored(spark, sf))


_FAULTY = f"({scored_sql(frames.FAULTY_SCORE)})"


def _faulty(spark: SparkSession, sf: str) -> DataFrame:
    return scored(spark, sf, frames.faulty_score())


@query("scoring_summary", f"SELECT tool, count(*) AS rows_scored, round(avg(sentiment_score::DECIMAL(38, 15)), 2) AS avg_sentiment FROM {_FAULTY} GROUP BY ALL")
def _(spark, sf):
    return agg.scoring_summary(_faulty(spark, sf))


@query(
    "daily_rollup",
    f"""
    SELECT tool, source, created_at::DATE AS post_date, count(*) AS n, round(sum(sentiment_score), 6) AS total,
           min(sentiment_score) AS low, max(sentiment_score) AS high,
           count(*) FILTER (sentiment_score > 0.2) AS positive, count(*) FILTER (sentiment_score < -0.2) AS negative,
           count(*) FILTER (sentiment_score BETWEEN -0.2 AND 0.2) AS neutral
    FROM {_FAULTY} WHERE sentiment_score IS NOT NULL GROUP BY ALL
    """,
)
def _(spark, sf):
    return agg.daily_rollup(_faulty(spark, sf)).withColumn("total", F.round("total", 6).cast("double"))


@query("daily_from_rollup", _DAILY.format(_FAULTY))
def _(spark, sf):
    return agg.daily_from_rollup(agg.daily_rollup(_faulty(spark, sf)))


@query("by_source_from_rollup", _BY_SOURCE.format(_FAULTY))
def _(spark, sf):
    return agg.by_source_from_rollup(agg.daily_rollup(_faulty(spark, sf)))


@query("leaderboard_from_rollup", _LEADERBOARD.format(_FAULTY))
def _(spark, sf):
    return agg.leaderboard_from_rollup(agg.daily_rollup(_faulty(spark, sf)))


@query("weekly_from_rollup", _WEEKLY.format(_FAULTY))
def _(spark, sf):
    return agg.weekly_from_rollup(agg.daily_rollup(_faulty(spark, sf)))


@query(
    "report_tables",
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM ({sql.format(_FAULTY)})"
        for name, sql in {
            "sentiment_by_tool_daily": _DAILY,
            "sentiment_by_tool_source": _BY_SOURCE,
            "tool_leaderboard": _LEADERBOARD,
            "sentiment_trend_weekly": _WEEKLY,
            "top_posts_by_tool": _TOP,
        }.items()
    ),
)
def _(spark, sf):
    """Rebuild the five report tables and count them."""
    tables = _fresh_tables(spark)
    tables.append(_faulty(spark, sf), gold.SCORED_TABLE)
    return _kept(tables, gold.rebuild_reports(tables))


_COUNTED = ("documents", "conversations", "pages", "events", "labels", "orders", "lineitem")


@query(
    "table_counts",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in _COUNTED),
)
def _(spark, sf):
    return agg.table_counts({t: table(spark, sf, t) for t in _COUNTED})


# the flagship: clean, match, expand, guard, deduplicate, score, rank
_FLAGSHIP = _LEADERBOARD.format(f"({_SCORED_DOCS})")


@query("mention_leaderboard", _FLAGSHIP)
def mention_leaderboard(spark, sf):
    return agg.leaderboard(_scored_docs(spark, sf))


# -- data quality -----------------------------------------------------------------------


@query("dq_range", f"SELECT post_id, sentiment_score FROM {_FAULTY} WHERE sentiment_score < -1 OR sentiment_score > 1")
def _(spark, sf):
    return quality.out_of_range(_faulty(spark, sf)).select("post_id", "sentiment_score")


@query(
    "dq_null_rate",
    f"""
    SELECT count(*) FILTER (sentiment_score IS NULL) AS null_scores, count(*) AS total_rows,
           round(count(*) FILTER (sentiment_score IS NULL) * 100 / count(*), 2) AS null_pct FROM {_FAULTY}
    """,
)
def _(spark, sf):
    return quality.null_rate(_faulty(spark, sf))


_EVENT_STARTS = "(VALUES ('click', DATE '2024-01-05'), ('view', DATE '2024-01-10'), ('purchase', DATE '2023-01-01')) l(tool, launch_date)"


@query(
    "dq_launch",
    f"SELECT post_id, tool, created_at FROM {_S} JOIN {_EVENT_STARTS} USING (tool) WHERE created_at < launch_date",
)
def _(spark, sf):
    early = quality.before_launch(scored(spark, sf), EVENT_CATALOG.starts_df(spark))
    return early.select("post_id", "tool", "created_at")


_REPEATED = f"(SELECT * REPLACE (author AS post_id) FROM {_FAULTY})"


def _repeated(spark: SparkSession, sf: str) -> DataFrame:
    """Scored rows under a key that repeats."""
    return _faulty(spark, sf).withColumn("post_id", F.col("author"))


@query("dq_duplicates", f"SELECT post_id, tool, count(*) AS n FROM {_REPEATED} GROUP BY ALL HAVING count(*) > 1")
def _(spark, sf):
    return quality.duplicate_keys(_repeated(spark, sf))


@query(
    "dq_violation_sample",
    f"SELECT post_id, tool, n FROM (SELECT post_id, tool, count(*) AS n FROM {_REPEATED} GROUP BY ALL HAVING count(*) > 1)",
)
def _(spark, sf):
    """Every violating row, in the order a report shows them."""
    return ranking.violations_in_order(quality.duplicate_keys(_repeated(spark, sf)))


_METRICS = f"""
SELECT count(*) AS total_rows, count(*) FILTER (sentiment_score < -1 OR sentiment_score > 1) AS out_of_range,
       count(*) FILTER (sentiment_score IS NULL) AS null_scores,
       count(*) FILTER (created_at < launch_date) AS before_launch,
       round(count(*) FILTER (sentiment_score IS NULL) * 100 / count(*), 2) AS null_pct
FROM {_FAULTY} LEFT JOIN {_EVENT_STARTS} USING (tool)
"""


@query("dq_metrics", _METRICS)
def _(spark, sf):
    return quality.quality_metrics(_faulty(spark, sf), EVENT_CATALOG)


_REPORT = f"""
WITH m AS ({_METRICS}), d AS (SELECT count(*) AS k, coalesce(sum(n), 0)::BIGINT AS total FROM
  (SELECT count(*) AS n FROM {_REPEATED} GROUP BY post_id, tool HAVING count(*) > 1))
SELECT 'score_range' AS check, out_of_range AS violations, total_rows AS total, out_of_range = 0 AS passed,
       CASE WHEN out_of_range > 0 THEN out_of_range || ' rows with a score outside [-1, 1]' END AS detail FROM m
UNION ALL SELECT 'null_rate', null_scores, total_rows, null_pct <= 5,
       CASE WHEN null_pct > 5 THEN null_scores || ' rows without a score (' || null_pct || ' %), above 5 %' END FROM m
UNION ALL SELECT 'columns', 0, total_rows, true, NULL FROM m
UNION ALL SELECT 'launch_dates', before_launch, total_rows, before_launch = 0,
       CASE WHEN before_launch > 0 THEN before_launch || ' rows dated before the launch of their tool' END FROM m
UNION ALL SELECT 'not_empty', (total_rows = 0)::BIGINT, total_rows, total_rows > 0,
       CASE WHEN total_rows = 0 THEN '1 empty table' END FROM m
UNION ALL SELECT 'unique_keys', k, total, k = 0,
       CASE WHEN k > 0 THEN k || ' repeated (post_id, tool) pairs' END FROM d
"""


@query("dq_report", _REPORT)
def _(spark, sf):
    return quality.quality_report(_repeated(spark, sf), EVENT_CATALOG)


@query(
    "dq_issues",
    f"""
    SELECT count(*) FILTER (NOT passed) AS failed_checks,
           string_agg(detail, '; ' ORDER BY "check") FILTER (NOT passed) AS issues FROM ({_REPORT})
    """,
)
def _(spark, sf):
    return quality.issue_summary(quality.quality_report(_repeated(spark, sf), EVENT_CATALOG))


@query(
    "catalog_consistency",
    """
    WITH a AS (SELECT DISTINCT source AS tool FROM documents),
    s AS (SELECT DISTINCT 'src' || (user_id % 23) AS tool FROM events)
    SELECT tool, 'no start date' AS issue FROM a WHERE tool NOT IN (SELECT tool FROM s)
    UNION ALL SELECT tool, 'no alias' FROM s WHERE tool NOT IN (SELECT tool FROM a)
    """,
)
def _(spark, sf):
    """Document sources against names taken from events."""
    aliases = table(spark, sf, "documents").select(F.col("source").alias("tool"))
    starts = table(spark, sf, "events").select(F.concat(F.lit("src"), (F.col("user_id") % 23).cast("string")).alias("tool"))
    return catalog_key_gaps(aliases, starts)


@query(
    "audit_rows",
    """
    SELECT 'hackernews' AS source, 'bronze' AS layer, count(*) AS rows_processed, 'success' AS status,
           NULL::VARCHAR AS error_message FROM documents
    UNION ALL SELECT 'reddit', 'bronze', count(*), 'success', NULL FROM conversations
    UNION ALL SELECT 'all', 'gold', 0, 'failed', 'missing required columns: [''sentiment_score'']'
    UNION ALL SELECT 'producthunt', 'silver', 0, 'success', NULL
    """,
)
def _(spark, sf):
    """Log rows of a write, a failed step and a step without input."""
    from mentionkit.schemas import SCORED, validate_frame

    tables = _fresh_tables(spark)
    log = AuditLog(tables)
    for source, frame in (("hackernews", frames.hn_bronze), ("reddit", frames.reddit_bronze)):
        with log.step(source, "bronze") as step:
            step.rows = tables.append(frame(spark, sf), f"{source}_raw")
    try:
        with log.step("all", "gold"):
            validate_frame(scored(spark, sf).drop("sentiment_score"), SCORED)
    except ValueError:
        pass
    with log.step("producthunt", "silver"):
        pass
    return _kept(tables, log.read().drop("run_timestamp"))


# -- streams and the whole run ------------------------------------------------------------


STREAM_FILES = 4


def _stream(spark: SparkSession, sf: str, name: str, files: int, by: str | None) -> DataFrame:
    """A table as a stream of ``files`` micro-batches; rows that are equal in ``by`` come together. A micro-batch is as many files as the table has splits for it."""
    if files == 1:
        schema = table(spark, sf, name).schema
        # the glob names one file; file streams list folders
        return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf)
    given = table(spark, sf, name)
    folder = new_folder(spark, "stream-input")
    each = max(1, math.ceil(given.rdd.getNumPartitions() / files))
    dealt = given.repartition(files * each, *([by] if by else []))
    dealt.write.parquet(folder)
    return spark.readStream.schema(given.schema).option("maxFilesPerTrigger", each).parquet(folder)


class _Streaming:
    """Stands in for the reader of the given tables, so that the frames above become streams."""

    def __init__(self, spark: SparkSession, sf: str, files: int = STREAM_FILES, by: str | None = None) -> None:
        self.spark, self.sf, self.conf, self.files, self.by = spark, sf, spark.conf, files, by
        self.read = self

    def parquet(self, path: str) -> DataFrame:
        return _stream(self.spark, self.sf, path.rpartition("/")[2].removesuffix(".parquet"), self.files, self.by)


def _finished(spark: SparkSession, stream: DataFrame) -> DataFrame:
    path = new_folder(spark, "stream")
    streams.write_files(stream, path, new_folder(spark, "stream-checkpoint")).awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


@query("stream_refine", f"SELECT * EXCLUDE (cleaned_at) FROM ({frames.SILVER_HN})")
def _(spark, sf):
    """Micro-batches into the silver table. Copies of a post come together: of those, as in the batch form, the last is kept."""
    tables = _fresh_tables(spark)
    bronze = frames.hn_bronze(_Streaming(spark, sf, by="text"), sf)
    streams.refine_stream(bronze, refine.HACKERNEWS, CATALOG, tables, new_folder(spark, "checkpoint")).awaitTermination()
    return _kept(tables, tables.read(refine.HACKERNEWS.silver_table).drop("cleaned_at"))


@query("stream_mentions", _GUARDED)
def _(spark, sf):
    bronze = frames.hn_bronze(_Streaming(spark, sf), sf)
    mentions = streams.mention_stream(bronze, refine.HACKERNEWS, CATALOG)
    return _finished(spark, mentions.select("post_id", "tool", "created_at", "ingested_at"))


@query("stream_first_within_watermark", f"SELECT DISTINCT post_id, tool FROM ({_GUARDED})")
def _(spark, sf):
    bronze = frames.hn_bronze(_Streaming(spark, sf), sf)
    mentions = streams.mention_stream(bronze, refine.HACKERNEWS, CATALOG)
    return _finished(spark, streams.first_within_watermark(mentions, "30 days").select("post_id", "tool"))


@query(
    "stream_daily_closed",
    f"""
    SELECT tool, created_at::DATE AS post_date, count(*) AS post_count, round(avg(sentiment_score::DECIMAL(38, 15)), 3) AS avg_sentiment,
           round(count(*) FILTER (sentiment_score > 0.2) / count(*) * 100, 1) AS positive_pct
    FROM {_S} WHERE created_at::DATE + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 6 HOUR FROM events) GROUP BY ALL
    """,
)
def _(spark, sf):
    """Days the watermark has passed, each once; ``stream_daily`` has all of them."""
    return _finished(spark, streams.daily_stream(scored(_Streaming(spark, sf, files=1), sf), "6 hours"))


@query("stream_daily", _DAILY.format(_S))
def _(spark, sf):
    """Every day of every micro-batch, folded."""
    tables = _fresh_tables(spark)
    rows = scored(_Streaming(spark, sf), sf)
    streams.rollup_stream(rows, tables, "daily_rollup", new_folder(spark, "checkpoint")).awaitTermination()
    return _kept(tables, agg.daily_from_rollup(tables.read("daily_rollup")))


@query("stream_land", frames.REDDIT_LANDED)
def _(spark, sf):
    from mentionkit.schemas import REDDIT_RAW

    tables = _fresh_tables(spark)
    payload = frames.reddit_submissions(_Streaming(spark, sf), sf)
    streams.land_stream(
        payload,
        lambda batch: landing.reddit_rows(batch, RUN_TIME),
        tables,
        refine.REDDIT.bronze_table,
        REDDIT_RAW,
        ["object_id", "query_tool", "subreddit"],
        new_folder(spark, "checkpoint"),
    ).awaitTermination()
    return _kept(tables, tables.read(refine.REDDIT.bronze_table))


_SCORED_LANDED = f"SELECT *, {lexicon_sql('text')} AS sentiment_score FROM ({frames.SILVER_LANDED}) WHERE length(text) > 10"


@query("full_run", _LEADERBOARD.format(f"({_SCORED_LANDED})"))
def _(spark, sf):
    """All layers on all three sources, twice: the second run finds nothing new."""
    tables = _fresh_tables(spark)
    payloads = {
        "hackernews": frames.hn_pages(spark, sf),
        "reddit": frames.reddit_submissions(spark, sf),
        "producthunt": frames.producthunt_pages(spark, sf),
    }
    scorer = lexicon_scorer(POSITIVE, NEGATIVE)
    for _ in range(2):
        run_all(tables, payloads, CATALOG, scorer, RUN_TIME, scored_sources=refine.SOURCES)
    return _kept(tables, tables.read("tool_leaderboard"))


@query("run_producthunt_only", _LEADERBOARD.format(f"({_SCORED_LANDED} AND source = 'producthunt')"))
def _(spark, sf):
    """One source alone, then a run without any payload: what is there stays."""
    tables = _fresh_tables(spark)
    scorer = lexicon_scorer(POSITIVE, NEGATIVE)
    for payloads in ({"producthunt": frames.producthunt_pages(spark, sf)}, {}):
        run_all(tables, payloads, CATALOG, scorer, RUN_TIME, scored_sources=refine.SOURCES)
    return _kept(tables, tables.read("tool_leaderboard"))


# -- what the plans must not lose ----------------------------------------------------------


def _pages_where(pages: DataFrame, keep) -> DataFrame:
    return pages.withColumn("hits", F.filter("hits", keep))


@query("land_late_rows", f"SELECT DISTINCT object_id, query_tool, hn_created_at FROM ({frames.HN_LANDED})")
def _(spark, sf):
    """The younger half lands first; the older half comes late, with all of the first once more."""
    tables = _fresh_tables(spark)
    pages = frames.hn_pages(spark, sf)
    land_hackernews(tables, _pages_where(pages, lambda h: h["created_at"] >= "2024-03-01"), RUN_TIME)
    land_hackernews(tables, pages, RUN_TIME)
    return _kept(tables, tables.read(refine.HACKERNEWS.bronze_table).select("object_id", "query_tool", "hn_created_at"))


@query(
    "land_undated",
    f"""
    SELECT DISTINCT object_id, query_tool, CASE WHEN num_comments % 5 <> 0 THEN hn_created_at END AS hn_created_at
    FROM ({frames.HN_LANDED})
    """,
)
def _(spark, sf):
    """Dated hits land, then those without a date, then all again."""
    tables = _fresh_tables(spark)
    undated = lambda h: h["num_comments"] % 5 == 0
    dates = lambda h: h.withField("created_at", F.when(~undated(h), h["created_at"]))
    pages = frames.hn_pages(spark, sf).withColumn("hits", F.transform("hits", dates))
    for part in (_pages_where(pages, lambda h: ~undated(h)), _pages_where(pages, undated), pages):
        land_hackernews(tables, part, RUN_TIME)
    return _kept(tables, tables.read(refine.HACKERNEWS.bronze_table).select("object_id", "query_tool", "hn_created_at"))


@query("refine_same_time", f"SELECT post_id, tool FROM ({frames.SILVER_LANDED}) WHERE source = 'hackernews'")
def _(spark, sf):
    """Two deliveries under one run time, each refined."""
    tables = _fresh_tables(spark)
    pages = frames.hn_pages(spark, sf)
    for part in (_pages_where(pages, lambda h: h["created_at"] < "2024-03-01"), pages):
        land_hackernews(tables, part, RUN_TIME)
        refine_source(tables, refine.HACKERNEWS, CATALOG, RUN_TIME)
    return _kept(tables, tables.read(refine.HACKERNEWS.silver_table).select("post_id", "tool"))


@query(
    "equal_ids_of_two_sources",
    f"SELECT source, post_id, tool FROM ({frames.SILVER_HN}), (VALUES ('hackernews'), ('reddit')) t(source) WHERE length(text) > 10".replace(
        "SELECT source, post_id", "SELECT t.source, post_id", 1
    ),
)
def _(spark, sf):
    """The mentions of one source under the name of another as well: both are scored."""
    tables = _fresh_tables(spark)
    silver = _silver_hn(spark, sf)
    tables.append(silver, refine.HACKERNEWS.silver_table)
    tables.append(silver.withColumn("source", F.lit("reddit")), refine.REDDIT.silver_table)
    for _ in range(2):
        gold.score_sources(tables, lexicon_scorer(POSITIVE, NEGATIVE))
    return _kept(tables, tables.read(gold.SCORED_TABLE).select("source", "post_id", "tool"))


_MISSING_ID = "doc_id % 7 = 0"


@query(
    "rows_without_id",
    f"""
    SELECT 'hackernews' AS source, 'silver_rejected' AS layer, count(*) AS rows_processed, 'failed' AS status,
           count(*) || ' rows without an id' AS error_message FROM documents WHERE {_MISSING_ID}
    UNION ALL SELECT 'hackernews', 'silver', count(*), 'success', NULL
    FROM ({frames.silver_sql("hackernews", f"SELECT * FROM ({frames.HN_BRONZE}) WHERE split_part(url, '/', 4)::BIGINT % 7 <> 0", frames._HN_COLUMNS)})
    """,
)
def _(spark, sf):
    """The run log of a refinement in which every seventh row has no id."""
    tables = _fresh_tables(spark)
    number = F.element_at(F.split("url", "/"), -1).cast("bigint")
    bronze = frames.hn_bronze(spark, sf).withColumn("object_id", F.when(number % 7 != 0, F.col("object_id")))
    tables.append(bronze, refine.HACKERNEWS.bronze_table)
    refine_source(tables, refine.HACKERNEWS, CATALOG, RUN_TIME)
    return _kept(tables, AuditLog(tables).read().drop("run_timestamp"))


@query(
    "append_new_column",
    "SELECT doc_id, text, NULL::VARCHAR AS lang FROM documents UNION ALL SELECT doc_id, NULL, lang FROM documents",
)
def _(spark, sf):
    """The second append brings a column that the table lacks, and lacks one that it has."""
    tables = _fresh_tables(spark)
    docs = table(spark, sf, "documents")
    tables.append(docs.select("doc_id", "text"), "docs")
    tables.append(docs.select("lang", "doc_id"), "docs", evolve=True)
    return _kept(tables, tables.read("docs"))


_SINCE_HOURS = 2


@query(
    "read_since_mark",
    f"""
    SELECT object_id, ingested_at FROM ({frames.PRODUCTHUNT_BRONZE})
    WHERE ingested_at >= (SELECT max(ingested_at) - INTERVAL {_SINCE_HOURS} HOUR FROM ({frames.PRODUCTHUNT_BRONZE}))
    """,
)
def _(spark, sf):
    """A table laid out by day, read from a mark on that lies before its last rows: earlier days' folders are not opened."""
    tables = _fresh_tables(spark, by_day=["posts"])
    tables.append(frames.producthunt_bronze(spark, sf), "posts")
    since = marks.read_mark(tables.read("posts"), F.col("ingested_at")) - timedelta(hours=_SINCE_HOURS)
    return _kept(tables, tables.read_since("posts", since).select("object_id", "ingested_at"))


_REJECT_EVERY = 9
_BROKEN = "'{\"query_tool\": \"term' || doc_id % 12 || '\", \"hits\": [' || doc_id"


@query(
    "land_malformed",
    f"""
    WITH b AS (SELECT * FROM ({frames.HN_LANDED}) WHERE split_part(url, '/', 4)::BIGINT % {_REJECT_EVERY} <> 0),
    r AS (SELECT {_BROKEN} AS line FROM documents WHERE doc_id % {_REJECT_EVERY} = 0)
    SELECT 'bronze' AS place, item FROM (SELECT DISTINCT object_id || query_tool || hn_created_at AS item FROM b)
    UNION ALL SELECT 'rejected', line FROM r
    UNION ALL SELECT 'log', 'hackernews bronze_rejected failed ' || count(*) || ' lines that are no payload' FROM r
    UNION ALL SELECT 'log', 'hackernews bronze success ' || (SELECT count(*) FROM (SELECT DISTINCT object_id, query_tool, hn_created_at FROM b))
    UNION ALL SELECT 'log', 'hackernews bronze success 0'
    """,
)
def _(spark, sf):
    """Result pages as files of JSON lines, of which every ninth is cut off, landed twice: broken lines are kept and logged once."""
    tables = _fresh_tables(spark)
    folder = new_folder(spark, "pages")
    number = F.element_at(F.split(F.element_at("hits", 1)["url"], "/"), -1).cast("bigint")
    pages = frames.hn_pages(spark, sf)
    whole = pages.filter(number % _REJECT_EVERY != 0).select(F.to_json(F.struct(*pages.columns)).alias("value"))
    docs = table(spark, sf, "documents").filter(F.col("doc_id") % _REJECT_EVERY == 0)
    term = F.concat(F.lit('{"query_tool": "term'), (F.col("doc_id") % 12).cast("string"), F.lit('", "hits": ['), F.col("doc_id").cast("string"))
    whole.unionAll(docs.select(term)).write.text(folder)
    for _ in range(2):
        land_hackernews(tables, landing.read_payload(spark, folder, HN_PAGE), RUN_TIME)
    log = AuditLog(tables).read()
    entry = F.concat_ws(" ", "source", "layer", "status", F.coalesce("error_message", F.col("rows_processed").cast("string")))
    parts = [
        tables.read(refine.HACKERNEWS.bronze_table).select(F.lit("bronze").alias("place"), F.concat("object_id", "query_tool", "hn_created_at").alias("item")),
        tables.read(REJECTED_LINES).select(F.lit("rejected").alias("place"), F.col("line").alias("item")),
        log.select(F.lit("log").alias("place"), entry.alias("item")),
    ]
    return _kept(tables, refine.union_sources(*parts))


@query("stream_land_malformed", f"SELECT object_id, query_tool FROM ({frames.REDDIT_LANDED}) UNION ALL SELECT 'no json ' || conv_id || '-' || turn, 'rejected' FROM conversations WHERE turn % 2 = 1")
def _(spark, sf):
    """Submissions as a stream of files, with a broken line for every second turn."""
    tables = _fresh_tables(spark)
    folder = new_folder(spark, "submissions")
    given = frames.reddit_submissions(spark, sf)
    c = table(spark, sf, "conversations").filter(F.col("turn") % 2 == 1)
    broken = c.select(F.concat(F.lit("no json "), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string")).alias("value"))
    given.select(F.to_json(F.struct(*given.columns)).alias("value")).unionAll(broken).coalesce(2).write.text(folder)
    streams.land_stream(
        landing.stream_payload(spark, folder, REDDIT_SUBMISSION), lambda batch: landing.reddit_rows(batch, RUN_TIME), tables,
        refine.REDDIT.bronze_table, REDDIT_RAW, ["object_id", "query_tool", "subreddit"], new_folder(spark, "checkpoint"),
    ).awaitTermination()
    landed = tables.read(refine.REDDIT.bronze_table).select("object_id", "query_tool")
    rejected = tables.read(REJECTED_LINES).select(F.col("line").alias("object_id"), F.lit("rejected").alias("query_tool"))
    return _kept(tables, landed.unionAll(rejected))


def _folded(spark: SparkSession, sf: str) -> Tables:
    """The scored rows in three runs, each folded into the reports, and the last one once more, as after a crash."""
    tables = _fresh_tables(spark, by_day={gold.SCORED_TABLE: "created_at"})
    rows = _faulty(spark, sf)
    number = F.col("post_id").cast("bigint")
    for run in range(3):
        part = rows.filter(number % 3 == run)
        gold.open_days(tables, part)
        tables.append(part, gold.SCORED_TABLE)
        gold.fold_reports(tables)
    gold.open_days(tables, part)
    gold.fold_reports(tables)
    return tables


@query("rollup_folded", _DAILY.format(_FAULTY))
def _(spark, sf):
    tables = _folded(spark, sf)
    return _kept(tables, tables.read("sentiment_by_tool_daily"))


@query("weekly_folded", _WEEKLY.format(_FAULTY))
def _(spark, sf):
    tables = _folded(spark, sf)
    return _kept(tables, tables.read("sentiment_trend_weekly"))


@query("top_folded", _TOP.format(_FAULTY))
def _(spark, sf):
    tables = _folded(spark, sf)
    return _kept(tables, tables.read("top_posts_by_tool"))


@query("quality_folded", _REPORT.replace("GROUP BY post_id, tool", "GROUP BY source, post_id, tool").replace("(post_id, tool) pairs", "(source, post_id, tool) pairs"))
def _(spark, sf):
    """The checks after each of three runs, whose keys repeat within and across runs, and once more for the last run, as after a crash."""
    tables = _fresh_tables(spark, by_day={gold.SCORED_TABLE: "created_at"})
    number = F.col("post_id").cast("bigint")
    rows = _faulty(spark, sf).withColumn("_run", number % 3).withColumn("post_id", F.col("author"))
    for run in range(3):
        part = rows.filter(F.col("_run") == run).drop("_run")
        gold.open_days(tables, part)
        tables.append(part, gold.SCORED_TABLE)
        gold.fold_quality(tables, EVENT_CATALOG)
    gold.open_days(tables, part)
    return _kept(tables, gold.fold_quality(tables, EVENT_CATALOG))


_LINKED = "'*See* [' || url || '](' || url || ') and [' || page_id || '](#a) [] (' || url || ')'"


@query("clean_markdown_links", f"SELECT page_id, {clean_sql('linked', markdown=True)} AS text FROM (SELECT page_id, {_LINKED} AS linked FROM pages)")
def _(spark, sf):
    url, number = F.col("url"), F.col("page_id").cast("string")
    pieces = [F.lit("*See* ["), url, F.lit("]("), url, F.lit(") and ["), number, F.lit("](#a) [] ("), url, F.lit(")")]
    return table(spark, sf, "pages").select("page_id", clean_text(F.concat(*pieces), markdown=True).alias("text"))


@query(
    "report_in_order",
    f"SELECT *, row_number() OVER (ORDER BY avg_sentiment DESC, tool) - 1 AS place FROM ({_LEADERBOARD.format(_S)})",
)
def _(spark, sf):
    """A report as it is read: the place of a row is its place in the output."""
    shown = ranking.in_report_order(agg.leaderboard(scored(spark, sf)), "tool_leaderboard")
    # a report of one row per tool fits one partition, which keeps its order
    return shown.coalesce(1).withColumn("place", F.monotonically_increasing_id())


@query(
    "quality_log",
    f"""
    SELECT 'all' AS source, 'gold_dq_check' AS layer, count(*) AS rows_processed, 'failed' AS status,
           (SELECT string_agg(detail, '; ' ORDER BY "check") FILTER (NOT passed) FROM ({_REPORT})) AS error_message
    FROM {_FAULTY}
    """.replace(_REPEATED, _FAULTY),
)
def _(spark, sf):
    """The log row of the checks on a faulty table, as the plan writes it."""
    tables = _fresh_tables(spark)
    tables.append(_faulty(spark, sf), gold.SCORED_TABLE)
    gold.check_quality(tables, EVENT_CATALOG)
    return _kept(tables, AuditLog(tables).read().drop("run_timestamp"))


_REACHED = "left(md5(post_id), 1) < '8'"


class _HalfInTime:
    """Stands in for a scorer whose time runs out inside a batch: with a limit, half of the rows are not reached."""

    def __init__(self, limited: bool = False) -> None:
        self.limited = limited

    def until(self, deadline: float) -> _HalfInTime:
        return _HalfInTime(True)

    def __call__(self, df: DataFrame) -> DataFrame:
        return lexicon_scorer(POSITIVE, NEGATIVE)(df.filter(F.expr(_REACHED)) if self.limited else df)


@query(
    "time_limited_scoring",
    f"""
    WITH s AS (SELECT *, {_REACHED} AS reached FROM ({frames.SILVER_HN}) WHERE length(text) > 10)
    SELECT 1 AS run, count(*) FILTER (reached) AS scored, count(*) FILTER (NOT reached) AS remaining, false AS complete, count(*) FILTER (reached) AS stored FROM s
    UNION ALL SELECT 2, count(*) FILTER (NOT reached), 0, true, count(*) FROM s
    """,
)
def _(spark, sf):
    """A limit that falls inside a batch: what is not reached stays pending, the run says so, and the next one scores it."""
    tables = _fresh_tables(spark)
    silver = _silver_hn(spark, sf)
    rows = []
    for number, limit in ((1, 1000), (2, None)):
        run = score_pending(silver, tables, gold.SCORED_TABLE, _HalfInTime(), max_minutes=limit)
        rows.append((number, run.scored, run.remaining, run.complete, tables.read(gold.SCORED_TABLE).count()))
    return _kept(tables, spark.createDataFrame(rows, "run int, scored bigint, remaining bigint, complete boolean, stored bigint"))


@query(
    "replies_kept",
    f"""
    WITH s AS (SELECT DISTINCT tool, text FROM ({frames.SILVER_LANDED}) WHERE length(text) > 10)
    SELECT 'prompts asked' AS what, count(*) AS n FROM s
    UNION ALL SELECT 'rows scored', count(*) FROM ({frames.SILVER_LANDED}) WHERE length(text) > 10
    UNION ALL SELECT 'rows scored again', count(*) FROM ({frames.SILVER_LANDED}) WHERE length(text) > 10
    """,
)
def _(spark, sf):
    """A model asked for all sources' mentions, then for all of them under another table: every distinct prompt is asked once."""
    tables = _fresh_tables(spark)
    pages = {"hackernews": frames.hn_pages(spark, sf), "reddit": frames.reddit_submissions(spark, sf), "producthunt": frames.producthunt_pages(spark, sf)}
    for source in refine.SOURCES:
        LAND[source.name](tables, pages[source.name], RUN_TIME)
        refine_source(tables, source, CATALOG, RUN_TIME)
    asked = spark.sparkContext.accumulator(0)

    def reply_to(prompts: list[str]) -> list[str]:
        asked.add(len(prompts))
        return ["0.5"] * len(prompts)

    scorer = model_scorer(reply_to, tables=tables, model="stand-in")
    runs = [gold.score_sources(tables, scorer, refine.SOURCES, scored_table=name) for name in ("first", "second")]
    rows = [("prompts asked", asked.value), ("rows scored", runs[0].scored), ("rows scored again", runs[1].scored)]
    return _kept(tables, spark.createDataFrame(rows, "what string, n bigint"))


@query(
    "append_nested",
    """
    SELECT doc_id, n_chars::BIGINT AS size, lang AS meta_lang, NULL::VARCHAR AS meta_source, lang AS item_a, NULL::BIGINT AS item_b FROM documents
    UNION ALL SELECT doc_id, n_chars + 3000000000, lang, source, NULL, doc_id FROM documents
    """,
)
def _(spark, sf):
    """The second append brings a number beyond INT and new fields inside a struct and inside an array's structs."""
    tables = _fresh_tables(spark)
    docs = table(spark, sf, "documents")
    first = docs.select("doc_id", F.col("n_chars").cast("int").alias("size"), F.struct("lang").alias("meta"), F.array(F.struct(F.col("lang").alias("a"))).alias("items"))
    second = docs.select(
        "doc_id", (F.col("n_chars") + 3_000_000_000).alias("size"), F.struct("source", "lang").alias("meta"),
        F.array(F.struct(F.col("doc_id").alias("b"))).alias("items"),
    )
    tables.append(first, "docs")
    tables.append(second, "docs", evolve=True)
    item = F.element_at("items", 1)
    return _kept(tables, tables.read("docs").select(
        "doc_id", "size", F.col("meta.lang").alias("meta_lang"), F.col("meta.source").alias("meta_source"), item["a"].alias("item_a"), item["b"].alias("item_b")
    ))


@query(
    "report_contents",
    " UNION ALL ".join(
        f"SELECT '{name}' AS report, to_json(r)::VARCHAR AS content FROM (SELECT {columns} FROM ({sql.format(_FAULTY)})) r"
        for name, columns, sql in (
            ("sentiment_by_tool_daily", "tool, post_date::VARCHAR AS day, post_count, round(avg_sentiment * 1000)::BIGINT AS avg_milli", _DAILY),
            ("sentiment_by_tool_source", "tool, source, post_count, round(avg_sentiment * 1000)::BIGINT AS avg_milli, round(max_sentiment * 1000)::BIGINT AS max_milli", _BY_SOURCE),
            ("tool_leaderboard", "tool, total_mentions, sentiment_rank, round(avg_sentiment * 1000)::BIGINT AS avg_milli", _LEADERBOARD),
            ("sentiment_trend_weekly", "tool, week_start::DATE::VARCHAR AS week, post_count, round(avg_sentiment * 1000)::BIGINT AS avg_milli", _WEEKLY),
            ("top_posts_by_tool", "tool, category, url", _TOP),
        )
    ),
)
def _(spark, sf):
    """The five report tables after two rebuilds, by content."""
    tables = _fresh_tables(spark)
    tables.append(_faulty(spark, sf), gold.SCORED_TABLE)
    for _ in range(2):
        gold.rebuild_reports(tables)
    milli = lambda c: F.round(F.col(f"{c}_sentiment") * 1000).cast("bigint").alias(f"{c}_milli")
    picked = {
        "sentiment_by_tool_daily": ["tool", F.col("post_date").cast("string").alias("day"), "post_count", milli("avg")],
        "sentiment_by_tool_source": ["tool", "source", "post_count", milli("avg"), milli("max")],
        "tool_leaderboard": ["tool", "total_mentions", "sentiment_rank", milli("avg")],
        "sentiment_trend_weekly": ["tool", F.to_date("week_start").cast("string").alias("week"), "post_count", milli("avg")],
        "top_posts_by_tool": ["tool", "category", "url"],
    }
    parts = [
        tables.read(name).select(F.lit(name).alias("report"), F.to_json(F.struct(*columns)).alias("content"))
        for name, columns in picked.items()
    ]
    return _kept(tables, refine.union_sources(*parts))
