"""Logical frames over the given tables, each with its SQL twin.

The tables hold invented prose, so a small catalog of strings that do occur stands
in for the default one.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mentionkit import schemas
from mentionkit.catalog import Entity, EntityCatalog

CATALOG = EntityCatalog(
    entities=(
        Entity("T1", ("license", "the ring"), (), date(2023, 6, 1)),
        Entity("T2", ("sch",), ("eau",), date(2024, 1, 1)),
        Entity("v0", (), ("ring",)),
    ),
    context=("ai",),
    exclusions=("@",),
)
POSITIVE, NEGATIVE = ("the", "le", "und"), ("of", "la", "der")
RUN_TIME = datetime(2025, 6, 1)

# dates for the tools of the scored frame, which are event types
EVENT_CATALOG = EntityCatalog(
    entities=(
        Entity("click", ("click",), (), date(2024, 1, 5)),
        Entity("view", ("view",), (), date(2024, 1, 10)),
        Entity("purchase", ("purchase",), (), date(2023, 1, 1)),
    )
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # timestamps are compared as UTC
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _after(start: str, amount: Column, unit: str) -> Column:
    return F.timestamp_add(unit, amount.cast("int"), F.lit(start).cast("timestamp"))


# -- bronze: documents as search hits, conversations as submissions, pages as posts --


def hn_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    created = _after("2023-01-01", F.col("doc_id") % 900, "DAY")
    return d.select(
        F.md5("text").alias("object_id"),
        "source",
        F.concat(F.lit("term"), (F.col("doc_id") % 12).cast("string")).alias("query_tool"),
        F.concat_ws(" ", "lang", "source").alias("title"),
        "text",
        F.concat(F.lit("user"), (F.col("doc_id") % 97).cast("string")).alias("author"),
        F.col("n_chars").alias("points"),
        (F.col("doc_id") % 50).alias("num_comments"),
        F.concat(F.lit("https://example.org/"), F.col("doc_id").cast("string")).alias("url"),
        F.date_format(created, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("hn_created_at"),
        F.lit("story").alias("object_type"),
        _after("2025-01-01", F.col("doc_id"), "SECOND").alias("ingested_at"),
    ).drop("source")


HN_BRONZE = """
SELECT md5(text) AS object_id, 'term' || (doc_id % 12) AS query_tool, lang || ' ' || source AS title, text,
       'user' || (doc_id % 97) AS author, n_chars AS points, doc_id % 50 AS num_comments,
       'https://example.org/' || doc_id AS url,
       strftime(TIMESTAMP '2023-01-01' + to_days((doc_id % 900)::INT), '%Y-%m-%dT%H:%M:%SZ') AS hn_created_at,
       'story' AS object_type, TIMESTAMP '2025-01-01' + to_seconds(doc_id::DOUBLE) AS ingested_at
FROM documents
"""


def reddit_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    minutes = F.col("conv_id") * 1440 + F.col("turn")
    return c.select(
        F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string")).alias("object_id"),
        F.lit("term").alias("query_tool"),
        F.col("role").alias("subreddit"),
        F.concat(F.lit("Thread *"), F.col("conv_id").cast("string"), F.lit("*")).alias("title"),
        F.nullif(F.col("text"), F.lit("")).alias("text"),
        F.col("role").alias("author"),
        F.col("conv_id").alias("score"),
        F.col("turn").alias("num_comments"),
        F.lit(None).cast("string").alias("url"),
        F.concat(F.lit("https://reddit.com/r/"), F.col("role")).alias("permalink"),
        _after("2023-01-01", minutes, "MINUTE").alias("reddit_created_utc"),
        F.lit("submission").alias("object_type"),
        _after("2025-01-01", minutes, "MINUTE").alias("ingested_at"),
    )


REDDIT_BRONZE = """
SELECT 'c' || conv_id || '-' || turn AS object_id, 'term' AS query_tool, role AS subreddit,
       'Thread *' || conv_id || '*' AS title, nullif(text, '') AS text, role AS author, conv_id AS score,
       turn AS num_comments, NULL::VARCHAR AS url, 'https://reddit.com/r/' || role AS permalink,
       TIMESTAMP '2023-01-01' + to_minutes(conv_id * 1440 + turn) AS reddit_created_utc,
       'submission' AS object_type, TIMESTAMP '2025-01-01' + to_minutes(conv_id * 1440 + turn) AS ingested_at
FROM conversations
"""


def producthunt_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages")
    created = _after("2023-01-01", F.col("page_id") % 900, "DAY")
    return p.select(
        F.col("page_id").cast("string").alias("object_id"),
        F.col("url").alias("title"),
        F.col("html").alias("text"),
        F.lit(None).cast("string").alias("author"),
        F.length("html").cast("bigint").alias("votes_count"),
        F.lit(None).cast("bigint").alias("num_comments"),
        "url",
        F.date_format(created, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("ph_created_at"),
        F.lit("post").alias("object_type"),
        _after("2025-01-01", F.col("page_id"), "MINUTE").alias("ingested_at"),
    )


PRODUCTHUNT_BRONZE = """
SELECT page_id::VARCHAR AS object_id, url AS title, html AS text, NULL::VARCHAR AS author,
       length(html) AS votes_count, NULL::BIGINT AS num_comments, url,
       strftime(TIMESTAMP '2023-01-01' + to_days((page_id % 900)::INT), '%Y-%m-%dT%H:%M:%SZ') AS ph_created_at,
       'post' AS object_type, TIMESTAMP '2025-01-01' + to_minutes(page_id) AS ingested_at
FROM pages
"""


# -- payloads: the same tables as nested JSON lines, parsed with the payload schemas --


def _as_payload(df: DataFrame, line: Column, schema) -> DataFrame:
    return df.select(F.from_json(F.to_json(line), schema).alias("p")).select("p.*")


def hn_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document one result page with a story and a comment; every third comment text is empty."""
    b = hn_bronze(spark, sf_dir)
    common = [
        F.col("title"),
        F.col("author"),
        F.col("points"),
        F.col("num_comments"),
        F.col("url"),
        F.col("hn_created_at").alias("created_at"),
    ]
    story = F.struct(
        F.col("object_id").alias("objectID"),
        F.lit(None).cast("string").alias("comment_text"),
        F.col("text").alias("story_text"),
        *common,
    )
    comment = F.struct(
        F.concat(F.col("object_id"), F.lit("-c")).alias("objectID"),
        F.when(F.col("num_comments") % 3 == 0, F.lit("")).otherwise(F.lower("text")).alias("comment_text"),
        F.lit(None).cast("string").alias("story_text"),
        *common,
    )
    return _as_payload(b, F.struct("query_tool", F.array(story, comment).alias("hits")), schemas.HN_PAGE)


HN_LANDED = f"""
SELECT object_id, query_tool, title, coalesce(nullif(text, ''), title) AS text, author, points, num_comments, url,
       hn_created_at, 'story' AS object_type, TIMESTAMP '2025-06-01' AS ingested_at
FROM ({HN_BRONZE})
UNION ALL
SELECT object_id || '-c', query_tool, title,
       CASE WHEN num_comments % 3 = 0 OR text = '' THEN title ELSE lower(text) END, author, points, num_comments, url,
       hn_created_at, CASE WHEN num_comments % 3 = 0 OR text = '' THEN 'story' ELSE 'comment' END,
       TIMESTAMP '2025-06-01'
FROM ({HN_BRONZE})
"""


def reddit_submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = reddit_bronze(spark, sf_dir)
    line = F.struct(
        "query_tool",
        F.col("object_id").alias("id"),
        "subreddit",
        "title",
        F.col("text").alias("selftext"),
        "author",
        "score",
        "num_comments",
        "url",
        F.concat(F.lit("/r/"), F.col("subreddit")).alias("permalink"),
        F.unix_timestamp("reddit_created_utc").cast("double").alias("created_utc"),
    )
    return _as_payload(b, line, schemas.REDDIT_SUBMISSION)


REDDIT_LANDED = f"SELECT * REPLACE (TIMESTAMP '2025-06-01' AS ingested_at) FROM ({REDDIT_BRONZE})"


def producthunt_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per page one post whose paragraphs are its comments; every fourth post has no date, every third comment no user."""
    b = producthunt_bronze(spark, sf_dir)
    number = F.col("object_id").cast("bigint")

    def comment(body: Column, i: Column) -> Column:
        node = F.struct(
            F.concat_ws("-", F.col("object_id"), i.cast("string")).alias("id"),
            body.alias("body"),
            F.col("ph_created_at").alias("createdAt"),
            F.when(i % 3 != 0, F.struct(F.concat(F.lit("user"), i.cast("string")).alias("username"))).alias("user"),
        )
        return F.struct(node.alias("node"))

    post = F.struct(
        F.col("object_id").alias("id"),
        F.col("title").alias("name"),
        F.when(number % 2 == 0, F.col("url")).alias("tagline"),
        F.col("text").alias("description"),
        F.col("votes_count").alias("votesCount"),
        F.col("num_comments").alias("commentsCount"),
        "url",
        F.when(number % 4 != 0, F.col("ph_created_at")).alias("createdAt"),
        F.struct(F.transform(F.split("text", "<p>"), comment).alias("edges")).alias("comments"),
    )
    edges = F.array(F.struct(post.alias("node"))).alias("edges")
    return _as_payload(b, F.struct(F.struct(F.struct(edges).alias("posts")).alias("data")), schemas.PH_PAGE)


PRODUCTHUNT_LANDED = f"""
WITH b AS ({PRODUCTHUNT_BRONZE}),
c AS (SELECT *, unnest(string_split(text, '<p>')) AS body, generate_subscripts(string_split(text, '<p>'), 1) - 1 AS i FROM b)
SELECT object_id, title,
       trim(concat_ws(' ', CASE WHEN object_id::BIGINT % 2 = 0 THEN url END, text), ' ' || chr(10)) AS text,
       NULL::VARCHAR AS author, votes_count, num_comments, url,
       CASE WHEN object_id::BIGINT % 4 != 0 THEN ph_created_at END AS ph_created_at, 'post' AS object_type,
       TIMESTAMP '2025-06-01' AS ingested_at
FROM b
UNION ALL
SELECT object_id || '-' || i, title, body, CASE WHEN i % 3 != 0 THEN 'user' || i END, NULL, NULL, url,
       ph_created_at, 'comment', TIMESTAMP '2025-06-01'
FROM c
"""


# -- scored mentions: events --------------------------------------------------


def scored(spark: SparkSession, sf_dir: str, score: Column | None = None) -> DataFrame:
    e = table(spark, sf_dir, "events")
    if score is None:
        score = F.col("value") / 250 - 1
    return e.select(
        F.col("event_id").cast("string").alias("post_id"),
        F.when(F.col("user_id") % 2 == 0, F.lit("even")).otherwise(F.lit("odd")).alias("source"),
        F.col("event_type").alias("tool"),
        F.col("props").alias("title"),
        F.concat(F.lit("event "), F.col("props")).alias("text"),
        F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("author"),
        F.col("user_id").cast("int").alias("score"),
        F.lit(None).cast("int").alias("num_comments"),
        F.concat(F.lit("https://example.org/e/"), F.col("event_id").cast("string")).alias("url"),
        F.col("ts").cast("timestamp").alias("created_at"),
        score.cast("double").alias("sentiment_score"),
    )


def scored_sql(score: str = "value / 250 - 1") -> str:
    return f"""
SELECT event_id::VARCHAR AS post_id, CASE WHEN user_id % 2 = 0 THEN 'even' ELSE 'odd' END AS source, event_type AS tool,
       props AS title, 'event ' || props AS text, 'user' || user_id AS author, user_id::INT AS score,
       NULL::INT AS num_comments, 'https://example.org/e/' || event_id AS url, ts AS created_at,
       ({score})::DOUBLE AS sentiment_score
FROM events
"""


def faulty_score() -> Column:
    """Scores with gaps and values above the range."""
    return F.when(F.col("value") >= 10, F.col("value") / 200 - 1)


FAULTY_SCORE = "CASE WHEN value >= 10 THEN value / 200 - 1 END"


# -- SQL twins of the library's steps ------------------------------------------


def clean_sql(text: str, markdown: bool = False) -> str:
    """The references that occur in the given tables, decoded in one pass."""
    for name, char in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("amp", "&")):
        text = f"regexp_replace({text}, '&{name};?', '{char}', 'g')"
    text = f"regexp_replace({text}, '<[^>]+>', ' ', 'g')"
    if markdown:
        text = f"regexp_replace({text}, '\\[([^\\]]+)\\]\\([^)]+\\)', '\\1', 'g')"
        text = f"regexp_replace({text}, '[*_~`]', '', 'g')"
    return f"nullif(trim(regexp_replace({text}, '\\s+', ' ', 'g')), '')"


def matches_sql(lowered: str = "l", tool: str = "tool") -> str:
    return f"""(length({lowered}) > 0 AND NOT contains({lowered}, '@') AND CASE {tool}
  WHEN 'T1' THEN contains({lowered}, 'license') OR contains({lowered}, 'the ring')
  WHEN 'T2' THEN contains({lowered}, 'sch') OR (contains({lowered}, 'eau') AND contains({lowered}, 'ai'))
  WHEN 'v0' THEN contains({lowered}, 'ring') AND contains({lowered}, 'ai') END)"""


TOOLS = "(VALUES ('T1', DATE '2023-06-01'), ('T2', DATE '2024-01-01'), ('v0', NULL::DATE)) AS t(tool, launch_date)"


def silver_sql(source: str, bronze: str, columns: dict[str, str], markdown: bool = False, title_stands_in: bool = False) -> str:
    body = "coalesce(x, t0)" if title_stands_in else "x"
    picked = ", ".join(f"{expr} AS {name}" for name, expr in columns.items())
    return f"""
SELECT post_id, source, tool, object_type, title, text, author, score, num_comments, url, created_at, ingested_at,
       TIMESTAMP '2025-06-01' AS cleaned_at
FROM (
  SELECT *, row_number() OVER (PARTITION BY post_id, tool ORDER BY ingested_at DESC, author NULLS FIRST,
    score NULLS FIRST, num_comments NULLS FIRST, url NULLS FIRST) AS copy
  FROM (
    SELECT {picked}, '{source}' AS source, object_type, t0 AS title, {body} AS text, ingested_at,
           lower(concat_ws(' ', t0, x)) AS l
    FROM (SELECT * EXCLUDE (title, text), {clean_sql('title', markdown)} AS t0, {clean_sql('text', markdown)} AS x FROM ({bronze}))
  ), {TOOLS}
  WHERE {matches_sql()} AND (launch_date IS NULL OR created_at >= launch_date)
) WHERE copy = 1
"""


_HN_COLUMNS = {
    "post_id": "object_id", "author": "author", "score": "points::INT", "num_comments": "num_comments::INT",
    "url": "url", "created_at": "strptime(hn_created_at, '%Y-%m-%dT%H:%M:%SZ')",
}
_REDDIT_COLUMNS = {
    "post_id": "object_id", "author": "author", "score": "score::INT", "num_comments": "num_comments::INT",
    "url": "permalink", "created_at": "reddit_created_utc",
}
_PRODUCTHUNT_COLUMNS = {
    "post_id": "object_id", "author": "author", "score": "votes_count::INT", "num_comments": "num_comments::INT",
    "url": "url", "created_at": "strptime(ph_created_at, '%Y-%m-%dT%H:%M:%SZ')",
}
SILVER_HN = silver_sql("hackernews", HN_BRONZE, _HN_COLUMNS)
SILVER_REDDIT = silver_sql("reddit", REDDIT_BRONZE, _REDDIT_COLUMNS, markdown=True, title_stands_in=True)
SILVER_PRODUCTHUNT = silver_sql("producthunt", PRODUCTHUNT_BRONZE, _PRODUCTHUNT_COLUMNS)

# silver rows of all sources when bronze comes from the payloads
SILVER_LANDED = " UNION ALL ".join(
    f"({sql})"
    for sql in (
        silver_sql("hackernews", HN_LANDED, _HN_COLUMNS),
        silver_sql("reddit", REDDIT_LANDED, _REDDIT_COLUMNS, markdown=True, title_stands_in=True),
        silver_sql("producthunt", PRODUCTHUNT_LANDED, _PRODUCTHUNT_COLUMNS),
    )
)


def lexicon_sql(text: str) -> str:
    tokens = f"string_split_regex(lower({text}), '[^a-z]+')"
    p = f"len(list_filter({tokens}, lambda w: w IN {POSITIVE}))"
    n = f"len(list_filter({tokens}, lambda w: w IN {NEGATIVE}))"
    return f"CASE WHEN {p} + {n} = 0 THEN 0.0::DOUBLE ELSE round(({p} - {n})::DOUBLE / ({p} + {n}), 3) END"
