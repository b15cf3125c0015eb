"""Landed JSON payloads to bronze rows.

The readers take explicit schemas, so a batch in which a field is always null
reads like any other. Flattening runs on the executors, one payload line at a
time.

A line that is no JSON, or does not fit the schema, is no payload: its fields are NULL, so it gives no rows, and it stays in
``REJECTED_LINE`` with the name of its file. The landing plans keep such lines in a table and log their number.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mentionkit import schemas
from mentionkit.functions.text import empty_to_null, first_filled, strip
from mentionkit.functions.times import epoch_to_timestamp, parse_iso
from mentionkit.operators.marks import newer_than, newer_than_marks

# Fixed value: prefix that turns a permalink into a URL.
REDDIT_SITE = "https://reddit.com"


REJECTED_LINE, PAYLOAD_FILE = "_rejected_line", "_payload_file"


def read_payload(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return _parsed(spark.read.text(path), schema)


def stream_payload(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return _parsed(spark.readStream.text(path), schema)


def _parsed(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Lines of JSON to the schema's columns, with the line itself and its file where it does not fit."""
    with_line = T.StructType([*schema.fields, T.StructField(REJECTED_LINE, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": REJECTED_LINE}
    # a blank line is neither a payload nor a reject
    filled = lines.filter(F.col("value").rlike(r"\S"))
    rows = filled.select(F.from_json("value", with_line, options).alias("p"), F.col("value"), F.col("_metadata.file_path").alias("_at"))
    # "null" parses to no struct at all; what fits in part only is not taken in part
    bad = F.col("p").isNull() | F.col(f"p.{REJECTED_LINE}").isNotNull()
    return rows.select(
        *[F.when(~bad, F.col(f"p.`{f.name}`")).alias(f.name) for f in schema.fields],
        F.when(bad, F.col("value")).alias(REJECTED_LINE),
        F.when(bad, F.col("_at")).alias(PAYLOAD_FILE),
    )


def payloads(read: DataFrame) -> DataFrame:
    """What was read without the lines that are no payload."""
    if REJECTED_LINE not in read.columns:
        return read
    return read.filter(F.col(REJECTED_LINE).isNull()).drop(REJECTED_LINE, PAYLOAD_FILE)


def rejected_lines(payload: DataFrame, source: str, ingested_at: datetime | Column | None = None) -> DataFrame | None:
    """The lines that are no payload, as rows of ``schemas.REJECTED``; None for a frame that was not read from lines."""
    if REJECTED_LINE not in payload.columns:
        return None
    return payload.filter(F.col(REJECTED_LINE).isNotNull()).select(
        F.lit(source).alias("source"), F.col(PAYLOAD_FILE).alias("file"), F.col(REJECTED_LINE).alias("line"), _run_time(ingested_at).alias("ingested_at")
    )


def _run_time(ingested_at: datetime | Column | None) -> Column:
    if ingested_at is None:
        return F.current_timestamp()
    return ingested_at if isinstance(ingested_at, Column) else F.lit(ingested_at)


def hn_rows(pages: DataFrame, ingested_at: datetime | Column | None = None) -> DataFrame:
    """Search result pages to one row per hit."""
    return pages.select("query_tool", F.inline("hits")).select(
        F.col("objectID").alias("object_id"),
        "query_tool",
        "title",
        first_filled(F.col("comment_text"), F.col("story_text"), F.col("title")).alias("text"),
        "author",
        "points",
        "num_comments",
        "url",
        F.col("created_at").alias("hn_created_at"),
        F.when(F.length("comment_text") > 0, F.lit("comment")).otherwise(F.lit("story")).alias("object_type"),
        _run_time(ingested_at).alias("ingested_at"),
    )


def reddit_rows(submissions: DataFrame, ingested_at: datetime | Column | None = None) -> DataFrame:
    """Submissions to rows: full permalink, epoch seconds to timestamp."""
    return payloads(submissions).select(
        F.col("id").alias("object_id"),
        "query_tool",
        "subreddit",
        "title",
        F.col("selftext").alias("text"),
        empty_to_null(F.col("author")).alias("author"),
        "score",
        "num_comments",
        "url",
        F.concat(F.lit(REDDIT_SITE), F.col("permalink")).alias("permalink"),
        epoch_to_timestamp(F.col("created_utc")).alias("reddit_created_utc"),
        F.lit("submission").alias("object_type"),
        _run_time(ingested_at).alias("ingested_at"),
    )


def producthunt_posts(pages: DataFrame) -> DataFrame:
    """Nested result pages to one row per post, comments still inside."""
    return pages.select(F.explode("data.posts.edges").alias("edge")).select("edge.node.*")


def producthunt_rows(posts: DataFrame, ingested_at: datetime | Column | None = None) -> DataFrame:
    """One row per post and one per comment; a comment takes title and url from its post."""
    as_post = F.struct(
        F.col("id").alias("object_id"),
        strip(F.concat_ws(" ", "tagline", "description")).alias("text"),
        F.lit(None).cast("string").alias("author"),
        F.col("votesCount").alias("votes_count"),
        F.col("commentsCount").alias("num_comments"),
        F.col("createdAt").alias("ph_created_at"),
        F.lit("post").alias("object_type"),
    )

    def as_comment(edge: Column) -> Column:
        node = edge["node"]
        return F.struct(
            node["id"].alias("object_id"),
            node["body"].alias("text"),
            node["user"]["username"].alias("author"),
            F.lit(None).cast("bigint").alias("votes_count"),
            F.lit(None).cast("bigint").alias("num_comments"),
            node["createdAt"].alias("ph_created_at"),
            F.lit("comment").alias("object_type"),
        )

    comments = F.transform(F.col("comments.edges"), as_comment)
    rows = F.concat(F.array(as_post), F.coalesce(comments, F.array().cast(_PH_ITEMS)))
    # never empty; the outer form keeps the optimizer from testing its size at the scan
    flat = posts.select(F.col("name").alias("title"), "url", F.explode_outer(rows).alias("r"))
    return flat.select(
        "r.object_id", "title", "r.text", "r.author", "r.votes_count", "r.num_comments", "url",
        "r.ph_created_at", "r.object_type", _run_time(ingested_at).alias("ingested_at"),
    )


_PH_ITEMS = T.ArrayType(
    T.StructType([
        f for f in schemas.PRODUCTHUNT_RAW.fields if f.name not in ("title", "url", "ingested_at")
    ])
)


# -- cutoffs: only what the bronze table does not have yet --------------------


def hn_new(rows: DataFrame, marks: DataFrame | None, **options) -> DataFrame:
    """Hits created strictly after the mark of their search term; ``options`` as in ``newer_than_marks``."""
    time = parse_iso(F.col("hn_created_at"))
    return rows if marks is None else newer_than_marks(rows, marks, ["query_tool"], time, **options)


def reddit_new(rows: DataFrame, marks: DataFrame | None, **options) -> DataFrame:
    """Submissions created strictly after the mark of their (subreddit, search term); ``options`` likewise."""
    keys = ["subreddit", "query_tool"]
    return rows if marks is None else newer_than_marks(rows, marks, keys, F.col("reddit_created_utc"), **options)


def producthunt_new(posts: DataFrame, mark: datetime | None) -> DataFrame:
    """Posts created strictly after the mark or without a date.

    Tests the post, before its comments become rows: a late comment does not hide
    older posts, and comments are never tested themselves.
    """
    time = parse_iso(F.col("createdAt"))
    return posts if mark is None else posts.filter(time.isNull() | (time > F.lit(mark)))
