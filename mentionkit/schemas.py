"""Table schemas and the checks that a frame conforms to one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def table(required: str = "", **columns: str) -> T.StructType:
    """StructType from ``name=type`` pairs; ``required`` lists the non-null ones."""
    return T.StructType([T.StructField(n, _TYPES[t], n not in required.split()) for n, t in columns.items()])


# -- landed payloads (one JSON document per line) ---------------------------

HIT = table(
    objectID="string", title="string", comment_text="string", story_text="string", author="string",
    points="bigint", num_comments="bigint", url="string", created_at="string",
)
HN_PAGE = T.StructType([
    T.StructField("query_tool", T.StringType()),
    T.StructField("hits", T.ArrayType(HIT)),
])

REDDIT_SUBMISSION = table(
    query_tool="string", id="string", subreddit="string", title="string", selftext="string",
    author="string", score="bigint", num_comments="bigint", url="string", permalink="string",
    created_utc="double",
)

PH_COMMENT = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("body", T.StringType()),
    T.StructField("createdAt", T.StringType()),
    T.StructField("user", table(username="string")),
])
PH_POST = T.StructType([
    *table(
        id="string", name="string", tagline="string", description="string", votesCount="bigint",
        commentsCount="bigint", url="string", createdAt="string",
    ).fields,
    T.StructField("comments", T.StructType([
        T.StructField("edges", T.ArrayType(T.StructType([T.StructField("node", PH_COMMENT)]))),
    ])),
])
PH_PAGE = T.StructType([
    T.StructField("data", T.StructType([
        T.StructField("posts", T.StructType([
            T.StructField("edges", T.ArrayType(T.StructType([T.StructField("node", PH_POST)]))),
            T.StructField("pageInfo", T.StructType([
                T.StructField("hasNextPage", T.BooleanType()),
                T.StructField("endCursor", T.StringType()),
            ])),
        ])),
    ])),
])

# -- bronze ------------------------------------------------------------------

HN_RAW = table(
    object_id="string", query_tool="string", title="string", text="string", author="string",
    points="bigint", num_comments="bigint", url="string", hn_created_at="string",
    object_type="string", ingested_at="timestamp",
)
REDDIT_RAW = table(
    object_id="string", query_tool="string", subreddit="string", title="string", text="string",
    author="string", score="bigint", num_comments="bigint", url="string", permalink="string",
    reddit_created_utc="timestamp", object_type="string", ingested_at="timestamp",
)
PRODUCTHUNT_RAW = table(
    object_id="string", title="string", text="string", author="string", votes_count="bigint",
    num_comments="bigint", url="string", ph_created_at="string", object_type="string",
    ingested_at="timestamp",
)

# -- silver, gold and shared --------------------------------------------------

SILVER = table(
    required="post_id source tool",
    post_id="string", source="string", tool="string", object_type="string", title="string",
    text="string", author="string", score="int", num_comments="int", url="string",
    created_at="timestamp", ingested_at="timestamp", cleaned_at="timestamp",
)
SCORED = table(
    post_id="string", source="string", tool="string", title="string", text="string",
    author="string", score="int", num_comments="int", url="string", created_at="timestamp",
    sentiment_score="double",
)
# rows_processed is 64-bit: one run over a large source passes 2^31 rows
AUDIT_SCHEMA = table(
    run_timestamp="timestamp", source="string", layer="string", rows_processed="bigint",
    status="string", error_message="string",
)
MARK_SCHEMA = table(source="string", layer="string", mark="timestamp", run_timestamp="timestamp")
LANDING_MARK_SCHEMA = table(
    source="string", subreddit="string", query_tool="string", mark="timestamp", covered_until="timestamp",
)
REJECTED = table(required="source line", source="string", file="string", line="string", ingested_at="timestamp")
KEY_FILTER_SCHEMA = table(source="string", day="date", word="int", bits="bigint")
REPORT_DAY_SCHEMA = table(run="string", day="date", state="string", run_timestamp="timestamp")
REPLY_SCHEMA = table(digest="string", reply="string")
ALIAS_SCHEMA = table(tool="string", alias="string", tier="string")
START_DATE_SCHEMA = table(tool="string", launch_date="date")


def missing_columns(df: DataFrame, schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if f.name not in df.columns]


def validate_frame(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Return ``df`` if it has every column of ``schema`` in the right type.

    Looks at the analysed schema only, so it starts no job.
    """
    missing = missing_columns(df, schema)
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    wrong = {
        f.name: f"{df.schema[f.name].dataType.simpleString()}, expected {f.dataType.simpleString()}"
        for f in schema.fields
        if df.schema[f.name].dataType != f.dataType
    }
    if wrong:
        raise ValueError(f"columns of the wrong type: {wrong}")
    return df


def validate_silver(df: DataFrame) -> DataFrame:
    return validate_frame(df, SILVER)
