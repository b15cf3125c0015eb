from datetime import datetime

import pytest
from pyspark.sql import functions as F

from mentionkit import schemas
from mentionkit.catalog import AI_TOOLS
from mentionkit.operators import refine
from mentionkit.operators.refine import HACKERNEWS, PRODUCTHUNT, REDDIT

T = datetime(2025, 1, 1)
RUN = datetime(2025, 6, 1)


def hn(spark, *rows):
    full = [{"object_id": "1", "title": None, "text": None, "hn_created_at": "2025-01-01T00:00:00Z", "ingested_at": T, **r} for r in rows]
    return spark.createDataFrame([tuple(r.get(f.name) for f in schemas.HN_RAW) for r in full], schemas.HN_RAW)


def _refined(bronze, source=HACKERNEWS):
    return refine.refine(bronze, source, AI_TOOLS, RUN).orderBy("post_id", "tool").collect()


def test_silver_row(spark):
    bronze = hn(spark, {"title": "<b>ChatGPT</b>", "text": "x &amp;  y", "points": 5, "num_comments": 2, "url": "u", "author": "me", "object_type": "story"})
    (row,) = _refined(bronze)
    assert row.asDict() == {
        "post_id": "1", "source": "hackernews", "tool": "ChatGPT", "object_type": "story", "title": "ChatGPT", "text": "x & y",
        "author": "me", "score": 5, "num_comments": 2, "url": "u", "created_at": T, "ingested_at": T, "cleaned_at": RUN,
    }


def test_one_row_per_entity_and_none_without(spark):
    bronze = hn(spark, {"text": "Claude vs ChatGPT, AI"}, {"object_id": "2", "text": "weather"}, {"object_id": "3"})
    assert [(r.post_id, r.tool) for r in _refined(bronze)] == [("1", "ChatGPT"), ("1", "Claude")]


def test_the_copy_ingested_last_wins(spark):
    old = {"text": "chatgpt old", "points": 1}
    new = {"text": "chatgpt new", "points": 9, "ingested_at": datetime(2025, 2, 1)}
    (row,) = _refined(hn(spark, new, *[old] * 30))
    assert (row.text, row.score) == ("chatgpt new", 9)


def test_dates(spark):
    """Start midnight is in, a second earlier out; no date is out; a wide number becomes NULL."""
    dates = ["2022-11-01T00:00:00Z", "2022-10-31T23:59:59Z", None, "not a date"]
    bronze = hn(spark, *[{"object_id": str(i), "text": "chatgpt", "hn_created_at": d, "points": 2**40} for i, d in enumerate(dates)])
    assert [(r.post_id, r.score) for r in _refined(bronze)] == [("0", None)]


def test_guard_forms_agree(spark):
    rows = [(tool, ts) for tool in ("ChatGPT", "v0", "unknown") for ts in (datetime(2022, 1, 1), datetime(2023, 10, 1), None)]
    df = spark.createDataFrame(rows, "tool string, created_at timestamp")
    by_map = refine.launch_guard(df, AI_TOOLS)
    by_table = refine.launch_guard_by_table(df, AI_TOOLS.starts_df(spark))
    assert sorted(map(str, by_map.collect())) == sorted(map(str, by_table.collect()))
    assert by_map.count() == 1 + 1 + 3


def test_reddit_text_falls_back_to_title(spark):
    row = {"object_id": "r", "title": "**ChatGPT**", "text": "", "permalink": "p", "reddit_created_utc": T, "ingested_at": T, "url": "u"}
    bronze = spark.createDataFrame([tuple(row.get(f.name) for f in schemas.REDDIT_RAW)], schemas.REDDIT_RAW)
    (got,) = _refined(bronze, REDDIT)
    assert (got.title, got.text, got.url, got.created_at) == ("ChatGPT", "ChatGPT", "p", T)


def test_other_sources_do_not(spark):
    row = {"object_id": "p", "title": "ChatGPT", "ph_created_at": "2025-01-01T00:00:00Z", "votes_count": 3, "ingested_at": T}
    bronze = spark.createDataFrame([tuple(row.get(f.name) for f in schemas.PRODUCTHUNT_RAW)], schemas.PRODUCTHUNT_RAW)
    (got,) = _refined(bronze, PRODUCTHUNT)
    assert (got.text, got.score, got.source) == (None, 3, "producthunt")


def test_one_shuffle(spark):
    plan = refine.refine(hn(spark, {"text": "chatgpt"}), HACKERNEWS, AI_TOOLS, RUN)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert "Python" not in plan


def test_validation(spark):
    df = spark.createDataFrame([], schemas.SILVER)
    assert schemas.validate_silver(df) is df
    with pytest.raises(ValueError, match="missing required columns: \\['tool', 'url'\\]"):
        schemas.validate_silver(df.drop("tool", "url"))
    with pytest.raises(ValueError, match="score"):
        schemas.validate_silver(df.withColumn("score", F.lit("x")))
