from datetime import datetime

import pytest
from pyspark.sql import functions as F

from mentionkit import schemas
from mentionkit.operators import aggregates as agg
from mentionkit.operators.ranking import in_batches, in_report_order, near_the_ends, top_bottom_posts

NAN = float("nan")


def scored(spark, rows):
    """rows of (tool, source, day, score)"""
    full = [
        {"post_id": f"{i:04d}", "tool": t, "source": s, "created_at": d and datetime.fromisoformat(d), "sentiment_score": v, "title": f"t{i}", "url": "u"}
        for i, (t, s, d, v) in enumerate(rows)
    ]
    return spark.createDataFrame([tuple(r.get(f.name) for f in schemas.SCORED) for r in full], schemas.SCORED)


@pytest.fixture
def posts(spark):
    return scored(spark, [
        ("A", "x", "2024-01-01", 0.2), ("A", "x", "2024-01-01T23:59:59", 0.21), ("A", "y", "2024-01-07", -0.2),
        ("A", "y", "2024-01-15", -0.9), ("B", "x", "2024-01-02", 0.4), ("B", "x", "2024-01-09", None),
        ("C", "y", "2024-01-02", 0.4), ("D", "y", "2024-01-02", 0.1), ("D", "y", None, 0.1), ("D", "y", "2024-01-02", NAN),
    ])


def _rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_daily(posts):
    got = {(r.tool, str(r.post_date)): tuple(r)[2:] for r in agg.sentiment_daily(posts).collect()}
    assert got[("A", "2024-01-01")] == (2, 0.205, 50.0, 0.0, 50.0)
    assert got[("A", "2024-01-15")] == (1, -0.9, 0.0, 100.0, 0.0)
    assert got[("D", "None")] == (1, 0.1, 0.0, 0.0, 100.0)
    assert ("B", "2024-01-09") not in got


def test_weekly_compares_with_the_last_week_that_has_posts(posts):
    got = [(r.tool, str(r.week_start)[:10], r.post_count, r.avg_sentiment, r.sentiment_change_from_prior_week) for r in agg.weekly_trend(posts.filter("tool = 'A'")).orderBy("week_start").collect()]
    assert got == [("A", "2024-01-01", 3, 0.07, None), ("A", "2024-01-15", 1, -0.9, -0.97)]


def test_leaderboard_ties(posts):
    got = [(r.tool, r.sentiment_rank) for r in agg.leaderboard(posts).orderBy("sentiment_rank", "tool").collect()]
    assert got == [("B", 1), ("C", 1), ("D", 3), ("A", 4)]


def test_by_source(posts):
    assert _rows(agg.sentiment_by_source(posts.filter("tool = 'A'")), "source") == [("A", "x", 2, 0.205, 0.2, 0.21), ("A", "y", 2, -0.55, -0.9, -0.2)]


@pytest.mark.parametrize(
    "direct, derived",
    [
        (agg.sentiment_daily, agg.daily_from_rollup), (agg.sentiment_by_source, agg.by_source_from_rollup),
        (agg.leaderboard, agg.leaderboard_from_rollup), (agg.weekly_trend, agg.weekly_from_rollup),
    ],
)
def test_rollup_gives_the_same_tables(posts, direct, derived):
    a, b = direct(posts), derived(agg.daily_rollup(posts))
    assert a.dtypes == b.dtypes
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_mean_does_not_depend_on_order(spark):
    values = [0.0125, 0.1, 0.2, 0.3, -0.6, 0.0125 * 5] * 50
    forward = scored(spark, [("A", "x", "2024-01-01", v) for v in values])
    backward = scored(spark, [("A", "x", "2024-01-01", v) for v in reversed(values)])
    assert agg.sentiment_by_source(forward.coalesce(1)).collect() == agg.sentiment_by_source(backward.repartition(7)).collect()


def test_means_are_rounded_once(spark):
    """Just below a tie is rounded down, a tie up, and ranks go by the mean before rounding."""
    rows = scored(spark, [("A", "x", "2024-01-01", 0.1234999999996), ("B", "x", "2024-01-01", 0.1235), ("C", "x", "2024-01-01", 0.1234999999997)])
    for board in (agg.leaderboard(rows), agg.leaderboard_from_rollup(agg.daily_rollup(rows))):
        got = {r.tool: (r.avg_sentiment, r.sentiment_rank) for r in board.collect()}
        assert got == {"A": (0.123, 3), "B": (0.124, 1), "C": (0.123, 2)}


def test_summary_counts_rows_without_a_score(posts):
    assert _rows(agg.scoring_summary(posts.filter("tool = 'B'")), "tool") == [("B", 2, 0.4)]


def test_top_and_bottom(spark):
    df = scored(spark, [("A", "x", "2024-01-01", v / 10) for v in range(10)] + [("B", "x", "2024-01-01", 0.5)] * 7 + [("C", "x", "2024-01-01", 0.1)])
    got = top_bottom_posts(df)
    assert got.columns == ["tool", "source", "title", "url", "sentiment_score", "created_at", "category"]
    best = [r.sentiment_score for r in got.filter("tool = 'A' and category = 'most_positive'").orderBy(F.desc("sentiment_score")).collect()]
    worst = [r.sentiment_score for r in got.filter("tool = 'A' and category = 'most_negative'").orderBy("sentiment_score").collect()]
    assert best == [0.9, 0.8, 0.7, 0.6, 0.5] and worst == [0.0, 0.1, 0.2, 0.3, 0.4]
    # equal scores: by post; few posts: in both ends
    assert sorted(r.title for r in got.filter("tool = 'B' and category = 'most_positive'").collect()) == ["t10", "t11", "t12", "t13", "t14"]
    assert got.filter("tool = 'C'").count() == 2


def test_top_posts_limit_groups_before_the_shuffle(posts):
    plan = top_bottom_posts(posts)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 4


def test_only_rows_near_the_ends_are_ranked(spark):
    """Many posts of a tool, few of another, some without a tool, and one whose scores are mostly equal."""
    rows = [("A", "x", "2024-01-01", (i * 7919 % 2003) / 2003 - 0.5) for i in range(2000)]
    rows += [("B", "x", "2024-01-01", 0.5)] * 3 + [(None, "x", "2024-01-01", i / 200 - 0.5) for i in range(200)]
    rows += [("C", "x", "2024-01-01", 1.0)] * 300 + [("C", "x", "2024-01-01", -0.0), ("C", "x", "2024-01-01", 0.0), ("C", "x", None, NAN), ("C", "x", None, None)]
    df = scored(spark, rows).repartition(5)
    near = {r.tool: r["count"] for r in near_the_ends(df).groupBy("tool").count().collect()}
    assert near["B"] == 3 and 10 <= near["A"] < 100 and 10 <= near[None] < 100
    want = []
    for tool in ("A", "B", "C", None):
        own = [(v, f"t{i}") for i, (t, _, _, v) in enumerate(rows) if t == tool and v is not None and v == v]
        want += [(tool, t, "most_positive") for _, t in sorted(own, key=lambda r: -r[0])[:5]] + [(tool, t, "most_negative") for _, t in sorted(own, key=lambda r: r[0])[:5]]
    got = [(r.tool, r.title, r.category) for r in top_bottom_posts(df).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_report_order(posts):
    daily = in_report_order(agg.sentiment_daily(posts.filter("created_at is not null")), "sentiment_by_tool_daily").collect()
    assert [(str(r.post_date), r.tool) for r in daily][:3] == [("2024-01-15", "A"), ("2024-01-07", "A"), ("2024-01-02", "B")]
    weekly = in_report_order(agg.weekly_trend(posts), "sentiment_trend_weekly").first()
    assert (weekly.tool, str(weekly.week_start)[:10]) == ("A", "2024-01-15")


def test_exact_batches_hold_all_rows(posts):
    rows = in_batches(posts.repartition(5), 3).orderBy("post_id", "tool").collect()
    assert len(rows) == posts.count()
    assert [r.batch for r in rows] == [i // 3 for i in range(len(rows))]


def test_counts(spark):
    got = agg.table_counts({"a": spark.range(3), "b": spark.range(0)})
    assert _rows(got, "table_name") == [("a", 3), ("b", 0)]
