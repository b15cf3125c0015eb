from datetime import date

import pytest

from mentionkit.catalog import Entity, EntityCatalog
from mentionkit.operators import quality
from tests.test_aggregates import scored

CATALOG = EntityCatalog((Entity("A", ("a",), (), date(2024, 1, 1)), Entity("B", ("b",), (), date(2025, 1, 1))))


def _report(df, **options):
    return {r.check: (r.violations, r.total, r.passed, r.detail) for r in quality.quality_report(df, CATALOG, **options).collect()}


def test_clean_table(spark):
    df = scored(spark, [("A", "x", "2024-01-01", -1.0), ("B", "x", "2025-01-01", 1.0), ("C", "x", "1990-01-01", 0.0)])
    report = quality.quality_report(df, CATALOG)
    assert all(r.passed and r.detail is None for r in report.collect())
    assert quality.issue_summary(report).first() == (0, None)
    quality.assert_quality(report)


def test_violations(spark):
    df = scored(spark, [("A", "x", "2023-12-31T23:59:59", 1.01), ("B", "x", "2024-06-01", -1.01), ("A", "x", "2024-01-01", None), ("A", "x", "2024-01-01", float("nan"))])
    df = df.unionByName(df.limit(1))
    got = _report(df)
    assert got["score_range"][:3] == (4, 5, False)
    assert got["null_rate"][:3] == (1, 5, False)
    # each tool against its own date, not the earliest of all
    assert got["launch_dates"][:3] == (3, 5, False)
    assert got["unique_keys"][:3] == (1, 2, False)
    assert got["not_empty"] == (0, 5, True, None)
    issues = quality.issue_summary(quality.quality_report(df, CATALOG)).first()
    assert issues.failed_checks == 4 and issues.issues.count("; ") == 3
    with pytest.raises(ValueError, match="launch of their tool"):
        quality.assert_quality(quality.quality_report(df, CATALOG))


@pytest.mark.parametrize("nulls, passed", [(1, True), (2, False)])
def test_null_limit(spark, nulls, passed):
    df = scored(spark, [("A", "x", "2024-01-01", None if i < nulls else 0.1) for i in range(20)])
    assert _report(df)["null_rate"][2] is passed
    assert quality.null_rate(df).first() == (nulls, 20, nulls * 5.0)


def test_empty_table(spark):
    df = scored(spark, [("A", "x", "2024-01-01", 0.1)]).limit(0)
    got = _report(df)
    assert got["not_empty"] == (1, 0, False, "1 empty table") and got["null_rate"][2]
    assert quality.null_rate(df).first() == (0, 0, 0.0)


def test_rows_behind_the_counts(spark):
    df = scored(spark, [("A", "x", "2023-01-01", 2.0), ("A", "x", "2024-02-01", 0.0)])
    assert [r.post_id for r in quality.out_of_range(df).collect()] == ["0000"]
    assert [r.post_id for r in quality.before_launch(df, CATALOG.starts_df(spark)).collect()] == ["0000"]
    assert quality.missing_scored_columns(df.drop("url")) == ["url"]


def test_one_pass(spark):
    df = scored(spark, [("A", "x", "2024-01-01", 0.1)])
    plan = quality.quality_metrics(df, CATALOG)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
