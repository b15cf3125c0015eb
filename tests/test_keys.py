from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from mentionkit.operators import marks
from mentionkit.operators.keys import keep_first, key_counts, lookup, not_in, not_in_history, pick


@pytest.fixture
def skewed(spark):
    """A third of the rows are copies under one key."""
    hot = spark.range(4000).select(F.lit("hot").alias("post_id"), F.lit("T").alias("tool"), (F.col("id") % 7).alias("v"))
    cold = spark.range(8000).select(F.col("id").cast("string").alias("post_id"), F.lit("T").alias("tool"), F.lit(1).cast("bigint").alias("v"))
    return hot.unionByName(cold)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_keep_first_reduces_before_the_shuffle(skewed):
    kept = keep_first(skewed, ["post_id", "tool"], [F.desc("v")])
    assert kept.count() == 8001
    assert kept.filter("post_id = 'hot'").first()["v"] == 6
    plan = _plan(kept)
    below_exchange = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in below_exchange and "Partial" in below_exchange


def test_dedup_and_anti_join_share_the_shuffle(spark, skewed):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        done = skewed.filter("post_id < '3'")
        fresh = not_in(keep_first(skewed, ["post_id", "tool"]), done, ["post_id", "tool"])
        assert _plan(fresh).count("Exchange hashpartitioning") == 2
        want = {r[0] for r in skewed.select("post_id").distinct().collect()} - {r[0] for r in done.select("post_id").collect()}
        rows = [r["post_id"] for r in fresh.collect()]
        assert set(rows) == want and len(rows) == len(want)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture(params=["10MB", "-1"])
def threshold(spark, request):
    """Joins by broadcast and by shuffle."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", request.param)
    yield request.param
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup(spark, skewed, threshold, how):
    table = spark.createDataFrame([("hot", 1), ("5", 2), ("none", 3)], "post_id string, extra int")
    joined = lookup(skewed, table, ["post_id"], how)
    assert joined.columns == ["post_id", "tool", "v", "extra"]
    assert joined.filter("extra = 1").count() == 4000
    assert joined.filter("extra = 2").count() == 1
    assert joined.count() == (12000 if how == "left" else 4001)


def test_missing_keys_are_one_key(spark, threshold):
    df = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "k string, v int")
    table = spark.createDataFrame([(None, 20), ("a", 10)], "k string, extra int")
    got = lookup(df, table, ["k"]).orderBy("v").collect()
    assert [tuple(r) for r in got] == [("a", 1, 10), (None, 2, 20), ("b", 3, None)]
    assert [r.v for r in not_in(df, table, ["k"], nulls_equal=True).collect()] == [3]
    assert [r.v for r in marks.not_yet_landed(df, table, ["k"]).collect()] == [3]


def test_no_function_starts_a_job(spark, skewed):
    spark.sparkContext.setJobGroup("plans-only", "")
    try:
        lookup(skewed, skewed.limit(3).withColumnRenamed("v", "w").drop("tool"), ["post_id"])
        not_in_history(skewed, skewed, ["post_id"])
        keep_first(skewed, ["post_id"])
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("plans-only")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_whole_rows_as_key(spark):
    df = spark.createDataFrame([(1, [2]), (1, [2]), (1, [3])], "a int, b array<int>")
    assert keep_first(df, ["a", "b"]).count() == 2


def test_lookup_refuses_other_joins(spark, skewed):
    with pytest.raises(ValueError):
        lookup(skewed, skewed, ["post_id"], "outer")


def test_marks(spark):
    t = datetime(2024, 1, 1)
    rows = [("a", t), ("a", t + timedelta(days=2)), ("b", t), ("c", None)]
    df = spark.createDataFrame(rows, "k string, ts timestamp")
    assert marks.read_mark(df, F.col("ts")) == t + timedelta(days=2)
    assert marks.read_mark(df.limit(0), F.col("ts")) is None
    assert marks.read_mark(None, F.col("ts")) is None
    # strictly after the mark
    assert marks.newer_than(df, F.col("ts"), t).count() == 1
    assert marks.newer_than(df, F.col("ts"), None).count() == 4
    found = marks.marks_by_key(df, ["k"], F.col("ts"))
    # the same rows again: nothing is new, apart from the key without a time
    again = marks.newer_than_marks(df, found, ["k"], F.col("ts"))
    assert [r["k"] for r in again.collect()] == ["c"]
    late = spark.createDataFrame([("a", t + timedelta(days=1)), ("b", t + timedelta(days=1)), ("b", None)], "k string, ts timestamp")
    assert [r["k"] for r in marks.newer_than_marks(late, found, ["k"], F.col("ts")).collect()] == ["b"]
    assert marks.newer_than_marks(late, found, ["k"], F.col("ts"), keep_undated=True).count() == 2


def test_mark_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).select(F.timestamp_seconds("id").alias("ingested_at"), F.lit("x").alias("text")).write.parquet(path)
    fresh = marks.newer_than(spark.read.parquet(path), F.col("ingested_at"), datetime(1970, 1, 1, 0, 0, 5)).select("ingested_at")
    assert "GreaterThan(ingested_at" in _plan(fresh)
    assert fresh.count() == 4


def test_history_is_cut_to_the_increment(spark, skewed, threshold):
    increment = spark.createDataFrame([("hot", "T", 1), ("new", "T", 2), ("5", "U", 3), ("new", "T", 4)], skewed.schema)
    fresh = not_in_history(increment, skewed, ["post_id", "tool"])
    assert sorted(r["v"] for r in fresh.collect()) == [2, 3, 4]
    assert "LeftSemi" in _plan(fresh)


def test_pick_moves_only_copies(spark):
    """Unwanted and unique rows are told apart where they lie; what is compared exactly are copies."""
    rows = spark.range(4000).select(F.concat(F.lit("k"), (F.col("id") % 3990).cast("string")).alias("k"), F.col("id").alias("n"), F.repeat(F.lit("text "), 50).alias("text"))
    old = rows.filter("n < 1000").select("k")
    seen = key_counts(rows, ["k"], old).localCheckpoint()
    got = pick(rows, seen, ["k"], [F.desc("n")])
    want = keep_first(not_in(rows, old, ["k"]), ["k"], [F.desc("n")])
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() == 2990
    none = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, n int")
    both = key_counts(none, ["k"]).localCheckpoint()
    assert [r.n for r in pick(none, both, ["k"]).collect()] == [3]
    assert sorted(r.n for r in pick(none, both, ["k"], nulls_equal=True).collect()) == [1, 3]
    assert pick(rows.filter("false"), seen.filter("false"), ["k"]).count() == 0


def test_first_seen_rows_are_not_shuffled(spark):
    rows = spark.range(2000).select(F.col("id").alias("k"), F.repeat(F.lit("text "), 50).alias("text"))
    seen = key_counts(rows, ["k"]).localCheckpoint()
    plan = pick(rows, seen, ["k"])._jdf.queryExecution().executedPlan().toString()
    # no copies: the exact branch is known to be empty
    assert "Exchange" not in plan.split("Subqueries")[0], plan
