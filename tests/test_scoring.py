import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from mentionkit import schemas
from mentionkit.functions import scores
from mentionkit.operators.scoring import lexicon_scorer, model_scorer, open_keys, pending, pending_by_key, score_pending
from mentionkit.sources.tables import Tables

T = datetime(2025, 1, 1)
SCORER = lexicon_scorer(["good"], ["bad"])


@pytest.fixture
def tables(spark):
    return Tables(spark, prefix=f"s_{uuid.uuid4().hex[:8]}_")


def silver(spark, n=200, text="good text number"):
    ids = F.col("id").cast("string")
    values = {"post_id": ids, "source": F.lit("hackernews"), "tool": F.lit("v0"), "text": F.concat(F.lit(text + " "), ids), "ingested_at": F.lit(T)}
    return spark.range(n).select(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.SILVER])


def _keys(df):
    return sorted((r.post_id, r.tool) for r in df.collect())


def test_parse_score(spark):
    replies = ["0.3", " 0.3 ", "\n-1\n", "0.30 because", "", None, "NaN", "Infinity", "-inf", "2", "1e-1"]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(replies)], "i int, reply string")
    got = [r[0] for r in df.orderBy("i").select(scores.parse_score(F.col("reply"))).collect()]
    assert got == [0.3, 0.3, -1.0, None, None, None, None, None, None, 2.0, 0.1]


def test_prompt(spark):
    df = spark.createDataFrame([("x" * 900 + "</text>", "v0")], "text string, tool string")
    prompt = lambda **o: df.select(scores.build_prompt(F.col("text"), F.col("tool"), **o)).first()[0]
    assert prompt().count('"v0"') == 3
    whole = prompt()
    assert whole.endswith("<text>" + "x" * 900 + "< /text></text>")
    assert prompt(template="{text}|{tool}", max_chars=2) == "xx|v0"


def test_buckets_partition_the_line(spark):
    df = spark.createDataFrame([(-0.21,), (-0.2,), (0.0,), (0.2,), (0.21,)], "s double")
    s = F.col("s")
    got = df.select(scores.is_negative(s), scores.is_neutral(s), scores.is_positive(s)).collect()
    assert [tuple(r).index(True) for r in got] == [0, 1, 1, 1, 2]


def test_lexicon(spark):
    df = spark.createDataFrame([("Good, GOOD bad",), ("goodness badly",), ("",), (None,), ("égood bad-bad",)], "text string")
    got = [r[0] for r in df.select(scores.lexicon_score(F.col("text"), ["good"], ["bad"])).collect()]
    # a letter outside a-z ends a word
    assert got == [0.333, 0.0, 0.0, None, -0.333]


def test_lexicon_refuses_what_it_would_never_find(spark):
    with pytest.raises(ValueError, match="c\\+\\+"):
        scores.lexicon_score(F.col("text"), ["c++"], [""])
    df = spark.createDataFrame([("a",), (None,)], "text string")
    assert [r[0] for r in df.select(scores.lexicon_score(F.col("text"), [], [])).collect()] == [0.0, None]


def test_pending(spark):
    rows = silver(spark, 4).unionByName(silver(spark, 2))
    short = silver(spark, 1).withColumns({"post_id": F.lit("s"), "text": F.lit("0123456789")})
    eleven = silver(spark, 1).withColumns({"post_id": F.lit("e"), "text": F.lit("0123456789x")})
    none = silver(spark, 1).withColumns({"post_id": F.lit("n"), "text": F.lit(None).cast("string")})
    done = [("hackernews", "1", "v0"), ("hackernews", "2", "other"), ("hackernews", "1", "v0"), ("reddit", "3", "v0")]
    done = spark.createDataFrame(done, "source string, post_id string, tool string")
    everything = rows.unionByName(short).unionByName(eleven).unionByName(none)
    assert _keys(pending(everything, done)) == [("0", "v0"), ("2", "v0"), ("3", "v0"), ("e", "v0")]
    assert pending(everything, None).count() == 5


def test_pending_by_keys_first_is_the_same(spark):
    rows = silver(spark, 60).unionByName(silver(spark, 20)).unionByName(silver(spark, 3, text="").withColumn("post_id", F.concat(F.lit("s"), "post_id")))
    done = silver(spark, 30).select("source", "post_id", "tool")
    a, b = pending(rows, done), pending_by_key(rows, open_keys(rows, done))
    assert a.columns == b.columns
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect())) and a.count() == 30
    # what cannot be scored is not open
    assert open_keys(rows, rows).isEmpty()


def test_equal_ids_of_two_sources(spark, tables):
    both = silver(spark, 5).unionByName(silver(spark, 5).withColumn("source", F.lit("reddit")))
    assert score_pending(both, tables, "gold", SCORER).scored == 10
    assert score_pending(both, tables, "gold", SCORER).scored == 0


def test_stop_and_resume(spark, tables):
    frame = silver(spark)
    first = score_pending(frame, tables, "gold", SCORER, batch_rows=30, max_batches=2)
    assert first.batches == 2 and 0 < first.scored < 200 and first.scored + first.remaining == 200
    second = score_pending(frame, tables, "gold", SCORER, batch_rows=30)
    assert (second.scored, second.remaining) == (first.remaining, 0)
    third = score_pending(frame, tables, "gold", SCORER)
    assert (third.scored, third.remaining, third.batches) == (0, 0, 0)
    assert _keys(tables.read("gold")) == _keys(frame)


def test_time_limit(spark, tables):
    run = score_pending(silver(spark), tables, "gold", SCORER, max_minutes=0)
    assert (run.scored, run.remaining, run.batches) == (0, 200, 0)


def test_crash_in_a_batch_loses_and_repeats_nothing(spark, tables):
    frame = silver(spark)
    calls = []

    def breaking(df):
        calls.append(1)
        if len(calls) == 3:
            return SCORER(df).withColumn("sentiment_score", F.raise_error(F.lit("model gone")).cast("double"))
        return SCORER(df)

    with pytest.raises(Exception, match="model gone"):
        score_pending(frame, tables, "gold", breaking, batch_rows=40)
    assert 0 < tables.read("gold").count() < 200
    score_pending(frame, tables, "gold", SCORER)
    assert _keys(tables.read("gold")) == _keys(frame)


def test_model_scorer(spark, tables):
    def reply_to(prompts):
        return ["0.5" if " 7</text>" in p else "no idea" if " 8</text>" in p else " -0.25 " for p in prompts]

    score_pending(silver(spark, 10), tables, "gold", model_scorer(reply_to))
    got = {r.post_id: r.sentiment_score for r in tables.read("gold").collect()}
    assert got == {str(i): {7: 0.5, 8: None}.get(i, -0.25) for i in range(10)}


def test_unparsed_rows_can_be_tried_again(spark, tables):
    never, later = model_scorer(lambda ps: ["?"] * len(ps)), model_scorer(lambda ps: ["1"] * len(ps))
    run = score_pending(silver(spark, 5), tables, "gold", never, store_unparsed=False)
    assert (run.scored, run.remaining) == (0, 5)
    assert score_pending(silver(spark, 5), tables, "gold", later, store_unparsed=False).scored == 5
    # stored without a score counts as done
    assert score_pending(silver(spark, 5), tables, "gold2", never).scored == 5
    assert score_pending(silver(spark, 5), tables, "gold2", later).scored == 0


def test_a_batch_opens_its_own_files_only(spark, tables):
    seen = []

    def spying(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        seen.append((plan, df.select(F.input_file_name()).distinct().collect()))
        return SCORER(df)

    score_pending(silver(spark), tables, "gold", spying, batch_rows=100)
    assert len(seen) == 2
    for batch, (plan, files) in enumerate(seen):
        assert "PartitionFilters: [isnotnull(_batch" in plan
        assert files and all(f"/_batch={batch}/" in f[0] for f in files)


def test_only_the_tried_batches_are_stored(spark, tables):
    """Few rows to a batch: one file each; batches beyond the limit are not written."""
    from mentionkit.operators.scoring import _by_batch

    stored = _by_batch(silver(spark), batches=5, tried=2, total=200)
    folders = sorted(f.split("/_batch=")[1].split("/")[0] for f in stored.inputFiles())
    assert folders == ["0", "1"]
    whole = _by_batch(silver(spark), batches=5, tried=5, total=200)
    assert whole.count() == 200 and 0 < stored.count() < 200


@pytest.mark.parametrize("store_unparsed", [True, False])
def test_each_row_is_asked_once(spark, tables, store_unparsed):
    asked = spark.sparkContext.accumulator(0)

    def reply_to(prompts):
        asked.add(len(prompts))
        return ["0.5"] * len(prompts)

    run = score_pending(silver(spark, 50), tables, "gold", model_scorer(reply_to), store_unparsed=store_unparsed)
    assert (run.scored, asked.value) == (50, 50)


def test_a_limited_run_says_so(spark, tables):
    scorer = lexicon_scorer(["good"], ["bad"])
    first = score_pending(silver(spark, 30), tables, "gold", scorer, batch_rows=10, max_batches=1)
    assert not first.complete and first.remaining > 0
    assert not score_pending(silver(spark, 30), tables, "gold", scorer, max_minutes=0).complete
    rest = score_pending(silver(spark, 30), tables, "gold", scorer)
    assert rest.complete and rest.scored == first.remaining


def copies(spark, n=30, texts=5):
    """Posts that share texts."""
    return silver(spark, n).withColumn("text", F.concat(F.lit("good text number "), (F.col("post_id").cast("int") % texts).cast("string")))


def test_distinct_prompts_are_asked_once_across_runs(spark, tables):
    asked = spark.sparkContext.accumulator(0)

    def reply_to(prompts):
        asked.add(len(prompts))
        return ["0.5"] * len(prompts)

    assert score_pending(copies(spark), tables, "gold", model_scorer(reply_to)).scored == 30 and asked.value == 5
    kept = model_scorer(reply_to, tables=tables, model="m1")
    for name in ("gold1", "gold2"):
        assert score_pending(copies(spark), tables, name, kept, batch_rows=7).scored == 30
        assert tables.read(name).filter("sentiment_score = 0.5").count() == 30
    assert asked.value == 10
    # another model, and another text, are other questions
    score_pending(copies(spark, texts=6), tables, "gold3", model_scorer(reply_to, tables=tables, model="m2"))
    score_pending(copies(spark, texts=6), tables, "gold4", kept)
    assert asked.value == 10 + 6 + 1


def test_a_failing_prompt_costs_its_own_score_only(spark, tables):
    def reply_to(prompts):
        if any(" 3</text>" in p for p in prompts):
            raise RuntimeError("no answer")
        return ["0.5"] * len(prompts)

    run = score_pending(copies(spark), tables, "gold", model_scorer(reply_to, tables=tables), store_unparsed=False)
    assert (run.scored, run.remaining) == (24, 6)
    later = score_pending(copies(spark), tables, "gold", model_scorer(lambda ps: ["1"] * len(ps), tables=tables), store_unparsed=False)
    assert (later.scored, later.remaining) == (6, 0)
    assert tables.read("gold").filter("sentiment_score = 1").count() == 6


def test_time_runs_out_inside_a_batch(spark, tables):
    import time

    def slow(prompts):
        time.sleep(1)
        return ["0.5"] * len(prompts)

    frame = silver(spark, 3000).coalesce(1)
    run = score_pending(frame, tables, "gold", model_scorer(slow).until(time.time() + 8))
    assert 0 < run.scored < 3000 and run.scored + run.remaining == 3000 and not run.complete
    rest = score_pending(frame, tables, "gold", SCORER)
    assert rest.scored == run.remaining and rest.complete
    assert _keys(tables.read("gold")) == _keys(frame)
    # a limit given to the run reaches the scorer
    assert not score_pending(silver(spark, 3000), tables, "gold2", model_scorer(slow), max_minutes=0.02).complete
