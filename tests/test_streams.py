import json
import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from mentionkit import schemas
from mentionkit.catalog import AI_TOOLS
from mentionkit.operators.refine import HACKERNEWS
from mentionkit.sources import landing
from mentionkit.sources.tables import Tables
from mentionkit.streaming import streams

T = datetime(2025, 1, 1)


@pytest.fixture
def tables(spark):
    return Tables(spark, prefix=f"st_{uuid.uuid4().hex[:8]}_")


def _write_bronze(spark, path, *rows):
    full = [{"object_id": i, "text": t, "ingested_at": at, "hn_created_at": "2025-01-01T00:00:00Z"} for i, t, at in rows]
    df = spark.createDataFrame([tuple(r.get(f.name) for f in schemas.HN_RAW) for r in full], schemas.HN_RAW)
    df.repartition(2).write.mode("append").parquet(path)


def _stream(spark, path):
    return spark.readStream.schema(schemas.HN_RAW).parquet(path)


def test_refine_stream_continues_and_survives_a_replay(spark, tables, tmp_path):
    path, checkpoint = str(tmp_path / "bronze"), str(tmp_path / "c")
    run = lambda c: streams.refine_stream(_stream(spark, path), HACKERNEWS, AI_TOOLS, tables, c).awaitTermination()
    _write_bronze(spark, path, ("1", "chatgpt", T), ("1", "chatgpt", T), ("2", "none", T))
    run(checkpoint)
    assert tables.read("hn_clean").count() == 1
    _write_bronze(spark, path, ("3", "chatgpt and claude.ai", T))
    run(checkpoint)
    assert tables.read("hn_clean").count() == 3
    # a lost checkpoint replays all batches
    run(str(tmp_path / "other"))
    assert tables.read("hn_clean").count() == 3


def test_land_stream(spark, tables, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    hit = lambda i: {"query_tool": "v0", "hits": [{"objectID": i, "title": "t"}]}
    run = lambda c: streams.land_stream(
        landing.stream_payload(spark, str(folder), schemas.HN_PAGE), landing.hn_rows, tables, "hn_raw",
        schemas.HN_RAW, ["object_id", "query_tool"], str(tmp_path / c),
    ).awaitTermination()
    (folder / "a.json").write_text("\n".join(json.dumps(hit(i)) for i in "112"))
    run("c")
    (folder / "b.json").write_text(json.dumps(hit("2")) + "\n" + json.dumps(hit("3")))
    run("c")
    assert sorted(r.object_id for r in tables.read("hn_raw").collect()) == ["1", "2", "3"]


def test_copies_within_the_watermark(spark, tmp_path):
    path = str(tmp_path / "bronze")
    _write_bronze(spark, path, *[("1", "chatgpt", T)] * 40, ("2", "chatgpt", T))
    mentions = streams.mention_stream(_stream(spark, path), HACKERNEWS, AI_TOOLS)
    out = str(tmp_path / "out")
    streams.write_files(streams.first_within_watermark(mentions, "1 day"), out, str(tmp_path / "c")).awaitTermination()
    got = spark.read.parquet(out)
    assert sorted(r.post_id for r in got.collect()) == ["1", "2"]
    assert "_salt" not in got.columns


def test_daily_windows_close_by_watermark(spark, tmp_path):
    path = str(tmp_path / "scored")
    rows = [("A", datetime(2025, 1, 1, 5), 0.5), ("A", datetime(2025, 1, 1, 6), None), ("A", datetime(2025, 1, 2), 0.1), ("A", datetime(2025, 1, 3, 12), 0.2)]
    spark.createDataFrame(rows, "tool string, created_at timestamp, sentiment_score double").write.parquet(path)
    stream = spark.readStream.schema("tool string, created_at timestamp, sentiment_score double").parquet(path)
    out = str(tmp_path / "out")
    streams.write_files(streams.daily_stream(stream, "6 hours"), out, str(tmp_path / "c")).awaitTermination()
    got = [tuple(r) for r in spark.read.parquet(out).select("tool", F.col("post_date").cast("string"), "post_count", "avg_sentiment", "positive_pct").orderBy("post_date").collect()]
    assert got == [("A", "2025-01-01", 1, 0.5, 100.0), ("A", "2025-01-02", 1, 0.1, 0.0)]


def test_rollup_stream_keeps_every_day_and_survives_a_replay(spark, tables, tmp_path):
    from mentionkit.operators.aggregates import sentiment_daily, daily_from_rollup

    path, schema = str(tmp_path / "scored"), "tool string, source string, created_at timestamp, sentiment_score double"
    days = [("A", "x", datetime(2025, 1, d, 5), d / 10) for d in (3, 1, 2, 3)]
    for day in days:  # one file and one micro-batch each, the older ones late
        spark.createDataFrame([day], schema).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    query = streams.rollup_stream(stream, tables, "rollup", str(tmp_path / "c"))
    query.awaitTermination()
    assert tables.read("rollup").select("_batch").distinct().count() == 4
    want = sorted(map(tuple, sentiment_daily(spark.createDataFrame(days, schema)).collect()))
    assert sorted(map(tuple, daily_from_rollup(tables.read("rollup")).collect())) == want
    # the last batch runs again after a crash before its commit
    commits = sorted((tmp_path / "c" / "commits").glob("[0-9]*"), key=lambda f: int(f.name))
    (tmp_path / "c" / "commits" / f".{commits[-1].name}.crc").unlink(missing_ok=True)
    commits[-1].unlink()
    streams.rollup_stream(stream, tables, "rollup", str(tmp_path / "c")).awaitTermination()
    assert sorted(map(tuple, daily_from_rollup(tables.read("rollup")).collect())) == want


def test_a_long_history_is_cut_to_the_micro_batch(spark, tables, tmp_path, monkeypatch):
    """The keys of the target meet those of the batch before any of them is shuffled."""
    seen = []
    original = Tables.append

    def spying(self, df, table, evolve=False):
        seen.append(df._jdf.queryExecution().optimizedPlan().toString())
        return original(self, df, table, evolve)

    monkeypatch.setattr(Tables, "append", spying)
    path = str(tmp_path / "bronze")
    _write_bronze(spark, path, ("1", "chatgpt", T))
    streams.refine_stream(_stream(spark, path), HACKERNEWS, AI_TOOLS, tables, str(tmp_path / "c")).awaitTermination()
    assert len(seen) == 1 and "LeftSemi" in seen[0] and "LeftAnti" in seen[0]


def test_a_micro_batch_is_as_many_files_as_its_share_of_splits(spark, tmp_path):
    """The files that a table is streamed from do not grow with it; rows equal in a column stay in one micro-batch."""
    from workload import queries

    rows = spark.range(4000).select("id", F.concat(F.lit("text "), (F.col("id") % 300).cast("string")).alias("text"))
    rows.repartition(24).write.parquet(f"{tmp_path}/documents.parquet")
    folder = f"{tmp_path}/seen"
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")
    try:
        stream = queries._stream(spark, str(tmp_path), "documents", 4, "text")
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)
    seen = []
    stream.writeStream.foreachBatch(lambda batch, _: seen.append((batch.select(F.input_file_name()).distinct().count(), [r["text"] for r in batch.select("text").distinct().collect()], batch.count()))).option(
        "checkpointLocation", folder
    ).trigger(availableNow=True).start().awaitTermination()
    assert sum(n for _, _, n in seen) == 4000 and len(seen) == 4
    texts = [t for _, found, _ in seen for t in found]
    assert len(texts) == len(set(texts)) == 300
    assert sum(files for files, _, _ in seen) > 4
