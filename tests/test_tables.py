import threading
import uuid
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from mentionkit.operators.audit import AUDIT_TABLE, AuditLog
from mentionkit.schemas import AUDIT_SCHEMA
from mentionkit.sources.shared import shared_folder, store
from mentionkit.sources.tables import Tables


@pytest.fixture
def tables(spark):
    return Tables(spark, prefix=f"t_{uuid.uuid4().hex[:8]}_")


def test_create_read_append(spark, tables):
    assert not tables.exists("a") and tables.read_if_exists("a") is None
    df = spark.createDataFrame([(1, "x")], "i int, s string")
    tables.ensure("a", df.schema)
    tables.ensure("a", df.schema)
    assert tables.read("a").schema.names == ["i", "s"] and tables.read("a").isEmpty()
    assert tables.append(df, "a") == 1
    # by name, not by position
    assert tables.append(df.select("s", "i"), "a") == 1
    assert tables.read("a").collect() == [(1, "x")] * 2
    assert tables.append(df.limit(0), "a") == 0


def test_evolution(spark, tables):
    tables.append(spark.createDataFrame([(1,)], "i int"), "a")
    wider = spark.createDataFrame([("n", 2)], "new string, i int")
    with pytest.raises(ValueError, match="has no columns \\['new'\\]"):
        tables.append(wider, "a")
    assert tables.append(wider, "a", evolve=True) == 1
    assert tables.append(spark.createDataFrame([(3,)], "i int"), "a", evolve=True) == 1
    assert tables.read("a").orderBy("i").collect() == [(1, None), (2, "n"), (3, None)]


def test_replace(spark, tables):
    for n in (3, 2):
        tables.replace(spark.range(n), "a")
        assert tables.read("a").count() == n


def test_replace_switches_at_once(spark, tables):
    """Who has begun to read the old rows reads on; a write that fails leaves them."""
    tables.replace(spark.range(3), "a")
    begun = spark.read.table(tables.name("a"))
    with pytest.raises(Exception, match="no more"):
        tables.replace(spark.range(5).select(F.when(F.col("id") < 9, F.raise_error(F.lit("no more"))).cast("bigint").alias("id")), "a")
    assert tables.read("a").count() == 3
    tables.replace(tables.read("a").limit(2), "a")
    assert (tables.read("a").count(), begun.count()) == (2, 3)
    with pytest.raises(ValueError, match="other columns"):
        tables.replace(spark.range(1).withColumnRenamed("id", "x"), "a")


def at(day):
    return datetime(2025, 6, day, 12, tzinfo=timezone.utc)


def test_layout_by_day(spark, tables):
    """A mark leaves the folders of earlier days unopened; columns are those of the rows."""
    own = Tables(spark, prefix=tables.prefix, by_day=["a"])
    schema = "i int, ingested_at timestamp"
    for day in (1, 2, 5, 6):
        assert own.append(spark.createDataFrame([(day, at(day))], schema), "a") == 1
    assert own.append(spark.createDataFrame([(7, at(6), "n")], f"{schema}, new string"), "a", evolve=True) == 1
    assert own.append(spark.createDataFrame([(0, None)], schema), "a") == 1

    assert own.read("a").schema.names == ["i", "ingested_at", "new"]
    assert sorted(r["i"] for r in own.read("a").collect()) == [0, 1, 2, 5, 6, 7]
    assert own.read_since("a", None).count() == 6
    since = own.read_since("a", at(6))
    assert sorted(map(tuple, since.select("i", "new").collect())) == [(6, None), (7, "n")]
    plan = since._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_ingested_day" in plan
    opened = {f.split("_ingested_day=")[1][:10] for f in since.inputFiles()}
    assert "2025-06-06" in opened and not opened & {"2025-06-01", "2025-06-02"}

    # who does not know the layout reads and writes it all the same
    assert tables.append(spark.createDataFrame([(8, at(7))], schema), "a") == 1
    assert [r["i"] for r in tables.read_since("a", at(7)).collect()] == [8]
    # a table without folders is read by its column alone
    tables.append(spark.createDataFrame([(1, at(1)), (2, at(2))], schema), "b")
    assert [r["i"] for r in tables.read_since("b", at(2)).collect()] == [2]
    with pytest.raises(ValueError, match="no column ingested_at"):
        Tables(spark, prefix=tables.prefix, by_day=["c"]).ensure("c", spark.range(1).schema)


def test_database_prefix(spark):
    name = f"db_{uuid.uuid4().hex[:8]}"
    own = Tables(spark, prefix=f"{name}.")
    own.append(spark.range(2), "a")
    own.replace(spark.range(1), "b")
    assert spark.table(f"{name}.a").count() == 2 and spark.table(f"{name}.b").count() == 1


def test_threads_take_turns(spark, tables):
    df = spark.range(5)
    threads = [threading.Thread(target=tables.append, args=(df, "a")) for _ in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert tables.read("a").count() == 30


def test_append_runs_the_plan_once(spark, tables, tmp_path):
    """The count is taken from the write, not by a second job."""
    calls = spark.sparkContext.accumulator(0)

    def touch(batches):
        for b in batches:
            calls.add(1)
            yield b

    df = spark.range(10, numPartitions=1).mapInPandas(touch, "id long")
    assert tables.append(df, "a") == 10
    assert calls.value == 1


def test_audit(spark, tables):
    log = AuditLog(tables)
    assert log.read().isEmpty()
    with log.step("hackernews", "bronze") as step:
        step.rows = 2**40
    with log.step("reddit", "silver"):
        pass
    with pytest.raises(RuntimeError):
        with log.step("all", "gold") as step:
            step.rows = 3
            raise RuntimeError("no model")
    assert log.read().schema.names == AUDIT_SCHEMA.names
    got = {tuple(r)[1:] for r in tables.read(AUDIT_TABLE).collect()}
    assert got == {
        ("hackernews", "bronze", 2**40, "success", None),
        ("reddit", "silver", 0, "success", None),
        ("all", "gold", 3, "failed", "no model"),
    }


class StubSession:
    """A session in which the setting is absent."""

    def __init__(self, master):
        self.master, self.folder = master, None
        self.conf = {}
        self.sparkContext = self

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_shared_folder(spark):
    folder = shared_folder(spark)
    assert folder == (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir())
    kept = store(spark.range(3), "test")
    assert kept.count() == 3 and folder in kept.inputFiles()[0]

    local = StubSession("local[2]")
    assert shared_folder(local) == shared_folder(local) == local.folder
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(StubSession("yarn"))
    cluster = StubSession("yarn")
    cluster.conf["spark.checkpoint.dir"] = "hdfs:///shared"
    assert shared_folder(cluster) == "hdfs:///shared"


def test_evolution_inside_structs_arrays_and_numbers(spark, tables):
    first = spark.createDataFrame([(1, (1, "x"), [(1,)], {"k": 1})], "i int, s struct<a: int, b: string>, l array<struct<x: int>>, m map<string, int>")
    second = spark.createDataFrame(
        [(2**40, ("y", 2**40, 7), [("z", 2**40)], {"k": 2**40}), (None, None, None, None)],
        "i bigint, s struct<b: string, a: bigint, c: int>, l array<struct<y: string, x: bigint>>, m map<string, bigint>",
    )
    tables.append(first, "a")
    with pytest.raises(ValueError, match="other fields in \\['s', 'l', 'm'\\]"):
        tables.append(second, "a")
    assert tables.append(second, "a", evolve=True) == 2
    assert tables.append(first, "a", evolve=True) == 1
    assert tables.read("a").schema.simpleString() == (
        "struct<i:bigint,s:struct<a:bigint,b:string,c:int>,l:array<struct<x:bigint,y:string>>,m:map<string,bigint>>"
    )
    old = (1, (1, "x", None), [(1, None)], {"k": 1})
    want = [old, old, (2**40, (2**40, "y", 7), [(2**40, "z")], {"k": 2**40}), (None, None, None, None)]
    assert sorted(map(str, tables.read("a").collect())) == sorted(map(str, spark.createDataFrame(want, tables.read("a").schema).collect()))


def test_wider_numbers_in_a_table_by_day(spark, tables):
    own = Tables(spark, prefix=tables.prefix, by_day=["a"])
    for n, kind in ((1, "int"), (2**40, "bigint")):
        own.append(spark.createDataFrame([(n, at(1))], f"i {kind}, ingested_at timestamp"), "a", evolve=True)
    assert sorted(r["i"] for r in own.read("a").collect()) == [1, 2**40]
    assert sorted(r["i"] for r in own.read_since("a", at(1)).collect()) == [1, 2**40]


def test_read_days(spark, tables):
    own = Tables(spark, prefix=tables.prefix, by_day={"a": "created_at"})
    rows = spark.createDataFrame([(d, at(d)) for d in (1, 2, 3, 5)] + [(0, None)], "i int, created_at timestamp")
    own.append(rows, "a")
    tables.append(rows, "b")
    for days, want in (((at(2).date(), at(3).date(), at(4).date()), [2, 3]), ((at(1).date(), None), [0, 1]), ((), []), ((None,), [0])):
        for name, reader in (("a", own), ("b", tables)):
            assert sorted(r["i"] for r in reader.read_days(name, days, "created_at").collect()) == want, (name, days)
    plan = own.read_days("a", [at(2).date()], "created_at")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(_ingested_day" in plan or "PartitionFilters: [isnotnull(_ingested_day" in plan


def test_replace_days(spark, tables):
    frame = lambda *rows: spark.createDataFrame(list(rows), "n int, day date")
    tables.replace_days(frame((1, at(1).date()), (2, at(2).date()), (3, None)), "a", "day")
    tables.replace_days(frame((9, at(2).date()), (8, at(2).date())), "a", "day")
    assert sorted(r["n"] for r in tables.read("a").collect()) == [1, 3, 8, 9]
    tables.replace_days(frame((7, None)), "a", "day")
    assert sorted(r["n"] for r in tables.read("a").collect()) == [1, 7, 8, 9]
