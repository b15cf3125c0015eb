import random
import re

import pytest
from pyspark.sql import functions as F

from mentionkit.llm import mixing

COLUMNS = "doc_id long, source string, text string"


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    target, open_ = dict.fromkeys(names, 0.0), list(names)
    left = share * sum(sizes.values())
    while open_:
        total = sum(w[s] for s in open_)
        goal = {s: left * w[s] / total for s in open_}
        over = [s for s in open_ if goal[s] >= most * sizes[s]]
        if not over:
            target.update(goal)
            break
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
            open_.remove(s)
    return target


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def check(rows, got, near):
    sizes = {}
    for _, s, t in rows:
        sizes[s] = sizes.get(s, 0) + size(t)
    goal = plain_targets(sizes)
    assert len(got) == len(rows)
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(goal[r["source"]])
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 2
        taken[r["source"]] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - goal[s]) <= near(s) / 2 + 1e-6, (s, taken[s], goal[s])


def test_targets_are_met_to_half_a_document(spark):
    random.seed(6)
    rows = []
    for i in range(4000):
        s = random.choice(["a", "a", "a", "b", "c", "ä", "Z", None])
        rows.append((i, s, "w " * random.choice([0, 1, 5, 30, 200])))
    rows += [(5000, "tiny", "one"), (5001, "void", ""), (5002, "void", None), (5003, "solo", "w " * 900)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], COLUMNS + ", size int").repartition(5)
    got = mixing.mix(docs).collect()
    longest = {}
    for _, s, t in rows:
        longest[s] = max(longest.get(s, 0), size(t))
    check(rows, got, lambda s: longest[s])
    again = mixing.mix(docs.repartition(3)).collect()
    key = lambda r: str(tuple(r))
    assert sorted(got, key=key) == sorted(again, key=key)


def test_equal_rows_are_split(spark):
    """A third of all rows agree in everything; the target is still met to half a document."""
    rows = [(1, "a", "same row here")] * 1500 + [(i, "a", "w " * 3) for i in range(10, 1500)] + [(i, "b", "x y z") for i in range(2000, 5000)]
    got = mixing.mix(spark.createDataFrame(rows, COLUMNS)).collect()
    check(rows, got, lambda s: 3)


def test_unequal_chances(spark):
    """With a propensity the mean number of copies follows it, and the words still come out."""
    rows = [(i, s, "w " * 10) for i in range(4000) for s in ("a", "b")]
    docs = spark.createDataFrame(rows, COLUMNS)
    got = mixing.mix(docs, weights=(3.0, 4.0), share=0.5, propensity=F.when(F.col("doc_id") < 2000, 1.0).otherwise(3.0)).collect()
    for s in ("a", "b"):
        own = [r for r in got if r["source"] == s]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 10
        low, high = (sum(r["copies"] for r in own if (r["doc_id"] < 2000) == side) for side in (True, False))
        assert high / low == pytest.approx(3, rel=0.15)


def test_empty_tables(spark):
    assert mixing.mix(spark.createDataFrame([], COLUMNS)).count() == 0
    assert mixing.mixed_documents(spark.createDataFrame([], COLUMNS)).count() == 0
    got = mixing.mix(spark.createDataFrame([(1, None, None), (2, "a", "")], COLUMNS)).collect()
    assert [(r["target"], r["taken"]) for r in got] == [(0.0, 0), (0.0, 0)]


def test_documents_of_the_mix(spark):
    random.seed(8)
    rows = [(i, random.choice(["a", "b", "c"]), "w " * random.randrange(1, 40), "kept") for i in range(900)]
    docs = spark.createDataFrame(rows, COLUMNS + ", copies string").repartition(4)
    out = mixing.mixed_documents(docs)
    assert out.columns == [*docs.columns, "size", "source_size", "target", "mix_copies", "copy_no"]
    got = out.collect()
    plan = {r["doc_id"]: r["copies"] for r in mixing.mix(docs.drop("copies")).collect()}
    copies = {}
    for r in got:
        assert r["copies"] == "kept"
        copies.setdefault(r["doc_id"], []).append(r["copy_no"])
    assert {k: len(v) for k, v in copies.items()} == {k: v for k, v in plan.items() if v}
    assert all(sorted(v) == list(range(1, len(v) + 1)) for v in copies.values())


def test_columns_of_any_name_are_handed_on(spark):
    rows = [(i, f"w{i} " * (1 + i % 7), "ab"[i % 2], f"l{i}", i, i + 1) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, _lang string, size int, mix_size int")
    out = mixing.mixed_documents(docs)
    assert out.columns == [*docs.columns, "mix_mix_size", "source_size", "target", "copies", "copy_no"]
    taken = {tuple(r)[:6] for r in out.collect()}
    assert taken and taken <= set(rows)


def test_repeated_rows_are_taken_one_by_one(spark):
    """A source of one text, repeated, still meets its target: some rows are taken once, others twice."""
    docs = spark.createDataFrame([(1, "a b c", "s")] * 1000 + [(2, "x " * 3000, "t")], "doc_id long, text string, source string")
    words = {r["source"]: r for r in mixing.mixed_documents(docs).groupBy("source").agg(mixing.F.sum("size").alias("n"), mixing.F.first("target").alias("t")).collect()}
    assert abs(words["s"]["n"] - words["s"]["t"]) <= 3
