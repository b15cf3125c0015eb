import re

import pytest

import corpus_pipeline as p
from mentionkit.llm import decontamination, mixing, quality, secrets
from mentionkit.sources.shared import store
from tests.llm.test_decontamination import plain as plain_leaks
from tests.llm.test_mixing import check as check_mix
from tests.llm.test_quality import plain as plain_quality
from tests.llm.test_secrets import expected as plain_spans
from tests.llm.test_simhash import plain_report

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for i, (_, f) in enumerate(p.STAGES):
        out.append(store(f(spark, out[-1], SF), f"test-{i}"))
    return [(df, df.collect()) for df in out]


def texts(rows):
    return {r["doc_id"]: r["text"] for r in rows}


def test_all_but_the_last_keep_the_columns(stages):
    assert all(df.schema.names == stages[0][0].schema.names for df, _ in stages[:-1])
    assert [f.__name__ for _, f in p.STAGES] == ["quality_rules", "near_duplicates", "benchmark_leaks", "secret_scan", "source_mix"]


def test_quality(spark, stages):
    docs = stages[0][0]
    forest = quality.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    want = set()
    for r in stages[0][1]:
        _, features = quality.statistics((r["text"] or "").encode())
        total = forest.start  # walk the nodes one by one
        for at in forest.roots:
            while forest.feature[at] >= 0:
                at = forest.left[at] if features[forest.feature[at]] <= forest.threshold[at] else forest.right[at]
            total += forest.value[at]
        if not plain_quality(r["text"])[5] and total >= 0:
            want.add(r["doc_id"])
    assert set(texts(stages[1][1])) == want


def test_near_duplicates(stages):
    groups = plain_report(list(texts(stages[1][1]).items()))
    assert sorted(texts(stages[2][1])) == sorted({c for _, _, c in groups})


def test_leaks(spark, stages):
    bench = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    gone = set(texts(stages[2][1])) - set(texts(stages[3][1]))
    before = texts(stages[2][1])
    # brute force over the removed ones and as many others
    some = [d for d in before if d not in gone and len(before[d]) < 1500][: len(gone) + 5]
    rows = [(d, before[d]) for d in [*gone, *some] if len(before[d]) < 6000]
    found = {d for d, _ in plain_leaks(rows, bench, decontamination.COVERAGE)}
    assert found == {d for d, _ in rows if d in gone}


def test_secrets(stages):
    before, after = texts(stages[3][1]), texts(stages[4][1])
    assert set(before) == set(after)
    for d, text in before.items():
        assert plain_spans(after[d]) == []
        if not plain_spans(text) and not re.search(secrets.RANDOM, text):
            assert after[d] == text


def test_mix(spark, stages):
    rows = [(r["doc_id"], r["source"], r["text"]) for r in stages[4][1]]
    got = mixing.mix(stages[4][0]).collect()
    longest = max(r["size"] for r in got)
    check_mix(rows, got, lambda s: longest)
    copies = {}
    for r in stages[5][1]:
        copies[r["doc_id"]] = copies.get(r["doc_id"], 0) + 1
    assert copies == {r["doc_id"]: r["copies"] for r in got if r["copies"]}


def test_run_equals_its_stages(spark, stages):
    key = lambda r: str(tuple(r))
    assert sorted(p.run(spark, SF).collect(), key=key) == sorted(stages[5][1], key=key)
