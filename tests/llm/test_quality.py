import random
import re
from collections import Counter

import numpy as np

from mentionkit.llm import quality

TEXTS = [
    None, "", " \n\t", "one", "a b c a b c d", "x\nx\ny\n \n \nx", "a#b $c | é𝒳 < > %% **", "the cat the cat the cat sat " * 30, "w\u00a0v\u0085u t",
    "same line here\nsame line here\r\nsame line here", " ".join(f"w{i}" for i in range(60)), "z " * 70_000, "a\x0bb\x0cc\x1cd",
]


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines, dup, seen = text.split("\n"), 0, set()
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = Counter(zip(words, words[1:], words[2:]))
    repeated = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(repeated), failed


def test_counts_against_plain_version(spark):
    random.seed(2)
    texts = TEXTS + ["".join(random.choices("ab \n|é", k=random.randrange(80))) for _ in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = quality.judged(docs, None).orderBy("doc_id").select("verdict.*").collect()
    for r, t in zip(got, texts):
        assert tuple(r[c] for c in (*quality.BASE, "base_failed")) == plain(t), t
        assert r["kept"] == (not r["base_failed"])


def test_counts_with_a_large_vocabulary():
    words = [f"w{i}" for i in range(1 << 20)] + ["w0", "w1", "w2", "w3"]
    assert quality.statistics(" ".join(words).encode())[0][4] == 8


def sample(n=3000, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.random((n, 3))
    y = ((np.sin(6 * x[:, 0]) + x[:, 1] - x[:, 2] + rng.normal(0, 0.3, n)) > 0.3).astype(float)
    return x, y


def test_trees_learn_and_obey_directions():
    x, y = sample()
    forest = quality.train(x, y, [0, 1, -1])
    x2, y2 = sample(seed=1)
    assert ((forest.score(x2) > 0) == y2).mean() > 0.85
    grid = np.linspace(0, 1, 101)
    for row in x2[:40]:
        for f, sign in ((1, 1), (2, -1)):
            line = np.repeat(row[None], len(grid), axis=0)
            line[:, f] = grid
            assert (sign * np.diff(forest.score(line)) >= -1e-9).all()


def test_flat_scoring_equals_walking_the_nodes():
    x, y = sample(500)
    forest = quality.train(x, y, [0, 0, 0], trees=7)
    for row, got in zip(x[:50], forest.score(x[:50])):
        total = forest.start
        for at in forest.roots:
            while forest.feature[at] >= 0:
                at = forest.left[at] if row[forest.feature[at]] <= forest.threshold[at] else forest.right[at]
            total += forest.value[at]
        assert abs(total - got) < 1e-9


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    forest = quality.fit(docs, labels.where("doc_id % 2 = 0"))
    rows = quality.judged(docs.join(labels.where("doc_id % 2 = 1"), "doc_id"), forest).where("not verdict.base_failed")
    good = [(r["quality"] == 1, r["verdict"]["kept"]) for r in rows.select("quality", "verdict").collect()]
    assert sum(a == b for a, b in good) / len(good) > 0.95
    clean = [k for g, k in good if g]
    assert sum(clean) / len(clean) > 0.97


def test_without_labels_the_rules_decide(spark):
    docs = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(60))), (2, "short"), (3, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0), (2, None, 0)], "doc_id long, quality int, toxic int")
    assert {r["doc_id"]: r["kept"] for r in quality.quality_report(docs, labels).collect()} == {1: True, 2: False, 3: False}
    assert quality.quality_report(docs.where("false"), labels).count() == 0


def test_stage_keeps_columns(spark):
    text = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(1, text, "v", None), (1, text, "v", None), (2, None, None, "k"), (None, text, "n", "k")], "doc_id long, text string, verdict string, kept string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = quality.kept_documents(docs, labels)
    assert out.columns == docs.columns
    assert sorted((r["doc_id"] or 0) for r in out.collect()) == [0, 1, 1]
