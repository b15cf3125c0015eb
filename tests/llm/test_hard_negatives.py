import math
import random

import numpy as np

from mentionkit.llm import hard_negatives as h

SCHEMA = "vec_id long, embedding array<float>, label int"
NAMES = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def plain(rows):
    good = {}
    for vec, x, label in rows:
        if vec is None or label is None or x is None or any(v is None or not math.isfinite(v) for v in x):
            continue
        q = [math.floor(256 * float(np.float32(v))) for v in x]
        good[vec] = min(good.get(vec, ((label + 1) % 10 if vec % 7 == 0 else label, q)), ((label + 1) % 10 if vec % 7 == 0 else label, q))
    out = []
    for a, (label, q) in good.items():
        if a % 100:
            continue
        scores = [(-sum(x * y for x, y in zip(q, p)), v, other) for v, (other, p) in good.items() if v != a and len(p) == len(q)]
        for p, pos, _ in sorted(s for s in scores if s[2] == label)[:5]:
            fit = [s for s in sorted(scores) if s[2] != label and 80 * -p <= 100 * -s[0] <= 100 * -p]
            out += [(a, pos, k + 1, v, -p, -n) for k, (n, v, _) in enumerate(fit[:5])]
    return sorted(out)


def mined(spark, rows, schema=SCHEMA):
    df = h.mine(spark.createDataFrame(rows, schema))
    assert df.columns == NAMES
    return sorted(tuple(r) for r in df.collect())


def vectors(n, dim=8, seed=1, labels=3, step=3):
    rng = random.Random(seed)
    return [(step * i, [rng.gauss(0, 1) + (i % 4) for _ in range(dim)], rng.randrange(labels)) for i in range(n)]


def test_brute_force(spark, monkeypatch):
    for name, value in (("BLOCK", 3), ("CHUNK", 50), ("_STEP", 16), ("CLUSTER_ANCHORS", 2)):
        monkeypatch.setattr(h, name, value)
    rows = vectors(900, step=10)
    got = mined(spark, rows)
    assert got == plain(rows) and len(got) > 500


def test_ties_and_one_very_common_vector(spark, monkeypatch):
    monkeypatch.setattr(h, "CHUNK", 64)
    rows = vectors(300, dim=3)
    rows += [(100 * i if i % 5 == 0 else 10_000 + i, [1.0, 2.0, 2.0], i % 2) for i in range(400)]
    assert mined(spark, rows) == plain(rows)


def test_defined_cases(spark):
    rows = vectors(60, dim=4, step=20) + [
        (None, [1.0] * 4, 1), (100_000, None, 1), (100_100, [1.0, None, 1.0, 1.0], 1), (100_200, [float("nan")] * 4, 1), (100_300, [float("inf")] * 4, 1),
        (100_400, [1.0] * 4, None), (100_500, [0.0] * 4, 1), (100_600, [], 1), (100_601, [], 1), (100_603, [], 2), (100_700, [1.0, 2.0], 0),
        (100_701, [1.0, 2.0], 0), (100_702, [1.0, 1.9], 1), (-100, [2.0] * 4, 2), (200, [-1.0] * 4, 2), (2**60 * 2 + 4, [2.0] * 4, 1),
    ]
    rows = [r for i, r in enumerate(rows) if r[0] is None or r[0] not in {x[0] for x in rows[:i]}]
    assert mined(spark, rows + rows[:20]) == plain(rows)
    assert mined(spark, []) == []
    assert mined(spark, [(100, [1.0], 1)]) == []
    wide = [(v, x, label, 7, "c") for v, x, label in vectors(200, step=25)]
    assert mined(spark, wide, SCHEMA + ", dim int, cluster string") == plain([r[:3] for r in wide])


def test_large_components_stay_exact(spark):
    rows = [(100 * i if i < 3 else i, [200_000.0 + i, -150_000.0 + 3 * i, 7.0], i % 2) for i in range(60)]
    assert mined(spark, rows) == plain(rows)


def test_walks_end_early():
    rng = np.random.default_rng(3)
    labels = np.zeros(4000, dtype=np.int64)
    vectors = np.rint(rng.normal(size=(4000, 4)) * 200)
    center, widest, lengths = h._cluster_of(vectors[:1])
    lists = h.Candidates(np.arange(4000), labels, vectors, center, widest)
    kept = []
    seen = h.walk(
        np.array([0]), labels[:1], vectors[:1], lists, lengths, True, lambda m, s, n: kept.extend(s.tolist()),
        lambda m: sorted(kept)[-5] if len(kept) >= 5 else -np.inf,
    )
    assert seen < 4000 and sorted(kept)[-5:] == sorted((vectors @ vectors[0]).tolist())[-5:]
