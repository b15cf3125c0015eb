import random
from itertools import combinations

import numpy as np
import pytest

from mentionkit.llm import minhash
from tests.llm.test_simhash import groups

SCHEMA = "doc_id long, text string"


def plain_set(text):
    words = (text or "").encode().lower().split()
    if len(words) < 2:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(zip(words, words[1:]))


def plain_report(rows):
    sets = [plain_set(t) for _, t in rows]
    near = lambda a, b: a and b and 100 * len(a & b) >= 80 * len(a | b)
    roots = groups([(i, j) for i, j in combinations(range(len(rows)), 2) if near(sets[i], sets[j])], range(len(rows)))
    members = {}
    for i, (doc, _) in enumerate(rows):
        members.setdefault(roots[i] if sets[i] else ("own", i), []).append(doc)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [d for d in members[roots[i] if sets[i] else ("own", i)] if d is not None]
        component = doc if not sets[i] else min(ids, default=None)
        out.append((doc, len(sets[i]), component, doc == component))
    return out


def report(spark, rows, schema=SCHEMA):
    df = minhash.near_groups(spark.createDataFrame(rows, schema))
    assert df.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    return [tuple(r) for r in df.collect()]


def same(spark, rows):
    assert sorted(report(spark, rows), key=repr) == sorted(plain_report(rows), key=repr)


def changed(words, k, rng, at=None):
    words = list(words)
    for i in at or rng.sample(range(len(words)), k):
        words[i] = f"new{rng.randrange(10**9)}"
    return " ".join(words)


def test_sizes_and_similarities(spark):
    rng, rows = random.Random(5), []
    for size in (1, 2, 3, 5, 10, 20, 40, 52, 60, 64, 65, 70, 80, 120, 400, 3000):
        base = [f"w{rng.randrange(50_000)}" for _ in range(size)]
        rows.append(" ".join(base))
        rows += [changed(base, k, rng) for k in {0, 1, size // 30, size // 20, size // 18, size // 16, size // 10} if k <= size]
    same(spark, list(enumerate(rows)))


def test_common_passage_and_crowded_group(spark):
    rng = random.Random(6)
    passage = " ".join(f"p{i}" for i in range(60))
    base = [f"g{i}" for i in range(140)]
    rows = [" ".join(base)] + [changed(base, rng.choice([2, 4, 6, 9, 12, 15]), rng) for _ in range(200)]
    rows += [passage + " " + " ".join(f"q{rng.randrange(10**6)}" for _ in range(rng.randrange(5, 30))) for _ in range(120)]
    rows += [" ".join(rng.choice("abcdef") for _ in range(rng.randrange(1, 12))) for _ in range(200)]
    same(spark, list(enumerate(rows)))


def test_defined_cases(spark):
    rows = [
        (3, None), (4, ""), (5, " \t\n"), (7, "Word"), (6, "wORD"), (6, "other text here"), (None, "other text here"), (None, "lonely null id"),
        (9, "a a a a a"), (8, "a a"), (8, "a a"), (2**60 + 1, "ids stay whole"), (2**60 + 3, "ids stay whole"), (10, "É b"), (11, "é b"),
    ]
    same(spark, rows)
    assert report(spark, []) == []
    wide = [(1, "x", "one two", 5), (2, "y", "one  two", 6)]
    assert sorted(report(spark, wide, "doc_id long, set string, text string, value int")) == [(1, 1, 1, True), (2, 1, 1, False)]


def test_very_long_texts(spark):
    rng = random.Random(7)
    base = [f"v{rng.randrange(10**6)}" for _ in range(60_000)]
    rows = [(1, " ".join(base)), (2, changed(base, 5_000, rng)), (3, changed(base, 9_000, rng)), (4, "la " * 200_000)]
    same(spark, rows)


def test_tiles_find_all_links_between_groups(spark, monkeypatch):
    monkeypatch.setattr(minhash, "SHORT_LIST", 2)
    monkeypatch.setattr(minhash, "TILE_SETS", 16)
    rng = random.Random(8)
    base = [f"g{i}" for i in range(100)]
    same(spark, list(enumerate([changed(base, rng.choice([0, 3, 6, 10]), rng) for _ in range(150)])))


def test_overlaps():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60 if i % 3 else 9, rng.integers(0, 40))) for i in range(60)]
    got = minhash.overlaps(sets[:25], sets[25:])
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in sets[25:]] for a in sets[:25]]
    assert minhash.overlaps([], sets).shape == (0, 60)


@pytest.mark.parametrize("sketch", [16, 64])
def test_prefix_meets_every_partner(spark, sketch):
    """Whole sets within the sketch: the computed part of the order is enough for any pair at the limit."""
    rng = random.Random(sketch)
    frame = spark.range(1, 4 * sketch).select("id", minhash._prefix(minhash.F.col("id").cast("int"), sketch, 80).alias("p"))
    prefix = {r["id"]: r["p"] for r in frame.collect()}
    assert all(1 <= p <= min(n, sketch) for n, p in prefix.items())
    for _ in range(3000):
        n = rng.randrange(1, sketch + 1)
        m = rng.randrange(n, sketch + 1)
        shared = -(-80 * (n + m) // 180)
        if shared <= n and 100 * shared >= 80 * (n + m - shared):
            assert (prefix[n] - 1) + 1 > n - shared and prefix[m] > m - shared
