import random
from itertools import combinations

import pytest
import xxhash

from mentionkit.llm import simhash
from mentionkit.llm.components import components


def plain_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(c, " ")
    words = [w for w in lowered.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(pairs, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def plain_report(rows):
    prints = [(d, plain_fingerprint(t)) for d, t in rows]
    values = sorted({f for _, f in prints})
    root = groups([(a, b) for a, b in combinations(values, 2) if (a ^ b).bit_count() <= 3], values)
    least = {}
    for d, f in prints:
        least[root[f]] = min(d, least.get(root[f], d))
    return sorted((d, f"{f:016x}", least[root[f]]) for d, f in prints)


def test_against_brute_force(spark):
    random.seed(3)
    vocabulary = [f"w{i}" for i in range(300)] + ["É", "ß", "𝒳"]
    base = [" ".join(random.choices(vocabulary, k=400)) for _ in range(6)]
    rows = [(900, None), (901, ""), (902, " \t\n"), (903, "One"), (904, "one two"), (905, "a\u00a0b\u0085c\x1cd e"), (906, "TWO  words\nmore\x0b!")]
    for i, text in enumerate(base):
        for j in range(8):
            words = text.split()
            for _ in range(j):
                words[random.randrange(len(words))] = random.choice(vocabulary)
            rows.append((i * 10 + j, " ".join(words)))
    rows += [rows[8], (903, "One")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, fp string")
    assert sorted(map(tuple, simhash.group_report(docs).collect())) == plain_report(rows)


def test_whole_table_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    assert sorted(map(tuple, simhash.group_report(docs).collect())) == plain_report(rows)


def test_long_text():
    text = "alpha beta gamma delta " * 50_000
    assert simhash.fingerprint(text.encode()) % (1 << 64) == plain_fingerprint(text)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.group_report(docs).collect() == []
    assert simhash.one_per_group(docs).collect() == []


@pytest.mark.parametrize("mask", [0, simhash.finer(0)[3], simhash.finer(simhash.finer(0)[3])[11]])
def test_close_pairs_share_a_finer_block(mask):
    random.seed(mask % 97)
    masks = simhash.finer(mask)
    open_bits = [b for b in range(64) if not mask >> b & 1]
    for _ in range(500):
        a = random.getrandbits(64)
        b = a
        for bit in random.sample(open_bits, 3):
            b ^= 1 << bit
        assert any(a & m == b & m for m in masks)


def test_last_level_is_bounded():
    assert all(64 - m.bit_count() <= 12 for m in simhash._levels(3)[-1])
    assert 1 << 12 <= simhash.BLOCK_MOST


def test_crowded_blocks_are_split(spark, monkeypatch):
    """Fingerprints that crowd one block, with a limit of eight: same groups as all pairs."""
    monkeypatch.setattr(simhash, "BLOCK_MOST", 8)
    monkeypatch.setattr(simhash, "_levels", lambda d: (lambda a: [a, (b := sorted({f for m in a for f in simhash.finer(m)})), sorted({f for m in b for f in simhash.finer(m)})])(simhash.finer(0)))
    random.seed(5)
    centre = random.getrandbits(64)
    values = {centre ^ (random.getrandbits(64) & random.getrandbits(64) & 0x3FFFF) for _ in range(150)}
    values |= {random.getrandbits(64) for _ in range(20)}
    signed = [(simhash._signed(v),) for v in values]
    found = simhash.links(spark.createDataFrame(signed, "fp long")).collect()
    pairs = [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in found]
    assert all((a ^ b).bit_count() <= 3 for a, b in pairs)
    close = [(a, b) for a, b in combinations(sorted(values), 2) if (a ^ b).bit_count() <= 3]
    assert groups(pairs, values) == groups(close, values)


def test_one_document_of_each_group_stays(spark):
    text = " ".join(f"w{i}" for i in range(200))
    rows = [(5, text, "a", 1), (3, text, "b", None), (3, text, "a", 2), (9, text + " end", "c", 3), (7, None, "d", 4), (8, "", None, 5), (1, "alone here now", "e", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string, n int")
    out = simhash.one_per_group(docs)
    assert out.columns == docs.columns
    kept = {simhash.hex_of}  # ids only
    kept = sorted(r["doc_id"] for r in out.collect())
    want = sorted({c for _, _, c in plain_report([(r[0], r[1]) for r in rows])})
    assert kept == want


def test_components(spark):
    random.seed(7)
    chain = [(i, i + 1) for i in range(0, 60)]
    hub = [(1000, 1000 + i) for i in range(1, 80)]
    loose = [(random.randrange(2000, 2100), random.randrange(2000, 2100)) for _ in range(60)]
    edges = chain + hub + loose + [(5, 5), (3000, 3000)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    assert got == groups([e for e in edges if e[0] != e[1]], nodes)
