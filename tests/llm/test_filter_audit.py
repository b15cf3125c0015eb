import random
from collections import Counter
from itertools import permutations

from mentionkit.llm import filter_audit as f

DOCS = "doc_id long, text string, lang string"
LABELS = "doc_id long, quality int, toxic int"
NAMES = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def plain(docs, labels):
    least = {}
    for doc, text, _ in docs:
        if doc is not None:
            least[text or ""] = min(least.get(text or "", doc), doc)
    good, toxic = ({d for d, *x in labels if x[k] == 1} for k in (0, 1))
    fails = []
    for doc, text, lang in docs:
        text = text or ""
        words = text.encode().split()
        bad = [len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text)]
        bad += [any(c in "#$%&*|" for c in text), doc is not None and doc > least[text]]
        fails.append((lang or "", {n for n, b in zip("ABCDE", bad) if b}, doc in good, doc in toxic))
    out, shapley = {}, Counter()
    for part in {p for p, *_ in fails}:
        for order in permutations("ABCDE"):
            for k, name in enumerate(order):
                c = Counter()
                for _, bad, g, t in (x for x in fails if x[0] == part):
                    before = bad & set(order[:k])
                    c["kept"] += not before and name not in bad
                    gone = name in bad and not before
                    c["removed"] += gone
                    c["redundant"] += name in bad and bool(before)
                    c["unique"] += bad == {name}
                    c["good"] += gone and g
                    c["toxic"] += gone and t
                shapley[part, name] += c["removed"]
                out[part, "".join(order), k + 1] = [c[x] for x in ("kept", "removed", "redundant", "unique", "good", "toxic")]
    return sorted((*key, *row, shapley[key[0], key[1][key[2] - 1]]) for key, row in out.items())


def audited(spark, docs, labels, schema=DOCS):
    df = f.audit(spark.createDataFrame(docs, schema), spark.createDataFrame(labels, LABELS))
    assert df.columns == NAMES
    return sorted(tuple(r) for r in df.collect())


def documents(n=120):
    rng, rows = random.Random(4), []
    for i in range(n):
        words = [rng.choice(["alpha", "Beta", "gamma", "d$", "eps", f"w{rng.randrange(400)}"]) for _ in range(rng.choice([5, 199, 200, 260]))]
        text = rng.choice(["common start " * 40, ""]) + " ".join(words)
        rows.append((1000 + 3 * i, text, rng.choice(["en", "de", None, ""])))
    return rows + [(rng.randrange(2000), rng.choice(rows)[1], "en") for _ in range(n)]


def test_brute_force(spark):
    docs = documents()
    labels = [(d, i % 3 - 1, i % 2) for i, (d, *_) in enumerate(docs) if i % 2] + [(docs[0][0], 1, None), (None, 1, 1), (77_777, 1, 1)]
    got = audited(spark, docs, labels)
    assert got == plain(docs, labels) and any(r[4] and "E" in r[1] for r in got)


def test_small_tries_and_crowded_prefixes(spark, monkeypatch):
    monkeypatch.setattr(f, "TRIE_BYTES", 500)
    monkeypatch.setattr(f, "PREFIXES", (2, 8, 64))
    docs = documents(60)
    assert audited(spark, docs, []) == plain(docs, [])


def test_defined_cases(spark):
    long = "word " * 300_000
    docs = [
        (1, None, "en"), (2, "", "en"), (None, "", "en"), (None, "solo", None), (None, "solo", None), (5, "same", "x"), (5, "same", "x"), (5, "other", "x"),
        (2**60 + 1, "big", "en"), (2**60 + 3, "big", "en"), (7, long, "en"), (8, long, "en"), (9, long + "end", "en"), (10, "pre", "en"), (11, "prefix", "en"),
        (12, "pre", "en"),
    ]
    assert audited(spark, docs, [(8, 1, 1)]) == plain(docs, [(8, 1, 1)])
    assert audited(spark, [], [(1, 1, 1)]) == []
    wide = [(d, t, lang, 1, "m") for d, t, lang in docs]
    assert audited(spark, wide, [], DOCS + ", mask int, hash string") == plain(docs, [])


def test_trie_holds_least_ids():
    rng, trie, want = random.Random(2), f.Trie(), {}
    for _ in range(3000):
        text, doc = "".join(rng.choice("ab") for _ in range(rng.randrange(9))), rng.randrange(10**6)
        trie.insert(text, doc, hash(text))
        want[text] = min(want.get(text, doc), doc)
    assert {t: m for t, m, _ in trie.ends()} == want


def test_a_task_hands_on_one_row_per_text(spark):
    docs = spark.createDataFrame([(i, "one text of many copies", "en") for i in range(5000)], DOCS).coalesce(3)
    rows = docs.select(f.F.col("doc_id").cast("string").alias("doc_id"), f.F.col("lang").alias("part"), f.F.lit(1).cast("long").alias("hash"), "text")
    assert rows.mapInPandas(f._read, f._READ).where("text IS NOT NULL").count() <= 3
