import random
import re
import time

import numpy as np

from mentionkit.llm import decontamination as d


def plain_tiles(item, doc):
    """Greedy tiling by trying every pair of places, over words."""
    a, b, out = [False] * len(item), [False] * len(doc), []
    while True:
        best = None
        for i in range(len(item)):
            for j in range(len(doc)):
                k = 0
                while i + k < len(item) and j + k < len(doc) and not a[i + k] and not b[j + k] and item[i + k] == doc[j + k]:
                    k += 1
                if k >= min(5, len(item)) and k and (best is None or k > best[2]):
                    best = (i, j, k)
        if best is None:
            return out
        out.append(best)
        for k in range(best[2]):
            a[best[0] + k] = b[best[1] + k] = True


def words(text):
    return re.findall(r"\w+", (text or "").lower())  # no unspaced scripts in these


def plain(docs, bench, least):
    best = {}
    for doc_id, text in docs:
        for item_id, item in bench:
            w = words(item)
            found = plain_tiles(w, words(text))
            if found and sum(t[2] for t in found) / len(w) >= least:
                c = sum(t[2] for t in found) / len(w)
                best[doc_id, item_id] = max(c, best.get((doc_id, item_id), 0))
    return {k: round(v, 9) for k, v in best.items()}


def frames(spark, docs, bench):
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")


def got(df):
    return {(r["doc_id"], r["item_id"]): round(r["coverage"], 9) for r in df.collect()}


def test_against_brute_force(spark):
    random.seed(11)
    vocabulary = ["the", "of", "and", "to", "in", "a", "é", "x1"] + [f"w{i}" for i in range(30)]
    text = lambda n: random.choices(vocabulary, k=n)
    bench = [(i, " ".join(text(random.randrange(3, 40)))) for i in range(12)] + [(50, None), (51, ""), (52, "a a a a a a a a a a")]
    docs = []
    for i in range(40):
        w = text(random.randrange(0, 60))
        item = words(bench[i % 12][1])
        if i % 2:  # passages, whole or cut into parts in another order
            cuts = sorted(random.sample(range(len(item) + 1), min(2, len(item))))
            parts = [item[: cuts[0]], item[cuts[0] : cuts[-1]], item[cuts[-1] :]] if i % 4 == 1 else [item]
            random.shuffle(parts)
            for p in parts:
                w += p + text(2)
        docs.append((i, ", ".join(w).upper() if i % 3 == 0 else " ".join(w)))
    docs += [(100, None), (101, ""), (102, "a " * 300), (7, docs[9][1]), (9, docs[9][1])]
    d_, b_ = frames(spark, docs, bench)
    for least in (0.01, d.COVERAGE):
        assert got(d.contaminated(d_, b_, least)) == plain(docs, bench, least)


def test_reordered_passage_is_caught_and_clean_text_is_not(spark):
    item = "one two three four five six. seven eight nine ten eleven twelve. red green blue white black grey"
    parts = item.split(". ")
    docs = [(1, f"{parts[2]}; {parts[0]} and then {parts[1]}"), (2, "one two three four and nothing else of it"), (3, item)]
    assert got(d.contaminated(*frames(spark, docs, [(9, item)]))) == {(1, 9): 1.0, (3, 9): 1.0}


def test_clean_documents_keep_their_columns(spark):
    item = " ".join(f"w{i}" for i in range(20))
    rows = [(1, item, "a", 1), (2, "clean", None, 2), (2, "clean", None, 2), (None, "no id", "b", 3), (4, None, "c", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, coverage string, seed int")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    out = d.clean_documents(docs, bench)
    assert out.columns == docs.columns
    assert sorted(map(tuple, out.collect()), key=str) == sorted(rows[1:], key=str)


def test_empty_tables(spark):
    docs, bench = frames(spark, [], [])
    some, item = frames(spark, [(1, "a b c d e f")], [(1, "a b c d e f")])
    assert got(d.contaminated(docs, item)) == {} and got(d.contaminated(some, bench)) == {}


def test_full_bit_table_changes_nothing(spark, monkeypatch):
    """The table only saves work: with two places it lets all seeds through, with the same result."""
    docs, bench = frames(spark, [(1, "a b c d e f g"), (2, "x y z u v w a")], [(1, "a b c d e f g")])
    want = got(d.contaminated(docs, bench))
    monkeypatch.setattr(d, "TABLE_BITS", 1)
    assert got(d.contaminated(docs, bench)) == want == {(1, 1): 1.0}


def test_items_of_few_words_and_scripts_without_spaces(spark):
    """An item of fewer than five words matches where all of it stands; characters of unspaced scripts are words."""
    bench = [(1, "Tokyo tower"), (2, "one"), (3, "今日は天気がいいですね"), (4, "สวัสดีครับ"), (5, "...")]
    docs = [(1, "the Tokyo, tower is tall"), (2, "tower Tokyo"), (3, "彼は今日は天気がいいですねと言った"), (4, "One!"), (5, "สวัสดีครับ"), (6, None)]
    assert set(got(d.contaminated(*frames(spark, docs, bench)))) == {(1, 1), (4, 2), (3, 3), (5, 4)}


def test_repetitive_texts_are_tiled_in_proportion():
    five = [f"r{i}" for i in range(5)]
    cache = {}
    item, doc = d.seeds(five * 4000, cache), d.seeds(five * 4000, cache)
    began = time.time()
    assert d.tiles(item, np.arange(len(doc)), doc) == [(0, 0, 20_000)]
    assert time.time() - began < 5


def test_ids_of_any_type_come_back_unchanged(spark):
    text = " ".join(f"w{i}" for i in range(9))
    docs = spark.createDataFrame([(2**60 + 1, text), (None, text), (2**60 + 3, "clean")], "doc_id long, text string")
    bench = spark.createDataFrame([("item-é", text), (None, text)], "item_id string, text string")
    out = d.contaminated(docs, bench)
    assert out.schema["doc_id"].dataType.simpleString() == "bigint" and out.schema["item_id"].dataType.simpleString() == "string"
    assert sorted(map(str, got(out))) == sorted(map(str, {(a, b) for a in (2**60 + 1, None) for b in ("item-é", None)}))


def test_very_long_text_with_one_passage(spark):
    item = " ".join(f"q{i}" for i in range(40))
    long = "lorem ipsum dolor sit amet " * 60_000
    assert got(d.contaminated(*frames(spark, [(1, f"{long}{item} {long}"), (2, long)], [(1, item)]))) == {(1, 1): 1.0}
