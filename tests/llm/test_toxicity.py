import random
import zlib

import pytest

from mentionkit.llm import toxicity


def plain_segments(scores, lo=0, hi=None):
    """All maximal segments by definition: the greatest of the range (the shortest of equals), then left and right of it."""
    hi = len(scores) if hi is None else hi
    best = None
    for i in range(lo, hi):
        total = 0
        for j in range(i, hi):
            total += scores[j]
            if total > 0 and (best is None or total > best[0] or (total == best[0] and j + 1 - i < best[2] - best[1])):
                best = (total, i, j + 1)
    if best is None:
        return []
    return plain_segments(scores, lo, best[1]) + [best] + plain_segments(scores, best[2], hi)


def test_segments_against_definition():
    random.seed(1)
    for _ in range(300):
        scores = [random.choice([-3, -2, -1, 1, 2, 4]) + random.random() / 7 for _ in range(random.randrange(0, 25))]
        got = [(round(s, 9), a, b) for s, a, b in toxicity.segments(scores)]
        assert got == [(round(s, 9), a, b) for s, a, b in plain_segments(scores)]


def auc(pairs):
    order = sorted(pairs)
    ranks, i = 0.0, 0
    while i < len(order):
        j = i
        while j < len(order) and order[j][0] == order[i][0]:
            j += 1
        ranks += sum(y for _, y in order[i:j]) * (i + j + 1) / 2
        i = j
    pos = sum(y for _, y in order)
    return (ranks - pos * (pos + 1) / 2) / (pos * (len(order) - pos))


@pytest.fixture(scope="module")
def tables(spark):
    sf = "/root/testdata/sf0.1"
    return spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")


def test_held_out_rows(spark, tables):
    docs, labels = tables
    rows = toxicity.toxicity_report(docs, labels).join(labels, "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    out = [(r["score"], r["toxic"], r["predicted"]) for r in rows if r["held_out"]]
    assert auc([(s, y) for s, y, _ in out]) > 0.95
    hits = sum(y and p for _, y, p in out)
    assert hits / sum(y for _, y, _ in out) > 0.85
    assert hits / sum(p for _, _, p in out) > 0.9


def test_held_out_labels_are_not_read(spark, tables):
    """Turning every held-out label round changes no score."""
    docs, labels = tables
    docs = docs.where("doc_id < 2000")
    turned = labels.withColumn("toxic", toxicity.F.when(toxicity.held_out(toxicity.F.col("doc_id")), 1 - toxicity.F.col("toxic")).otherwise(toxicity.F.col("toxic")))
    a = {r["doc_id"]: r["score"] for r in toxicity.toxicity_report(docs, labels).collect()}
    b = {r["doc_id"]: r["score"] for r in toxicity.toxicity_report(docs, turned).collect()}
    assert a == pytest.approx(b)


def test_passages_are_located(spark, tables):
    docs, labels = tables
    model = toxicity.fit(docs, labels)
    text = "the of and to in is that with " * 30
    at = len(text)
    text += "idiot moron scum loser " + "the of and to in is that with " * 30
    found = toxicity.passages(model, text)
    assert len(found) == 1 and found[0][0] == at and text[found[0][0] : found[0][1]] == "idiot moron scum loser"
    assert toxicity.passages(model, "") == []


def test_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, 5), (2, "", 6), (2, "", 6), (None, "words here", 7), (3, "x" * 200_000, 8)], "doc_id long, text string, score int")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = toxicity.toxicity_report(docs, none).collect()
    assert len(rows) == 5 and all(r["score"] == 0 and r["predicted"] == 0 for r in rows)
    assert toxicity.toxicity_report(docs.where("false"), none).count() == 0
    train = [(i, "vile words" if i % 2 else "kind words") for i in range(300)]
    labels = spark.createDataFrame([(i, None, i % 2) for i in range(300)], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity_report(spark.createDataFrame(train, "doc_id long, text string").unionByName(docs.select("doc_id", "text")), labels).collect()
    assert len(got) == 305 and all(0 <= r["score"] <= 1 for r in got)


def test_a_clean_word_under_a_toxic_stem_keeps_its_score(spark):
    rows = [("cock", 50, 50), ("cockpit", 100, 10), ("cockpits", 40, 0), ("plain", 3000, 300)]
    words = spark.createDataFrame(rows, "w string, n long, k long")
    model = toxicity._scored(words, 0.12)
    cock, pit, pits, plain = (model.scores([w])[0] + toxicity.DRIFT for w in ("cock", "cockpit", "cockpits", "plain"))
    assert cock > 2 and abs(pit) < 0.3 and pits < 0 and -0.3 < plain < 0


def test_clean_words_of_the_learned_table(spark):
    """A word often seen and never toxic is not scored by a toxic stem."""
    rows = [(i, "grimface grim" if i % 10 == 0 else "grimsby harbour and quay" if i % 10 < 5 else "harbour and quay") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, None, int(i % 10 == 0)) for i in range(600)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels)
    grim, sby = model.scores(["grim"])[0], model.scores(["grimsby"])[0]
    assert grim > 0 and sby < -toxicity.DRIFT


def test_a_full_model_drops_whole_families(spark, monkeypatch):
    rows = [("cock", 50, 50), ("cockpit", 100, 10), ("vile", 9, 9), ("vilely", 8, 1)]
    words = spark.createDataFrame(rows, "w string, n long, k long")
    whole = toxicity._scored(words, 0.12)
    monkeypatch.setattr(toxicity, "VOCABULARY", len(whole.words) + len(whole.stems) - 1)
    cut = toxicity._scored(words, 0.12)
    first = lambda d: {w: s for w, s in d.items() if w.startswith("cock")}
    assert cut.words == first(whole.words) and cut.stems == first(whole.stems)


def test_the_driver_holds_columns_only(spark, tables):
    """What is learned is kept and sent as columns; a dictionary of its words is made in the tasks."""
    docs, labels = tables
    learned = toxicity._fit(docs.where("doc_id < 3000"), labels)
    assert not learned.curve.words and not learned.curve.stems
    model = learned.model()
    assert len(model.words) == learned.words.num_rows > 0 and len(model.stems) == learned.stems.num_rows > 0
    entries = len(model.words) + len(model.stems)
    assert learned.words.nbytes + learned.stems.nbytes < 40 * entries
    opened = toxicity._Opened(learned)
    assert opened.model().words == model.words and opened.model() is opened.model()
