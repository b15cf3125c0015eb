import corpus_pipeline as p
from mentionkit.llm import decontamination, simhash


def test_missing_and_shared_ids_lose_no_group(spark):
    text = {k: " ".join(f"{k}{i}" for i in range(60)) for k in "abcdef"}
    rows = [(None, "a"), (None, "b"), (None, "b"), (3, "c"), (5, "c"), (5, "d"), (5, "e"), (7, "f"), (7, "f"), (None, "f")]
    docs = spark.createDataFrame([(i, text[k], j) for j, (i, k) in enumerate(rows)], "doc_id long, text string, n int")
    for out in (p.near_duplicates(spark, docs, ""), simhash.one_per_group(docs)):
        assert out.columns == docs.columns
        got = sorted((r["text"][0], r["doc_id"]) for r in out.collect())
        assert got == [("a", None), ("b", None), ("c", 3), ("d", 5), ("e", 5), ("f", 7)]


def test_leaks_are_judged_by_row(spark):
    item, clean = " ".join(f"q{i}" for i in range(30)), " ".join(f"z{i}" for i in range(30))
    docs = spark.createDataFrame([(None, item), (None, clean), (4, item), (4, clean), (5, None)], "doc_id long, text string")
    out = decontamination.clean_documents(docs, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert sorted(map(str, out.collect())) == sorted(map(str, docs.where("text is null or text like 'z0%'").collect()))
