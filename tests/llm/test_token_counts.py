import random

import pytest

from mentionkit.llm import token_counts as t

TEXTS = [None, "", "hello world", "hello world", "don't  stop\n\nnow 123", "é𝒳 <|endoftext|>", "a" * 50_000, "x y " * 3000]


def test_against_plain_counts(spark):
    random.seed(9)
    texts = TEXTS + ["word " * random.randrange(0, 3000) for _ in range(60)]
    docs = spark.createDataFrame([(x, 1) for x in texts], "text string, docs int")
    encode = t._encoding(t.VOCABULARY, t.PATTERN).encode_ordinary
    lengths = [len(encode(x or "")) for x in texts]
    sums = t.length_report(docs).cache()
    rows = {r["length"]: r for r in sums.collect()}
    assert set(rows) == set(lengths)
    for length, r in rows.items():
        assert r["docs"] == lengths.count(length)
        assert r["docs_from"] == sum(x >= length for x in lengths)
        assert r["tokens_from"] == sum(x for x in lengths if x >= length)
        assert r["truncated_total"] == sum(min(x, length) for x in lengths)
        assert r["quantile"] == pytest.approx(sum(x <= length for x in lengths) / len(lengths))
        assert (r["total_docs"], r["total_tokens"]) == (len(lengths), sum(lengths))
    limits = [0, 1, 7, 1024, 2048, max(lengths), 10**6]
    for r in t.answers(sums, limits).collect():
        fit = sum(x <= r["limit"] for x in lengths)
        kept = sum(min(x, r["limit"]) for x in lengths)
        assert (r["docs_that_fit"], r["truncated_total"], r["tokens_lost"]) == (fit, kept, sum(lengths) - kept)


def test_two_libraries_agree(spark):
    """The rank file and the same vocabulary read by another library give equal lengths."""
    from tokenizers import Tokenizer

    other = Tokenizer.from_file(t.VOCABULARY.replace(".tiktoken", ".json"))
    other.encode_special_tokens = True
    encode = t._encoding(t.VOCABULARY, t.PATTERN).encode_ordinary
    for x in TEXTS[1:6]:
        assert len(encode(x)) == len(other.encode(x, add_special_tokens=False).ids)


def test_empty_table(spark):
    assert t.length_report(spark.createDataFrame([], "text string")).count() == 0
