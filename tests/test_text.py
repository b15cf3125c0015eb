import html
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mentionkit.functions.entities import decode_entities
from mentionkit.functions.text import clean_text, first_filled, strip


def plain_clean(text, markdown=False):
    """A scanner over characters: at each opening sign, look for what closes it; no patterns."""
    rest, out = html.unescape(text or ""), ""
    while rest:
        end = rest.find(">", 1)
        if rest[0] == "<" and end > 1:
            out, rest = out + " ", rest[end + 1 :]
        else:
            out, rest = out + rest[0], rest[1:]
    if markdown:
        rest, out = out, ""
        while rest:
            label = rest.find("]", 1)
            target = rest.find(")", label + 2) if rest[0] == "[" and label > 1 and rest[label + 1 : label + 2] == "(" else -1
            if target > label + 2:
                out, rest = out + rest[1:label], rest[target + 1 :]
            else:
                out, rest = out + rest[0], rest[1:]
        out = "".join(c for c in out if c not in "*_~`")
    return " ".join(out.split()) or None


def _map(spark, texts, expression):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    return [r["x"] for r in df.select("i", expression(F.col("text")).alias("x")).orderBy("i").collect()]


CASES = [
    (None, None), ("", None), (" ", None), ("<p></p>", None),
    ("a&amp;b", "a&b"),
    ("&lt;i&gt;x&lt;/i&gt;", "x"),
    ("&amp;lt;", "&lt;"),
    ("x&nbsp;&nbsp;y", "x y"),
    ("1 < 2 and 3 > 2", "1 2"),
    ("a <b\nc> d", "a d"),
    ("a < b", "a < b"),
    ("[site](http://h) **b**", "[site](http://h) **b**"),
    ("one\ntwo", "one two"), ("one \n two", "one two"), ("  x\x1c y\t", "x y"),
    (" ", None), ("tab\tend\n", "tab end"), ("a  b", "a b"), ("a b", "a b"),
]


def test_clean_text(spark):
    assert _map(spark, [t for t, _ in CASES], clean_text) == [w for _, w in CASES]
    assert [plain_clean(t) for t, _ in CASES] == [w for _, w in CASES]


def test_markdown(spark):
    texts = ["[site](http://h) **b**", "snake_case `x` ~y~", "[a][b](c)", "&ast;x&ast;", "[x]", None]
    clean = lambda c: clean_text(c, markdown=True)
    assert _map(spark, texts, clean) == [plain_clean(t, markdown=True) for t in texts]


def test_references_equal_the_standard_library(spark):
    names = list(html.entities.html5)
    texts = [f"a&{n}b &{n}" for n in names] + [f"&{n.rstrip(';')}it;" for n in names]
    numbers = [*range(0x100), 0x80, 0x9F, 0xD800, 0xDFFF, 0xFDD0, 0xFFFE, 0x1F600, 0x10FFFF, 0x110000, 2**31, 10**12, 10**30]
    texts += [f"&#{n};x" for n in numbers] + [f"&#x{n:X};x" for n in numbers] + [f"&#X000{n:x}z" for n in numbers]
    texts += ["&", "&&", "& amp;", "&#;", "&#x;", "&#xg;", "&;", "&notit;", "&notin;", "&ampamp;", "&am", "x&amp", "&" + "a" * 40 + ";", "&#00065", ""]
    assert _map(spark, texts, decode_entities) == [html.unescape(t) for t in texts]


ALPHABET = ["&", "amp", "lt", "nbsp", ";", "#", "x41", "65", "<", ">", "b", " ", "\n", "\t", " ", " ", "\x1f", "\x85", "[", "]", "(", ")", "*", "_", "~", "`", "é", "😀"]


@pytest.mark.parametrize("markdown", [False, True])
def test_generated_strings(spark, markdown):
    rng = random.Random(11)
    texts = ["".join(rng.choices(ALPHABET, k=rng.randint(0, 14))) for _ in range(3000)]
    got = _map(spark, texts, lambda c: clean_text(c, markdown))
    wrong = [(t, g, plain_clean(t, markdown)) for t, g in zip(texts, got) if g != plain_clean(t, markdown)]
    assert wrong == []


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"], exclude_characters="\x00"), max_size=30), min_size=20, max_size=60))
def test_arbitrary_text(spark, texts):
    assert _map(spark, texts, clean_text) == [plain_clean(t) for t in texts]


def test_small_helpers(spark):
    rows = [("", None, "t"), (None, "s", "t"), ("c", "s", "t"), ("", "", "")]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    assert [r[0] for r in df.select(first_filled(F.col("a"), F.col("b"), F.col("c"))).collect()] == ["t", "s", "c", ""]
    assert _map(spark, ["\n x  ", " "], strip) == ["x", ""]
