import random

import pytest
from pyspark.sql import functions as F

from mentionkit.catalog import AI_TOOLS, Entity, EntityCatalog
from mentionkit.functions import matching
from mentionkit.functions.matching import contains_any, explode_matches, with_matches
from mentionkit.operators import containment
from mentionkit.operators.containment import alias_hits, mentions_by_table, possible_anchors

CASES = [
    # strong aliases need no context
    ("My team moved to ChatGPT for reviews.", ["ChatGPT"]),
    ("Opened claude.ai this morning.", ["Claude"]),
    ("The cursor IDE completes whole lines.", ["Cursor"]),
    ("CHATGPT in capitals", ["ChatGPT"]),
    # weak aliases need context
    ("a lovable puppy", []),
    ("Lovable, an AI app builder, made my shop page", ["Lovable"]),
    ("we went windsurfing on Sunday", []),
    ("Windsurf is the coding assistant I keep", ["Windsurf"]),
    ("Gemini 1 flew two crews, a model of planning", []),
    ("to my perplexity the proof was short", []),
    # an exclusion phrase blocks the whole text
    ("Claude Shannon coined the bit.", []),
    ("Claude Shannon, machine learning and ChatGPT", []),
    ("Claude Monet painted ponds", []),
    # several at once, each once, sorted
    ("Gemini or Claude or ChatGPT, which AI?", ["ChatGPT", "Claude", "Gemini"]),
    ("ChatGPT, ChatGPT and ChatGPT", ["ChatGPT"]),
    # nothing
    ("", []),
    (None, []),
    ("   ", []),
    ("bread, milk and eggs", []),
    # substrings count, also inside words
    ("send an email about Claude", ["Claude"]),
    ("fresh cursor ideas", ["Cursor"]),
    # known gap: an unrelated AI feature is context enough
    ("lovable keys, and the app has an AI helper", ["Lovable"]),
]


def _match(spark, texts, catalog, **options):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    return [r["matched_tools"] for r in with_matches(df, F.col("text"), catalog, **options).orderBy("i").collect()]


def test_default_catalog(spark):
    got = _match(spark, [t for t, _ in CASES], AI_TOOLS)
    assert got == [want for _, want in CASES]


def test_alias_across_title_and_text(spark):
    df = spark.createDataFrame([("github", "copilot helps")], "title string, text string")
    matched = with_matches(df, F.concat_ws(" ", "title", "text"), AI_TOOLS).first()["matched_tools"]
    assert matched == ["GitHub Copilot"]


def test_word_boundary(spark):
    texts = ["send an email about Claude", "Claude, an AI", "fresh cursor ideas", "é-claude.ai."]
    assert _match(spark, texts, AI_TOOLS, word_boundary=True) == [[], ["Claude"], [], ["Claude"]]


def test_exclusions_per_entity(spark):
    texts = ["Claude Shannon and ChatGPT, both AI", "Claude Shannon, AI"]
    assert _match(spark, texts, AI_TOOLS, exclusion_scope="entity") == [["ChatGPT"], []]
    with pytest.raises(ValueError):
        _match(spark, texts, AI_TOOLS, exclusion_scope="post")


def brute_force(text, catalog):
    """Set algebra: the rows (tool, tier, alias) whose alias and tier are both among those that count."""
    lowered = (text or "").lower()
    rows = {(e.name, tier, alias) for e in catalog.entities for tier in ("strong", "weak") for alias in getattr(e, tier)}
    said = {w for w in {*catalog.context, *catalog.exclusions, *(alias for _, _, alias in rows)} if lowered.count(w)}
    tiers = {"strong"} | {"weak" for _ in said & set(catalog.context)}
    tools = {name for name, tier, alias in rows if alias in said and tier in tiers}
    return sorted(tools if said.isdisjoint(catalog.exclusions) else ())


def _random_texts(catalog, n):
    rng = random.Random(7)
    words = [*catalog.context, *catalog.exclusions, "and", "the", "Ärger", "x"]
    words += [a for e in catalog.entities for a in e.strong + e.weak]
    return [rng.choice([" ", ""]).join(rng.choices(words, k=rng.randint(0, 6))) for _ in range(n)]


def test_equals_brute_force(spark, monkeypatch):
    texts = _random_texts(AI_TOOLS, 400)
    want = [brute_force(t, AI_TOOLS) for t in texts]
    assert _match(spark, texts, AI_TOOLS) == want
    # needles as one literal array
    monkeypatch.setattr(matching, "MAX_CHAINED_NEEDLES", 1)
    assert _match(spark, texts, AI_TOOLS) == want


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_alias_table_equals_brute_force(spark, threshold):
    # a short alias, copies of a key, joins by broadcast and by shuffle
    catalog = EntityCatalog((*AI_TOOLS.entities, Entity("X", ("x",))), AI_TOOLS.context, AI_TOOLS.exclusions)
    texts = _random_texts(catalog, 200)
    rows = [(i // 2, t.lower()) for i, t in enumerate(texts)] + [(500, "the x")] * 50
    df = spark.createDataFrame(rows, "id int, lowered string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    lowered = F.col("lowered")
    got = mentions_by_table(
        df, ["id"], "lowered", catalog.aliases_df(spark),
        contains_any(lowered, catalog.context), contains_any(lowered, catalog.exclusions),
    )
    want = {(i, tool) for i, t in rows for tool in brute_force(t, catalog)}
    rows_got = [tuple(r) for r in got.collect()]
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert set(rows_got) == want and len(rows_got) == len(want)


def test_few_starts_of_a_text_reach_the_join(spark, monkeypatch):
    aliases = spark.createDataFrame([("A", "claude code", "strong"), ("B", "xy", "strong")], "tool string, alias string, tier string")
    anchored = aliases.withColumn("_anchor", F.left("alias", F.lit(6)))
    words = " ".join(f"word{i * 7919}" for i in range(500))
    texts = spark.createDataFrame([(1, words + " claude code"), (2, words), (3, ""), (4, None), (5, "claude cod xy")], "id int, lowered string")
    met = possible_anchors(texts, ["id"], "lowered", anchored, [2, 6]).collect()
    assert {("claude", 1), ("claude", 5), ("xy", 5)} <= {(r["_anchor"], r["id"]) for r in met} and len(met) <= 6
    want = {(1, "A"), (5, "B")}
    assert {(r["id"], r["tool"]) for r in alias_hits(texts, ["id"], "lowered", aliases).collect()} == want
    # a full table lets everything through, and the result is the same
    monkeypatch.setattr(containment, "TABLE_WORDS", 1)
    crowded = aliases.unionByName(spark.createDataFrame([("C", f"q{i:05d}", "strong") for i in range(2000)], aliases.schema))
    assert {(r["id"], r["tool"]) for r in alias_hits(texts, ["id"], "lowered", crowded).collect()} == want
    assert alias_hits(texts, ["id"], "lowered", aliases.limit(0)).collect() == []


def test_anchors_over_slices_and_code_points(spark, monkeypatch):
    """Starts are found by whole characters, also across the slices that a long text is looked at in, and no start is made a row that cannot be an anchor."""
    aliases = spark.createDataFrame([("A", "\U0001f600é日本語x", "strong"), ("B", "zq", "strong")], "tool string, alias string, tier string")
    anchored = aliases.withColumn("_anchor", F.left("alias", F.lit(6)))
    long = "ab" * (containment._SLICE // 2 - 2) + "\U0001f600é日本語x" + "c" * (containment._SLICE - 3) + "zq"
    texts = spark.createDataFrame([(1, long), (2, "é日本語x"), (3, "z q")], "id int, lowered string")
    met = possible_anchors(texts, ["id"], "lowered", anchored, [2, 6])
    assert {("\U0001f600é日本語x", 1), ("zq", 1)} <= {(r["_anchor"], r["id"]) for r in met.collect()}
    # cut in numpy, not by a pattern per position
    assert "regexp" not in met._jdf.queryExecution().optimizedPlan().toString()
    assert {(r["id"], r["tool"]) for r in alias_hits(texts, ["id"], "lowered", aliases).collect()} == {(1, "A"), (1, "B")}


def test_expansion_runs_the_matcher_once(spark):
    """No inferred size filter below the projection that matches."""
    df = spark.createDataFrame([(1, "claude ai")], "i int, text string").withColumn("text", F.trim("text"))
    plan = explode_matches(with_matches(df, F.col("text"), AI_TOOLS))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lower(") == 1
    assert "size(" not in plan
