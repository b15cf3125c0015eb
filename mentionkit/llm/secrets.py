"""Find secrets in texts: three fixed patterns, and tokens that a battery of randomness tests singles out.

DataFrame functions only. A candidate of the battery is a run of 20 or more base64 characters. Its encoding is
inferred from the characters it holds; its characters become numbers by their place in that alphabet. Three tests ask
whether the numbers could be independent and uniform: chi-squared over the alphabet, runs above and below the middle,
and correlation of neighbours. Their p-values are combined by Fisher's method; a candidate that fails is no secret.

Short tokens pass such tests too easily, so passing is not enough: it has to be unlikely that an ordinary token looks so random. What ordinary tokens
look like is learned from all candidates of all documents that the battery does not take for random: how often each character follows each other one, mixed
with a chain of classes of character (lower, upper, digit, other) that changes class seldom. The likelihood of a candidate under that
chain, over its likelihood under its encoding's uniform alphabet, is a p-value against ordinary tokens (Markov's inequality), and a low p-value of the battery
raises it in proportion, which keeps it one. These combined p-values are put through Benjamini and Hochberg's step-up rule over all candidates,
separately per length class and rounded up to a grid, so that the share of ordinary tokens among the finds is held in each class. Tokens of
digits alone look the same either way and are rarely found; candidates have 20 characters or more.

Positions are code points, ends exclusive. Defined results: NULL and empty texts have no spans; repeated rows are judged
alike and count as often as they occur; no documents give no rows; very long texts and runs are judged whole; other columns, whatever their names, are
not read. Added spans never overlap a pattern's span.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mentionkit.llm.common import text_of
from mentionkit.sources.shared import store

KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 12
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{16,}"
RANDOM = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}"

DIGITS, LOW, UP = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ENCODINGS = (
    ("digits", "[0-9]+", DIGITS),
    ("hex", "[0-9a-f]+", DIGITS + "abcdef"),
    ("HEX", "[0-9A-F]+", DIGITS + "ABCDEF"),
    ("lower", "[a-z]+", LOW),
    ("upper", "[A-Z]+", UP),
    ("base32", "[A-Z2-7]+", UP + "234567"),
    ("base36", "[a-z0-9]+", DIGITS + LOW),
    ("BASE36", "[A-Z0-9]+", DIGITS + UP),
    ("base62", "[A-Za-z0-9]+", UP + LOW + DIGITS),
    ("base64url", "[A-Za-z0-9_-]+", UP + LOW + DIGITS + "-_"),
    ("base64", "[A-Za-z0-9+/_-]+", UP + LOW + DIGITS + "+/-_"),
)
UNIFORM_P = 0.001
"""A candidate is taken for random unless the battery's combined p-value is below this."""
ORDINARY_P = 0.05
"""Candidates whose combined p-value is below this teach what ordinary tokens look like; above it, it does not count against a candidate."""
CHARACTERS = UP + LOW + DIGITS + "+/_-"
CHANGE_RATE = 0.10
"""How often the class of character changes inside an ordinary token, as far as nothing has been learned."""
_PRIOR_PAIRS, _PRIOR_SHARE = 50.0, 0.15
FALSE_DISCOVERIES = 0.01
LENGTH_CLASSES = (20, 28, 36, 48, 64, 96)
"""Least length of each class in which false discoveries are held apart."""
_GRID = 10  # steps per power of ten
_BLOCK = 256


def _prefix_sums(steps: Column) -> Column:
    """Running sums of an array, in blocks so that appending stays cheap in long arrays."""
    starts = F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / _BLOCK).cast("int"))

    def run(values: Column, begin: Column) -> Column:
        empty = F.array().cast("array<int>")
        return F.aggregate(
            values,
            F.struct(begin.alias("at"), empty.alias("sums")),
            lambda a, x: F.struct((a["at"] + x).alias("at"), F.array_append(a["sums"], a["at"] + x).alias("sums")),
            lambda a: a["sums"],
        )

    totals = F.transform(starts, lambda b: F.aggregate(F.slice(steps, b * _BLOCK + 1, _BLOCK), F.lit(0), lambda a, x: a + x))
    ends = run(totals, F.lit(0))
    blocks = F.transform(
        F.arrays_zip(starts.alias("b"), totals.alias("t"), ends.alias("e")),
        lambda z: run(F.slice(steps, z["b"] * _BLOCK + 1, _BLOCK), z["e"] - z["t"]),
    )
    return F.flatten(blocks)


_SPAN = "array<struct<start:int,kind:int,end:int,match:string>>"


def _with_spans(df: DataFrame, out: str, text: str, pattern: str, kind: int, keep=None, holds: tuple = ()) -> DataFrame:
    """Add the matches of a pattern as an array of (start, kind, end, match).

    ``holds``: strings of which every match has one; looking for them first is cheap.
    """
    found, ends = f"{out}_m", f"{out}_e"
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    if holds:
        any_of = reduce(or_, [F.contains(F.col(text), F.lit(x)) for x in holds])
        matches = F.when(any_of, matches).otherwise(F.array().cast("array<string>"))
    df = df.withColumn(found, matches)
    gaps = F.split(text, pattern, -1)
    steps = F.zip_with(F.col(found), F.slice(gaps, 1, F.size(found)), lambda m, g: F.length(m) + F.length(g))
    df = df.withColumn(f"{out}_s", F.when(F.size(found) > 0, steps))
    df = df.withColumn(ends, F.when(F.size(found) > 0, _prefix_sums(F.col(f"{out}_s"))))
    spans = F.zip_with(
        found, ends,
        lambda m, e: F.struct((e - F.length(m)).alias("start"), F.lit(kind).alias("kind"), e.alias("end"), m.alias("match")),
    )
    spans = spans if keep is None else F.filter(spans, lambda s: keep(s["match"]))
    spans = F.when(F.size(found) > 0, spans).otherwise(F.array().cast(_SPAN))
    return df.withColumn(out, spans).drop(found, ends, f"{out}_s")


def _tail(z: Column) -> Column:
    """P(Z > z) of a normal variable: the rational approximation of Abramowitz and Stegun, 26.2.17."""
    a = F.abs(z)
    t = 1 / (1 + 0.2316419 * a)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    upper = F.greatest(F.exp(-a * a / 2) / math.sqrt(2 * math.pi) * poly, F.lit(1e-100))
    return F.when(z >= 0, upper).otherwise(1 - upper)


def _steps(values: Column, *steps) -> Column:
    """Pass the elements of an array of structs through steps; each adds fields, which the next ones read by name."""
    for step in steps:
        values = F.transform(values, step)
    return values


def battery(spans: Column) -> Column:
    """Spans (structs with ``match``) to the same with ``n``, ``k`` and ``p_uniform``; see the module text.

    One field per step, so that nothing is computed twice.
    """
    alphabets = F.array(*[F.lit(a) for _, _, a in ENCODINGS])
    carried = ("start", "kind", "end", "match")

    def with_fields(s: Column, names: tuple, **new: Column) -> Column:
        return F.struct(*[s[n].alias(n) for n in names], *[v.alias(k) for k, v in new.items()])

    def inferred(s: Column) -> Column:
        place = F.coalesce(*[F.when(s["match"].rlike(f"^{pattern}$"), F.lit(i)) for i, (_, pattern, _) in enumerate(ENCODINGS)])
        return with_fields(s, carried, alphabet=F.get(alphabets, place))

    def numbered(s: Column) -> Column:
        x = F.transform(F.split(s["match"], ""), lambda c: (F.instr(s["alphabet"], c) - 1).cast("double"))
        return with_fields(s, carried, x=x, k=F.length(s["alphabet"]).cast("double"))

    def counted(s: Column) -> Column:
        x, k = s["x"], s["k"]
        pairs = F.sequence(F.lit(1), F.size(x) - 1)
        return with_fields(
            s, (*carried, "x", "k"),
            n=F.size(x).cast("double"),
            squares=F.aggregate(
                F.array_distinct(x), F.lit(0.0), lambda a, v: a + F.pow(F.size(F.filter(x, lambda y: y == v)).cast("double"), F.lit(2.0))
            ),
            high=F.size(F.filter(x, lambda v: v * 2 >= k)).cast("double"),
            runs=1 + F.size(F.filter(pairs, lambda i: (F.get(x, i) * 2 >= k) != (F.get(x, i - 1) * 2 >= k))),
            total=F.aggregate(x, F.lit(0.0), lambda a, v: a + v),
        )

    def moments(s: Column) -> Column:
        x, n = s["x"], s["n"]
        pairs = F.sequence(F.lit(1), F.size(x) - 1)
        mean = s["total"] / n
        return with_fields(
            s, (*carried, "n", "k", "squares", "runs", "high"),
            mean_runs=2 * s["high"] * (n - s["high"]) / n + 1,
            spread=F.aggregate(x, F.lit(0.0), lambda a, v: a + (v - mean) * (v - mean)),
            lagged=F.aggregate(pairs, F.lit(0.0), lambda a, i: a + (F.get(x, i) - mean) * (F.get(x, i - 1) - mean)),
        )

    def normal(s: Column) -> Column:
        n, k = s["n"], s["k"]
        var_runs = (s["mean_runs"] - 1) * (s["mean_runs"] - 2) / (n - 1)
        return with_fields(
            s, (*carried, "n", "k"),
            chi=(s["squares"] * k / n - n - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n),
            by_runs=F.abs(F.when(var_runs > 0, (s["runs"] - s["mean_runs"]) / F.sqrt(var_runs)).otherwise(F.sqrt(n))),
            by_serial=F.abs(F.when(s["spread"] > 0, (s["lagged"] / s["spread"] + 1 / n) * F.sqrt(n)).otherwise(F.sqrt(n))),
        )

    def combined(s: Column) -> Column:
        # half of Fisher's statistic; it has 6 degrees of freedom
        logs = F.log(_tail(s["chi"])) + F.log(2 * _tail(s["by_runs"])) + F.log(2 * _tail(s["by_serial"]))
        return with_fields(s, (*carried, "n", "k"), half=-logs)

    def closed(s: Column) -> Column:
        half = s["half"]
        return with_fields(s, (*carried, "n", "k"), p_uniform=F.exp(-half) * (1 + half + half * half / 2))

    return _steps(spans, inferred, numbered, counted, moments, normal, combined, closed)


def _prior() -> list[list[float]]:
    """How likely each character follows each other one if only the classes of both count."""
    classes = {c: alphabet for alphabet in (UP, LOW, DIGITS, "+/_-") for c in alphabet}
    rows = []
    for a in CHARACTERS:
        own = classes[a]
        rows.append([(1 - CHANGE_RATE) / len(own) if b in own else CHANGE_RATE / (len(CHARACTERS) - len(own)) for b in CHARACTERS])
    return rows


def chain(counts: dict[tuple[str, str], int]) -> list[float]:
    """Logarithms of the chances of each pair, pair by pair, then of each first character, from how often pairs occur in ordinary tokens."""
    out, firsts = [], [1.0] * len(CHARACTERS)
    for i, (a, prior) in enumerate(zip(CHARACTERS, _prior())):
        seen = [counts.get((a, b), 0) for b in CHARACTERS]
        total = sum(seen) + _PRIOR_PAIRS
        firsts[i] += sum(seen)
        learned = [(n + _PRIOR_PAIRS * p) / total for n, p in zip(seen, prior)]
        out += [math.log((1 - _PRIOR_SHARE) * q + _PRIOR_SHARE * p) for q, p in zip(learned, prior)]
    return out + [math.log(f / sum(firsts)) for f in firsts]


def p_values(spans: Column, table: list[float]) -> Column:
    """Spans of ``battery`` with ``p``: how likely an ordinary token is as random as this one, by the chain and the battery together."""
    size = len(CHARACTERS)
    # folded into one constant, however many numbers it has
    logs = F.split(F.lit(",".join(map(repr, table))), ",").cast("array<double>")

    def placed(s: Column) -> Column:
        x = F.transform(F.split(s["match"], ""), lambda c: F.instr(F.lit(CHARACTERS), c) - 1)
        return F.struct(*[s[f].alias(f) for f in ("start", "kind", "end", "match", "n", "k", "p_uniform")], x.alias("x"))

    def tested(s: Column) -> Column:
        x = s["x"]
        likely = F.aggregate(
            F.sequence(F.lit(1), F.size(x) - 1), F.get(logs, F.get(x, F.lit(0)) + size * size),
            lambda a, i: a + F.get(logs, F.get(x, i - 1) * size + F.get(x, i)),
        )
        over = F.least(F.lit(0.0), likely + s["n"] * F.log(s["k"]))
        weight = F.greatest(F.lit(1e-12), F.least(F.lit(1.0), s["p_uniform"] / ORDINARY_P))
        p = F.least(F.lit(1.0), F.exp(over) / weight)
        return F.struct(*[s[f].alias(f) for f in ("start", "kind", "end", "match", "n", "p_uniform")], p.alias("p"))

    return _steps(spans, placed, tested)


def _class(n: Column) -> Column:
    return sum((n >= least).cast("int") for least in LENGTH_CLASSES)


def _bin(p: Column) -> Column:
    """The p-value's place on the grid, rounded towards 1."""
    return F.floor(-F.log10(F.greatest(p, F.lit(1e-99))) * _GRID).cast("int")


def candidates(docs: DataFrame) -> DataFrame:
    """Every candidate of every document with its battery, an array per document."""
    matches = F.regexp_extract_all(text_of(), F.lit(RANDOM), F.lit(0))
    spans = F.transform(matches, lambda m: F.struct(F.lit(0).alias("start"), F.lit(3).alias("kind"), F.length(m).alias("end"), m.alias("match")))
    return docs.select(spans.alias("spans")).where("size(spans) > 0").select(battery(F.col("spans")).alias("spans"))


def learned(found: DataFrame) -> list[float]:
    """The chain of ordinary tokens, from all candidates that the battery does not take for random. Only counts of pairs leave the executors, at most 66 x 66."""
    token = found.select(F.explode("spans").alias("s")).where(F.col("s.p_uniform") < ORDINARY_P).select(F.col("s.match").alias("m"))
    token = token.select(F.split("m", "").alias("x"))
    neighbours = F.zip_with(F.slice("x", 1, F.size("x") - 1), F.slice("x", 2, F.size("x") - 1), lambda a, b: F.concat(a, b))
    pairs = token.select(F.explode(neighbours).alias("pair"))
    return chain({(r["pair"][0], r["pair"][1]): r["count"] for r in pairs.groupBy("pair").count().collect()})


def thresholds(found: DataFrame, table: list[float], level: float = FALSE_DISCOVERIES) -> dict[int, int]:
    """Per length class the least grid place that is still a discovery.

    The step-up rule needs, for each p-value, how many are as small: counts per class and place, of which there are
    fewer than a thousand per class. Only those counts leave the executors.
    """
    rows = found.select(F.inline(p_values(F.col("spans"), table)))
    counts = rows.groupBy(_class(F.col("n")).alias("c"), _bin(F.col("p")).alias("b")).count()
    out: dict[int, int] = {}
    by_class: dict[int, list[tuple[int, int]]] = {}
    for c, b, n in counts.collect():
        by_class.setdefault(c, []).append((b, n))
    for c, rows in by_class.items():
        total, rank = sum(n for _, n in rows), 0
        for b, n in sorted(rows, reverse=True):
            rank += n
            if 10 ** (-b / _GRID) <= level * rank / total:
                out[c] = b
    return out


def find_secrets(docs: DataFrame, level: float = FALSE_DISCOVERIES) -> DataFrame:
    """Add ``base_spans`` and ``spans`` to the documents, both in order of start and kind."""
    found_tokens = store(candidates(docs), "secret-candidates")
    table = learned(found_tokens)
    limits = thresholds(found_tokens, table, level)
    df = docs.withColumn("_t", text_of())
    df = _with_spans(df, "_assign", "_t", ASSIGN, 0, lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= ASSIGN_LEAST, (":", "="))
    df = _with_spans(df, "_access", "_t", ACCESS, 1, holds=("AKIA",))
    df = _with_spans(df, "_hex", "_t", HEX, 2)
    df = df.withColumn("base_spans", F.array_sort(F.concat("_assign", "_access", "_hex")))
    df = _with_spans(df, "_random", "_t", RANDOM, 3)

    free = F.filter("_random", lambda s: ~F.exists("base_spans", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))

    def found(s: Column) -> Column:
        verdict = F.lit(False)
        for c, b in limits.items():
            verdict = verdict | ((_class(s["n"]) == c) & (_bin(s["p"]) >= b))
        return verdict & (s["p_uniform"] >= UNIFORM_P)

    if limits:
        tested = F.filter(p_values(battery(free), table), found)
        plain = F.transform(tested, lambda s: F.struct(*[s[n].alias(n) for n in ("start", "kind", "end", "match")]))
        df = df.withColumn("_random", F.when(F.size("_random") > 0, plain).otherwise(F.col("_random")))
    else:
        df = df.withColumn("_random", F.array().cast(_SPAN))
    return df.withColumn("spans", F.array_sort(F.concat("base_spans", "_random"))).drop("_t", "_assign", "_access", "_hex", "_random")


def spelled(spans: Column) -> Column:
    """``kind:start:end`` joined by commas."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])), ",")


def secret_report(docs: DataFrame) -> DataFrame:
    """One row per document: counts by kind, the digest of the pattern spans and all spans."""
    df = find_secrets(docs.select("doc_id", "text"))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return df.select(
        "doc_id",
        *[count(i).alias(f"n_{kind}") for i, kind in enumerate(KINDS[:3])],
        F.sha2(spelled(F.col("base_spans")), 256).alias("base_sha256"),
        spelled(F.col("spans")).alias("spans"),
        count(3).alias("n_random"),
    )


def redacted(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """The documents with every span replaced by the mark; overlapping spans become one. Columns stay."""
    own = docs.columns
    df = find_secrets(docs.select(F.struct(*own).alias("_doc"), "text")).withColumn("_t", text_of())
    last = lambda a: F.element_at(a, -1)
    merged = F.aggregate(
        F.slice(F.col("spans"), 2, F.size("spans")),
        F.array(F.struct(F.col("spans")[0]["start"].alias("s"), F.col("spans")[0]["end"].alias("e"))),
        lambda a, s: F.when(
            s["start"] < last(a)["e"],
            F.concat(F.slice(a, 1, F.size(a) - 1), F.array(F.struct(last(a)["s"].alias("s"), F.greatest(last(a)["e"], s["end"]).alias("e")))),
        ).otherwise(F.array_append(a, F.struct(s["start"].alias("s"), s["end"].alias("e")))),
    )
    df = df.withColumn("_m", F.when(F.size("spans") > 0, merged))
    # what lies before each span, and after the last
    pieces = F.transform(
        F.sequence(F.lit(0), F.size("_m")),
        lambda i: F.substring(
            F.col("_t"),
            F.when(i == 0, F.lit(0)).otherwise(F.get(F.col("_m"), i - 1)["e"]) + 1,
            F.coalesce(F.get(F.col("_m"), i)["s"], F.length("_t")) - F.when(i == 0, F.lit(0)).otherwise(F.get(F.col("_m"), i - 1)["e"]),
        ),
    )
    text = F.when(F.size("spans") > 0, F.array_join(pieces, mark)).otherwise(F.col("_doc.text"))
    df = df.withColumn("_new", text)
    out = []
    for c in own:
        if c == "text":
            out.append(F.col("_new").alias("text"))
        elif c == "n_chars":
            out.append(F.when(F.size("spans") > 0, F.length("_new").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("_doc.n_chars")).alias("n_chars"))
        else:
            out.append(F.col(f"_doc.`{c}`").alias(c))
    return df.select(*out)
