"""Toxic passages by maximal scoring segments over token log-odds.

A token's score is the log-odds of the toxic class given that it occurs, from counts of documents, under a chain of Dirichlet priors: a word's
prior is the rate of its first eight letters, theirs that of its first seven, and so on down to four and to the rate of all words. So a new word of a
known stem has a score, and a word seen once says little. A fixed drift is taken off every token; a linear scan (Ruzzo and Tompa) then gives all maximal segments of a text. The scale
of segment scores in clean text is that of an extreme-value law: lambda solves sum p(s) exp(lambda s) = 1 over the token scores of clean text, K follows from the
greatest segments of clean texts. A text's evidence is the least p-value over the sums of its best r segments, each
corrected for the text's length (Karlin and Altschul); a logistic curve turns it into a score.

Counts and calibration are learned on disjoint parts of at most ``SAMPLE`` labelled rows, chosen by hash among those not held out. A word or stem is
left out where the stem it falls back to scores the same; beyond ``VOCABULARY`` of them whole families of the same first four letters are left out, the
rarest first, so what is broadcast is bounded and no clean word is left to a toxic stem. Scoring reads whole texts and nothing but them.

Defined results: NULL and empty texts have no evidence and the score of the curve at zero; without labels of both classes every score is 0;
repeated rows are scored alike; no documents give no rows.
"""

from __future__ import annotations

import heapq
import math
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mentionkit.llm.common import small_batches, text_of
from mentionkit.llm.quality import labelled_sample
from mentionkit.sources.shared import store

SAMPLE = 20_000
VOCABULARY = 1_000_000
"""Words and stems together that a model holds."""
STEMS = (4, 5, 6, 7, 8)
TOXIC = 0.7
DRIFT = 1.0
"""Taken off each token's score, so that a segment has to be dense in telling tokens."""
_PRIOR = 4.0
"""Documents that a prior weighs as much as."""
_SAME = 0.05
"""Scores closer than this are one; the calibration rounds to quarters."""
_MOST_SEGMENTS = 64
_TOKEN = re.compile(r"[^\W\d_]+")


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def tokens(text: str) -> list[str]:
    return _TOKEN.findall(text.lower())


def segments(scores: list[float]) -> list[tuple[float, int, int]]:
    """All maximal scoring segments (score, first, end) in one pass.

    A run of negative scores only lowers the running sum, so the work per token does not depend on what was found before, but for
    merges, each of which removes a candidate.
    """
    found: list[list[float]] = []  # first, end, sum before it, sum after it, nearest earlier candidate of lower sum before
    total = 0.0
    for i, s in enumerate(scores):
        if s <= 0:
            total += s
            continue
        new = [i, i + 1, total, total + s, -1]
        total += s
        j = len(found) - 1
        while True:
            while j >= 0 and found[j][2] >= new[2]:
                j = int(found[j][4])
            if j < 0 or found[j][3] >= new[3]:
                new[4] = j
                found.append(new)
                break
            new[0], new[2] = found[j][0], found[j][2]
            del found[j:]
            j = len(found) - 1
    return [(f[3] - f[2], int(f[0]), int(f[1])) for f in found]


@dataclass
class Model:
    words: dict[str, float]
    stems: dict[str, float]
    scale: float = 1.0
    log_k: float = 0.0
    slope: float = 1.0
    offset: float = 0.0

    def scores(self, found: list[str]) -> list[float]:
        """Per token; the k-th time a telling word comes it counts 1/k, as its own repeats are no new evidence."""
        words, seen, out = self.words, {}, []
        for t in found:
            s = words.get(t)
            s = (self.of_stem(t) if s is None else s) - DRIFT
            if s > 0:
                seen[t] = k = seen.get(t, 0) + 1
                s /= k
            out.append(s)
        return out

    def of_stem(self, word: str) -> float:
        for n in reversed(STEMS):
            s = self.stems.get(word[:n])
            if s is not None:
                return s
        return 0.0

    def evidence(self, found: list[tuple[float, int, int]], n: int) -> float:
        """-log of the least p-value over the sums of the best segments."""
        if not found or not n:
            return 0.0
        best = heapq.nlargest(_MOST_SEGMENTS, (s for s, _, _ in found))
        top, total = 0.0, 0.0
        for r, s in enumerate(best, 1):
            total += self.scale * s - self.log_k - math.log(n)
            if total <= r * (r - 1):  # the law holds in the tail only
                continue
            # P(T) = exp(-T) T^(r-1) / (r! (r-1)!), and a price for choosing r
            log_p = -total + (r - 1) * math.log(total) - math.lgamma(r + 1) - math.lgamma(r)
            top = max(top, -log_p - r * math.log(2))
        return top

    def score(self, text: str) -> tuple[float, int]:
        found = tokens(text)
        parts = segments(self.scores(found))
        significant = sum(self.scale * s - self.log_k - math.log(len(found)) > 3.0 for s, _, _ in parts)
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, self.slope * self.evidence(parts, len(found)) + self.offset)))), significant


def _columns(scores: dict[str, float]) -> pa.Table:
    return pa.table({"w": pa.array(scores.keys(), pa.string()), "s": pa.array(scores.values(), pa.float64())})


def _entries(scores: pa.Table) -> dict[str, float]:
    return dict(zip(scores["w"].to_pylist(), scores["s"].to_pylist()))


@dataclass
class Learned:
    """A model as the driver holds it: words and stems stay columns, and only tasks make dictionaries of them."""

    words: pa.Table
    stems: pa.Table
    curve: Model
    """Scale and curve; no words."""

    def model(self) -> Model:
        return Model(_entries(self.words), _entries(self.stems), self.curve.scale, self.curve.log_k, self.curve.slope, self.curve.offset)


class _Opened:
    """A broadcast model, of which each Python worker makes one dictionary."""

    def __init__(self, learned: Learned | None) -> None:
        self.learned, self._model = learned, None

    def __getstate__(self) -> dict:
        return {"learned": self.learned, "_model": None}

    def model(self) -> Model | None:
        if self._model is None and self.learned is not None:
            self._model, self.learned = self.learned.model(), None
        return self._model


def passages(model: Model, text: str, least: float = 3.0) -> list[tuple[int, int, float]]:
    """Every significant toxic passage of a text as (start, end, evidence), in code points of the lower-cased text."""
    spans = [m.span() for m in _TOKEN.finditer(text.lower())]
    if not spans:
        return []
    out = []
    for s, first, end in segments(model.scores(tokens(text))):
        e = model.scale * s - model.log_k - math.log(len(spans))
        if e > least:
            out.append((spans[first][0], spans[end - 1][1], e))
    return out


def _counts(sample: DataFrame) -> tuple[DataFrame | None, float | None]:
    """Words, ``w, n, k``: documents and toxic documents they occur in; and the share of toxic ones over all words."""

    @F.pandas_udf("array<string>")
    def distinct(texts: pd.Series) -> pd.Series:
        return pd.Series([sorted(set(tokens(t))) for t in texts])

    rows = sample.select("y", F.explode(distinct(text_of())).alias("w"))
    words = store(rows.groupBy("w").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("k")), "toxic-words")
    seen, toxic = words.agg(F.sum("n"), F.sum("k")).first()
    if not toxic or toxic == seen:
        return None, None
    return words, toxic / seen


def _log_odds(p: float) -> float:
    return math.log(p / (1 - p))


def family(rows: list[tuple[str, int, int]], rate: float) -> tuple[dict[str, float], dict[str, float]]:
    """Scores of the words and stems that share their first letters, from ``w, n, k`` of all of them.

    One is left out only if what it falls back to, the longest stem that is kept or else zero, differs by less than ``_SAME``.
    """
    counts: dict[str, list[int]] = {}
    for w, n, k in rows:
        for stem in {w[:m] for m in STEMS}:
            c = counts.setdefault(stem, [0, 0])
            c[0] += n
            c[1] += k
    smoothed = lambda k, n, prior: (k + _PRIOR * prior) / (n + _PRIOR)
    base, rates, out = _log_odds(rate), {}, Model({}, {})
    for stem in sorted(counts, key=len):
        n, k = counts[stem]
        rates[stem] = smoothed(k, n, rates[stem[:-1]] if len(stem) > STEMS[0] else rate)
        s = _log_odds(rates[stem]) - base
        if abs(s - (out.of_stem(stem[:-1]) if len(stem) > STEMS[0] else 0.0)) >= _SAME:
            out.stems[stem] = s
    for w, n, k in rows:
        # a word of one document says no more than its stem
        if n > 1:
            s = _log_odds(smoothed(k, n, rates[w[: STEMS[-1]]] if len(w) >= STEMS[0] else rate)) - base
            if abs(s - out.of_stem(w)) >= _SAME:
                out.words[w] = s
    return out.words, out.stems


def _scored(words: DataFrame, rate: float) -> Model:
    return _learned(words, rate).model()


def _learned(words: DataFrame, rate: float) -> Learned:
    """The scores to keep, worked out family by family on the executors."""

    def scored(batches):
        for batch in batches:
            out = []
            for first, members in zip(batch["first"], batch["members"]):
                rows = [(m["w"], m["n"], m["k"]) for m in members]
                found, stems = family(rows, rate)
                seen = sum(n for _, n, _ in rows)
                out += [(first, seen, True, w, s) for w, s in found.items()] + [(first, seen, False, w, s) for w, s in stems.items()]
            yield pd.DataFrame(out, columns=["first", "seen", "word", "w", "s"])

    grouped = words.groupBy(F.substr("w", F.lit(1), F.lit(STEMS[0])).alias("first")).agg(F.collect_list(F.struct("w", "n", "k")).alias("members"))
    kept = store(grouped.mapInPandas(scored, "first string, seen long, word boolean, w string, s double"), "toxic-scores")
    if kept.count() > VOCABULARY:
        # whole families go, so that no word is left to a stem that scores higher
        sizes = kept.groupBy("first", "seen").count().toPandas().sort_values(["seen", "first"], ascending=[False, True])
        fits = sizes["first"][sizes["count"].cumsum() <= VOCABULARY].tolist()
        kept = kept.join(kept.sparkSession.createDataFrame([(f,) for f in fits], "first string"), "first")
    read = lambda word: kept.where(F.col("word") == word).select("w", "s").toArrow()
    return Learned(read(True), read(False), Model({}, {}))


def fit(docs: DataFrame, labels: DataFrame) -> Model | None:
    learned = _fit(docs, labels)
    return None if learned is None else learned.model()


def _fit(docs: DataFrame, labels: DataFrame) -> Learned | None:
    small_batches(docs.sparkSession)
    learn = labels.where(~held_out(F.col("doc_id")))
    sample = labelled_sample(docs, learn, "toxic", SAMPLE).groupBy("doc_id", "y").agg(F.min("text").alias("text"))
    part = F.xxhash64(F.lit("part"), "doc_id") % 3 == 0
    words, rate = _counts(sample.where(~part))
    if rate is None:
        return None
    return _calibrated(_learned(words, rate), sample.where(part))


def _calibrated(learned: Learned, sample: DataFrame) -> Learned:
    """Lambda and K from clean texts, then the logistic curve, all on rows whose counts the model has not seen."""
    shared, model = sample.sparkSession.sparkContext.broadcast(_Opened(learned)), learned.curve

    @F.pandas_udf("struct<n: bigint, bins: array<bigint>, places: array<bigint>, best: array<double>>")
    def digest(texts: pd.Series) -> pd.DataFrame:
        out = []
        for t in texts:
            scores = shared.value.model().scores(tokens(t))
            places, counts = np.unique(np.round(np.array(scores) * 4).astype(np.int64), return_counts=True)
            best = heapq.nlargest(_MOST_SEGMENTS, (s for s, _, _ in segments(scores)))
            out.append((len(scores), counts.tolist(), places.tolist(), best))
        return pd.DataFrame(out, columns=["n", "bins", "places", "best"])

    digests = store(sample.select("y", digest(text_of()).alias("d")).select("y", "d.*"), "toxic-digests")
    # no later task needs the model in this form
    shared.destroy()
    bins = digests.where("y = 0").select(F.explode(F.arrays_zip("places", "bins")).alias("b")).groupBy("b.places").agg(F.sum("b.bins").alias("n"))
    model.scale = _lambda(dict(sorted((r["places"], r["n"]) for r in bins.collect())))
    rows = digests.select("y", "n", "best").collect()
    gumbel = [model.scale * r["best"][0] - math.log(r["n"]) for r in rows if not r["y"] and r["best"]]
    if gumbel:
        # the mean of the greatest of n is (log(K n) + Euler's number) / lambda
        model.log_k = float(np.mean(gumbel)) - 0.5772156649
    x = np.array([model.evidence([(s, 0, 0) for s in r["best"]], r["n"]) for r in rows])
    y = np.array([r["y"] for r in rows], dtype=float)
    model.slope, model.offset = _logistic(x, y)
    return learned


def _lambda(counts: dict[int, int]) -> float:
    """The positive root of sum p(s) exp(lambda s) = 1, for scores of negative mean and positive maximum."""
    s = np.array([p / 4 for p in counts], dtype=float)
    p = np.array(list(counts.values()), dtype=float)
    if not len(s) or s.max() <= 0 or (p * s).sum() >= 0:
        return 1.0
    p /= p.sum()
    low, high = 0.0, 1.0
    value = lambda x: float((p * np.exp(np.minimum(x * s, 700))).sum()) - 1
    while value(high) < 0 and high < 1e3:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if value(mid) < 0 else (low, mid)
    return max(high, 1e-3)


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope (at least 0) and offset by Newton's method with a small ridge."""
    if not len(y):
        return 1.0, -2.0
    x = np.minimum(x, 60.0)
    w = np.zeros(2)
    design = np.stack([x, np.ones(len(x))], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        grad = design.T @ (p - y) + 1e-2 * w
        hess = design.T @ (design * np.maximum(p * (1 - p), 1e-9)[:, None]) + 1e-2 * np.eye(2)
        w = w - np.clip(np.linalg.solve(hess, grad), -2, 2)
    return max(float(w[0]), 0.0), float(w[1])


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted, passages``, the last the number of significant ones."""
    shared = docs.sparkSession.sparkContext.broadcast(_Opened(_fit(docs, labels)))

    @F.pandas_udf("struct<score: double, passages: bigint>")
    def score(texts: pd.Series) -> pd.DataFrame:
        model = shared.value.model()
        return pd.DataFrame([model.score(t) if model else (0.0, 0) for t in texts], columns=["score", "passages"])

    rows = docs.select("doc_id", score.asNondeterministic()(text_of()).alias("s"))
    return rows.select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "s.score",
        (F.col("s.score") >= TOXIC).cast("int").alias("predicted"), "s.passages",
    )
