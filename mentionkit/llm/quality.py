"""Quality rules: fixed rules on document statistics, then gradient-boosted trees over the same statistics.

The statistics of a text are computed in Arrow batches. The trees are trained here, on at most ``SAMPLE`` labelled rows chosen by the hash of
their id, with logistic loss over binned features; a feature listed in ``MONOTONE`` may only move the score one way: a split against its direction
is refused, and both children are held to their side of the split's middle. All trees lie in five flat arrays of nodes, and a batch walks all rows
down one level at a time.

Defined results: NULL and empty texts have no words and fail the rules; without labels of both classes the rules alone decide; repeated rows
are judged alike; no documents give no rows. Labels that are NULL are not learned from.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mentionkit.llm.common import small_batches, text_of

SAMPLE = 20_000
"""Labelled rows that the trees are fitted on, at most."""
KEEP = 0.5
"""Probability of good quality from which a document is kept."""
FEATURES = (
    "log_words", "word_length", "symbol_share", "duplicate_line_share", "repeat_share", "distinct_share",
    "upper_share", "digit_share", "mark_share", "pipe_share", "exclaim_share", "stop_share", "line_words", "other_share",
)
MONOTONE = {"symbol_share": -1, "duplicate_line_share": -1, "repeat_share": -1, "exclaim_share": -1}
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
LEAST_WORDS, MOST_REPEATED = 50, 50

_SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)
_SPACE = np.frombuffer(b" \t\n\x0b\x0c\r", np.uint8)


def statistics(text: bytes) -> tuple[list[int], list[float]]:
    """The base counts and the features of one text in UTF-8."""
    words = text.split()
    n = len(words)
    by_byte = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    points = len(text) - int(by_byte[0x80:0xC0].sum())
    word_chars = points - int(by_byte[_SPACE].sum())
    symbols = int(by_byte[_SYMBOLS].sum())

    seen: set[bytes] = set()
    duplicates = lines = 0
    for line in text.split(b"\n"):
        if line.strip():
            lines += 1
            if line in seen:
                duplicates += 1
            else:
                seen.add(line)

    ids: dict[bytes, int] = {}
    repeated = 0
    if n:
        a = np.fromiter((ids.setdefault(w, len(ids)) for w in words), dtype=np.int64, count=n)
        if n > 3:
            repeated = _repeated_words(a, len(ids))

    share = lambda x, of: float(x) / of if of else 0.0
    upper, lower = int(by_byte[65:91].sum()), int(by_byte[97:123].sum())
    digits = int(by_byte[48:58].sum())
    marks = int(by_byte[33:48].sum() + by_byte[58:65].sum() + by_byte[91:97].sum() + by_byte[123:127].sum())
    features = [
        float(np.log1p(n)), share(word_chars, n), share(symbols, word_chars), share(duplicates, lines), share(repeated, n), share(len(ids), n),
        share(upper, upper + lower), share(digits, word_chars), share(marks, word_chars), share(by_byte[124], n), share(by_byte[33], n),
        share(by_byte[46], n), share(n, lines), share(int(by_byte[0xC0:].sum()), word_chars),
    ]
    return [n, word_chars, symbols, duplicates, repeated], features


def _repeated_words(a: np.ndarray, distinct: int) -> int:
    """Words that lie in a window of three that occurs twice or more."""
    pairs = a[:-1] * distinct + a[1:]
    if distinct >= 1 << 20:  # else a window's number would not fit
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * distinct + a[2:]
    _, place, counts = np.unique(windows, return_inverse=True, return_counts=True)
    again = counts[place] > 1
    mark = np.zeros(len(a), dtype=bool)
    for shift in range(3):
        mark[shift : shift + len(again)] |= again
    return int(mark.sum())


def base_failed(n_words, n_repeat_words):
    return (n_words < LEAST_WORDS) | (100 * n_repeat_words > MOST_REPEATED * n_words)


def _frame(texts: pd.Series) -> pd.DataFrame:
    rows = [statistics(t) for t in texts]
    base = pd.DataFrame([r[0] for r in rows], columns=list(BASE), dtype="int64")
    features = pd.DataFrame([r[1] for r in rows], columns=list(FEATURES), dtype="float64")
    return pd.concat([base, features], axis=1)


@dataclass
class Forest:
    """Trees of one depth in flat arrays. ``feature`` is -1 at a leaf, which then is its own child."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of the rows of a matrix."""
        rows = np.arange(len(x))[:, None]
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        for _ in range(self.depth):
            f = self.feature[at]
            down = x[rows, np.maximum(f, 0)] <= self.threshold[at]
            at = np.where(f < 0, at, np.where(down, self.left[at], self.right[at]))
        return self.start + self.value[at].sum(axis=1)


def _sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))


def train(x: np.ndarray, y: np.ndarray, directions: list[int], trees=60, depth=3, rate=0.2, bins=64, ridge=1.0, least=5.0) -> Forest:
    """Gradient boosting with logistic loss on binned features, under monotonic constraints."""
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], axis=1)
    start = float(np.log(y.mean() / (1 - y.mean())))
    margin = np.full(len(y), start)
    nodes: list[list[float]] = []  # feature, threshold, left, right, value
    roots = []
    for _ in range(trees):
        p = _sigmoid(margin)
        grad, hess = p - y, np.maximum(p * (1 - p), 1e-9)
        roots.append(len(nodes))
        step = np.zeros(len(y))
        nodes.append([-1, 0.0, len(nodes), len(nodes), 0.0])
        todo = [(roots[-1], np.arange(len(y)), -np.inf, np.inf, 0)]
        while todo:
            node, rows, low, high, level = todo.pop()
            g, h = grad[rows].sum(), hess[rows].sum()
            best = _best_split(binned[rows], grad[rows], hess[rows], edges, directions, low, high, ridge, least) if level < depth else None
            if best is None:
                nodes[node][4] = rate * float(np.clip(-g / (h + ridge), low, high))
                step[rows] = nodes[node][4]
                continue
            f, cut, left_value, right_value = best
            goes = binned[rows, f] <= cut
            a, b = len(nodes), len(nodes) + 1
            nodes[node][:4] = [f, float(edges[f][cut]), a, b]
            nodes += [[-1, 0.0, a, a, 0.0], [-1, 0.0, b, b, 0.0]]
            middle = (left_value + right_value) / 2
            left_bounds, right_bounds = (low, high), (low, high)
            if directions[f] > 0:
                left_bounds, right_bounds = (low, middle), (middle, high)
            elif directions[f] < 0:
                left_bounds, right_bounds = (middle, high), (low, middle)
            todo += [(a, rows[goes], *left_bounds, level + 1), (b, rows[~goes], *right_bounds, level + 1)]
        margin += step
    flat = np.array(nodes, dtype=np.float64)
    whole = lambda c: flat[:, c].astype(np.int64)
    return Forest(np.array(roots), whole(0), flat[:, 1], whole(2), whole(3), flat[:, 4], depth, start)


def _best_split(binned, grad, hess, edges, directions, low, high, ridge, least):
    gain_of = lambda g, h, v: -(g * v + 0.5 * (h + ridge) * v * v)
    g_all, h_all = grad.sum(), hess.sum()
    whole = gain_of(g_all, h_all, np.clip(-g_all / (h_all + ridge), low, high))
    best, best_gain = None, 1e-6
    for f, e in enumerate(edges):
        if not len(e):
            continue
        g = np.cumsum(np.bincount(binned[:, f], grad, len(e) + 1))[:-1]
        h = np.cumsum(np.bincount(binned[:, f], hess, len(e) + 1))[:-1]
        n = np.cumsum(np.bincount(binned[:, f], minlength=len(e) + 1))[:-1]
        left = np.clip(-g / (h + ridge), low, high)
        right = np.clip(-(g_all - g) / (h_all - h + ridge), low, high)
        gain = gain_of(g, h, left) + gain_of(g_all - g, h_all - h, right) - whole
        allowed = (n >= least) & (len(binned) - n >= least) & (directions[f] * (right - left) >= 0)
        gain = np.where(allowed, gain, -np.inf)
        k = int(np.argmax(gain))
        if gain[k] > best_gain:
            best, best_gain = (f, k, left[k], right[k]), gain[k]
    return best


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int = SAMPLE) -> DataFrame:
    """``doc_id, text, y`` of at most ``most`` labelled documents, chosen by the hash of the id.

    The chosen labels are at most ``most`` rows of two numbers, which is what makes them fit for a broadcast.
    """
    some = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", F.col(label).alias("y"))
    some = some.distinct().orderBy(F.xxhash64(F.lit("sample"), "doc_id"), "doc_id", "y").limit(most)
    return docs.select("doc_id", "text").join(F.broadcast(some), "doc_id")


def fit(docs: DataFrame, labels: DataFrame) -> Forest | None:
    """Trees for label ``quality``; None without rows of both classes."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("array<double>")
    def features(texts: pd.Series) -> pd.Series:
        return pd.Series([statistics(t)[1] for t in texts])

    # a repeated document counts once, so the sample stays bounded
    sample = labelled_sample(docs, labels, "quality").groupBy("doc_id", "y").agg(F.min("text").alias("text"))
    rows = sample.select("doc_id", "y", features(F.encode(text_of(), "UTF-8")).alias("x")).collect()
    y = np.array([r["y"] for r in rows], dtype=np.float64)
    if not len(y) or y.min() == y.max():
        return None
    order = np.argsort([r["doc_id"] for r in rows], kind="stable")
    x = np.array([r["x"] for r in rows], dtype=np.float64)
    return train(x[order], y[order], [MONOTONE.get(f, 0) for f in FEATURES])


_RESULT = "struct<" + ", ".join(f"{c}: bigint" for c in BASE) + ", base_failed: boolean, probability: double, kept: boolean>"


def judged(docs: DataFrame, forest: Forest | None, keep: float = KEEP) -> DataFrame:
    """Add the struct ``verdict``: base counts, ``base_failed``, ``probability`` and ``kept``."""
    small_batches(docs.sparkSession)

    @F.pandas_udf(_RESULT)
    def verdict(texts: pd.Series) -> pd.DataFrame:
        frame = _frame(texts)
        out = frame[list(BASE)].copy()
        out["base_failed"] = base_failed(out["n_words"], out["n_repeat_words"]).astype(bool)
        score = forest.score(frame[list(FEATURES)].to_numpy()) if forest else np.full(len(out), np.inf)
        out["probability"] = _sigmoid(score)
        out["kept"] = (~out["base_failed"] & (out["probability"] >= keep)).astype(bool)
        return out

    return docs.withColumn("verdict", verdict.asNondeterministic()(F.encode(text_of(), "UTF-8")))


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    rows = judged(docs.select("doc_id", "text"), fit(docs, labels))
    return rows.select("doc_id", *[f"verdict.{c}" for c in (*BASE, "base_failed", "kept", "probability")])


def kept_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that neither the rules nor the trees reject, columns unchanged."""
    own = docs.select(F.struct(*docs.columns).alias("_doc"), "text")
    return judged(own, fit(docs, labels)).where("verdict.kept").select("_doc.*")
