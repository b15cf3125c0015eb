"""Hard negatives by shared candidate lists: anchors are clustered, and a cluster's members walk one list in order of an upper bound.

Vectors become whole numbers, ``floor(256 * x)``, so scores are exact. For a cluster of anchors with center c and widest angle w between c and
a member, a candidate x at angle a from c can score at most ``|q| |x| cos(max(0, a - w))`` with a member q. Candidates are sorted by that bound
(without ``|q|``) once per cluster; every member walks the list from its top and stops where the bound is below what it still needs.

Candidates come in chunks of a fixed size and anchors in blocks of a fixed size within their cluster; each block meets each chunk in a task, whatever the
sizes of the table, so the sorted list of a cluster is one list per chunk. A first pass finds an anchor's positives; a second takes their scores as limits: a
member's walk ends where the bound is below the least negative score it may still use. Only the best few per anchor leave a task.

Cluster centers are fitted on at most ``FIT_ANCHORS`` anchors, taken by hash; they change the order of the walks, never the result.

Defined results: rows with a NULL id or label, a NULL vector or a NULL or non-finite component take no part, nor do those with a component
beyond ``LARGEST``, whose scores would not fit 64 bits; of rows that share an id the least by label and vector counts; vectors are compared
with those of their own length, and empty ones score 0; anchors without positives or negatives give no rows; ties go by the smaller id; no rows
give no rows; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mentionkit.llm.common import small_batches
from mentionkit.sources.shared import store

SCALE = 256
POSITIVES = NEGATIVES = 5
LOW, HIGH = 80, 100
"""A negative's score lies between LOW and HIGH percent of the positive's."""
EVERY = 100
LARGEST = 1 << 26
FIT_ANCHORS = 4096
CLUSTERS = 64
CLUSTER_ANCHORS = 128
"""Anchors per cluster on average, while there are fewer than CLUSTERS clusters."""
BLOCK, CHUNK = 1024, 2048
_STEP = 512
_SLACK = 1e-6


def usable(rows: DataFrame) -> DataFrame:
    """``vec_id, label, dim, q`` of the rows that take part, labels shifted where the id is divisible by 7."""
    x = F.col("embedding")
    number = lambda v: v.cast("double")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(number(v)) | (F.abs(number(v)) > LARGEST / SCALE))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).cast("long")
    fit = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull()).where(~bad)
    q = F.transform(x, lambda v: F.floor(SCALE * number(v)).cast("int"))
    one = fit.select(F.col("vec_id").cast("long").alias("vec_id"), F.struct(label.alias("label"), q.alias("q")).alias("r"))
    one = one.groupBy("vec_id").agg(F.min("r").alias("r"))
    return one.select("vec_id", "r.label", F.size("r.q").alias("dim"), "r.q")


def centers(sample: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Directions of ``k`` clusters of unit vectors, the first ones spread out, then moved to their members' mean."""
    found = [sample[0]]
    nearest = sample @ found[0]
    while len(found) < min(k, len(sample)):
        found.append(sample[int(np.argmin(nearest))])
        nearest = np.maximum(nearest, sample @ found[-1])
    now = np.array(found)
    for _ in range(rounds):
        own = np.argmax(sample @ now.T, axis=1)
        sums = np.zeros_like(now)
        np.add.at(sums, own, sample)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        now = np.where(size > 0, sums / np.maximum(size, 1e-300), now)
    return now


def _unit(q: np.ndarray) -> np.ndarray:
    return q / np.maximum(np.linalg.norm(q, axis=1, keepdims=True), 1e-300)


def _clustered(anchors: DataFrame) -> DataFrame:
    """Anchors with ``cluster``: the center next to each, per length of vector."""
    fitted = {}
    for dim, n in anchors.groupBy("dim").count().collect():
        if dim == 0:
            continue
        sample = anchors.where(F.col("dim") == dim).orderBy(F.xxhash64("vec_id"), "vec_id").limit(FIT_ANCHORS).select("q").toPandas()["q"]
        fitted[dim] = centers(_unit(np.array(sample.tolist(), dtype=np.float64)), min(CLUSTERS, -(-n // CLUSTER_ANCHORS)))

    @F.pandas_udf("int")
    def nearest(dim: pd.Series, q: pd.Series) -> pd.Series:
        return pd.Series([int(np.argmax(fitted[d] @ np.asarray(v, dtype=np.float64))) if d else 0 for d, v in zip(dim, q)], dtype="int32")

    return anchors.withColumn("cluster", nearest(F.col("dim"), F.col("q")))


_PACKED = pa.schema([("n", pa.int32()), ("ids", pa.binary()), ("labels", pa.binary()), ("vectors", pa.binary())])


def _pack(keys: dict) -> callable:
    """A function that turns a group's rows into one row of plain numbers, beside the group's keys."""

    def packed(key: tuple, table: pa.Table) -> pa.Table:
        ids, labels = (table.column(c).to_numpy().astype("<i8") for c in ("vec_id", "label"))
        vectors = table.column("q").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype("<i4")
        own = [pa.array([k.as_py()], t) for k, t in zip(key, keys.values())]
        values = [pa.array([len(ids)], pa.int32()), *(pa.array([v.tobytes()], pa.binary()) for v in (ids, labels, vectors))]
        return pa.Table.from_arrays([*own, *values], names=[*keys, *_PACKED.names])

    return packed


def _packed(rows: DataFrame, **keys: pa.DataType) -> DataFrame:
    """Rows grouped by the keys, each group, of bounded size, as one row of bytes."""
    schema = ", ".join([*(f"{k} {'int' if t == pa.int32() else 'long'}" for k, t in keys.items()), "n int, ids binary, labels binary, vectors binary"])
    return rows.groupBy(*keys).applyInArrow(_pack(keys), schema)


class Candidates:
    """One chunk's candidates in the order of a cluster's bound."""

    def __init__(self, ids, labels, vectors, center: np.ndarray, widest: float) -> None:
        norms = np.linalg.norm(vectors, axis=1)
        cosine = np.clip((vectors @ center) / np.maximum(norms, 1e-300), -1, 1)
        bound = norms * np.cos(np.maximum(0.0, np.arccos(cosine) - widest - _SLACK)) + _SLACK
        order = np.lexsort((ids, -bound))
        self.ids, self.labels, self.vectors, self.bound = ids[order], labels[order], vectors[order], bound[order]

    def __len__(self) -> int:
        return len(self.ids)


def _cluster_of(vectors: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
    """Direction of the middle of some anchors, the widest angle of one to it, and their lengths."""
    units = _unit(vectors)
    middle = units.sum(axis=0)
    size = np.linalg.norm(middle)
    middle = middle / size if size > 0 else np.eye(1, vectors.shape[1])[0]
    lengths = np.linalg.norm(vectors, axis=1)
    angles = np.arccos(np.clip(units @ middle, -1, 1))
    # a vector of zeros has no direction; all its scores are 0
    return middle, float(angles.max()), lengths


def _best(scores: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Places of the best few, by score, then by id."""
    if len(scores) > 4 * most:
        cut = np.partition(scores, len(scores) - most)[len(scores) - most]
        at = np.flatnonzero(scores >= cut)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))[:most]]


def walk(ids, labels, vectors, lists: Candidates, lengths, same: bool, take, floor) -> int:
    """Take members down the list in steps; ``take(member, scores, ids)`` gets the candidates of the same (or another) label that reach ``floor(member)``.

    A member leaves where the bound times its length is below its floor; equal is not below, so ties are seen. Returns the scores computed.
    """
    going, seen = np.arange(len(ids)), 0
    floating = exact(vectors, lists.vectors)
    limits = np.array([floor(m) for m in going], dtype=np.float64)
    for at in range(0, len(lists), _STEP):
        top = lists.bound[at] * lengths[going]
        going = going[top + _SLACK * np.abs(top) + _SLACK >= limits[going]]
        if not len(going):
            break
        part = slice(at, at + _STEP)
        left, right = vectors[going], lists.vectors[part].T
        scores = np.rint(left @ right).astype(np.int64) if floating else left.astype(np.int64) @ right.astype(np.int64)
        seen += scores.size
        hits = (scores >= limits[going][:, None]) & ((lists.labels[part][None, :] == labels[going][:, None]) == same)
        for k in np.flatnonzero(hits.any(axis=1)):
            m = going[k]
            take(m, scores[k, hits[k]], lists.ids[part][hits[k]])
            limits[m] = floor(m)
    return seen


def exact(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether products of these whole numbers are exact in floating point."""
    most = lambda v: float(np.abs(v).max()) if v.size else 0.0
    return most(a) * most(b) * max(1, a.shape[1]) < 2.0**53


def _unpacked(row, prefix: str, dim: int):
    ids, labels = (np.frombuffer(getattr(row, f"{prefix}_{c}"), dtype="<i8") for c in ("ids", "labels"))
    return ids, labels, np.frombuffer(getattr(row, f"{prefix}_vectors"), dtype="<i4").reshape(len(ids), dim).astype(np.float64)


def _positives(batches, most: int):
    """The best candidates of a member's own label in a chunk."""
    for batch in batches:
        out = []
        for row in batch.itertuples(index=False):
            ids, labels, vectors = _unpacked(row, "a", row.dim)
            center, widest, lengths = _cluster_of(vectors)
            lists = Candidates(*_unpacked(row, "c", row.dim), center, widest)
            best: list[tuple] = [(np.empty(0, np.int64), np.empty(0, np.int64))] * len(ids)

            def take(m, scores, names):
                others = names != ids[m]
                s, n = np.r_[best[m][0], scores[others]], np.r_[best[m][1], names[others]]
                at = _best(s, n, most)
                best[m] = s[at], n[at]

            walk(ids, labels, vectors, lists, lengths, True, take, lambda m: best[m][0][-1] if len(best[m][0]) == most else -np.inf)
            out += [(a, n, s) for a, (ss, ns) in zip(ids.tolist(), best) for s, n in zip(ss.tolist(), ns.tolist())]
        yield pd.DataFrame(out, columns=["anchor_id", "positive_id", "positive_score"], dtype="int64")


def _negatives(batches, most: int, low: int, high: int):
    """The best candidates of other labels in a chunk, for each of a member's positives."""
    for batch in batches:
        out = []
        for row in batch.itertuples(index=False):
            ids, labels, vectors = _unpacked(row, "a", row.dim)
            center, widest, lengths = _cluster_of(vectors)
            lists = Candidates(*_unpacked(row, "c", row.dim), center, widest)
            wanted: dict[int, list[int]] = {}
            for a, s in zip(row.anchors, row.scores):
                wanted.setdefault(int(a), []).append(int(s))
            limits = [sorted(set(wanted.get(a, []))) for a in ids.tolist()]
            best = {(m, p): (np.empty(0, np.int64), np.empty(0, np.int64)) for m, ps in enumerate(limits) for p in ps}

            def take(m, scores, names):
                for p in limits[m]:
                    inside = (low * p <= 100 * scores) & (100 * scores <= high * p)
                    if inside.any():
                        s, n = np.r_[best[m, p][0], scores[inside]], np.r_[best[m, p][1], names[inside]]
                        at = _best(s, n, most)
                        best[m, p] = s[at], n[at]

            def floor(m):
                least = np.inf
                for p in limits[m]:
                    full = best[m, p][0]
                    least = min(least, full[-1] if len(full) == most else low * p / 100 - _SLACK * (1 + abs(p)))
                return least

            walk(ids, labels, vectors, lists, lengths, False, take, floor)
            out += [(int(ids[m]), p, n, s) for (m, p), (ss, ns) in best.items() for s, n in zip(ss.tolist(), ns.tolist())]
        yield pd.DataFrame(out, columns=["anchor_id", "positive_score", "negative_id", "negative_score"], dtype="int64")


def _in_parts(rows: DataFrame, by: list[str], most: int, out: str) -> DataFrame:
    """A part of about ``most`` rows within each group ``by``, by hash of the id. Groups are lengths of vectors and their clusters, so their sizes are broadcast."""
    sizes = rows.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / most).alias("_parts"))
    return rows.join(F.broadcast(sizes), by).withColumn(out, F.pmod(F.xxhash64("vec_id"), F.col("_parts")).cast("int")).drop("_parts")


def _met(blocks: DataFrame, chunks: DataFrame, tasks: int, *more: str) -> DataFrame:
    """Each block of anchors beside each chunk of candidates of its length, dealt by chunk."""
    counts = chunks.groupBy("dim").agg(F.max("chunk").alias("last"))
    spread = blocks.join(F.broadcast(counts), "dim").withColumn("chunk", F.explode(F.sequence(F.lit(0), "last")))
    a = spread.select("dim", "chunk", *more, *[F.col(c).alias(f"a_{c}") for c in ("ids", "labels", "vectors")])
    c = chunks.select("dim", "chunk", *[F.col(c).alias(f"c_{c}") for c in ("ids", "labels", "vectors")])
    return c.repartition(tasks, "dim", "chunk").hint("merge").join(a.repartition(tasks, "dim", "chunk"), ["dim", "chunk"])


def _top(rows: DataFrame, by: list[str], score: str, name: str, most: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.col(score).desc(), F.col(name)))
    return rows.withColumn("rank", rank).where(F.col("rank") <= most)


def mine(
    rows: DataFrame, is_anchor: Column | None = None, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` of every anchor of ``vec_id, embedding, label``.

    ``is_anchor``: a condition on ``vec_id``; every hundredth id if not given.
    """
    small_batches(rows.sparkSession)
    candidates = store(usable(rows), "mining-rows")
    tasks = max(1, -(-candidates.count() // CHUNK))
    anchors = candidates.where(F.col("vec_id") % EVERY == 0 if is_anchor is None else is_anchor)
    clustered = store(_clustered(anchors), "mining-anchors")
    keys = {"dim": pa.int32(), "cluster": pa.int32(), "block": pa.int32()}
    blocks = store(_packed(_in_parts(clustered, ["dim", "cluster"], BLOCK, "block"), **keys), "mining-blocks")
    chunked = _in_parts(candidates, ["dim"], CHUNK, "chunk")
    chunks = store(_packed(chunked, dim=pa.int32(), chunk=pa.int32()), "mining-chunks")

    near = _met(blocks, chunks, tasks).mapInPandas(lambda b: _positives(b, positives), "anchor_id long, positive_id long, positive_score long")
    chosen = store(_top(near, ["anchor_id"], "positive_score", "positive_id", positives).drop("rank"), "mining-positives")

    # a block's members with the scores of their positives, at most a few per member
    where = _in_parts(clustered, ["dim", "cluster"], BLOCK, "block").select("dim", "cluster", "block", F.col("vec_id").alias("anchor_id"))
    limits = chosen.join(where.hint("merge"), "anchor_id").groupBy("dim", "cluster", "block").agg(
        F.collect_list(F.struct("anchor_id", "positive_score")).alias("l")
    )
    limited = blocks.join(limits.hint("merge"), ["dim", "cluster", "block"])
    limited = limited.withColumn("anchors", F.col("l.anchor_id")).withColumn("scores", F.col("l.positive_score"))
    schema = "anchor_id long, positive_score long, negative_id long, negative_score long"
    hard = _met(limited, chunks, tasks, "anchors", "scores").mapInPandas(lambda b: _negatives(b, negatives, low, high), schema)
    hard = _top(hard, ["anchor_id", "positive_score"], "negative_score", "negative_id", negatives)
    out = chosen.join(hard.hint("merge"), ["anchor_id", "positive_score"])
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
