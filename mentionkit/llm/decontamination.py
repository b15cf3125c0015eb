"""Find benchmark passages in documents by greedy string tiling, also where their parts were put in another order.

Both sides become lower-case words, a character of a script without spaces being a word of its own, and every five words a running hash (Karp and
Rabin); an item of fewer words has one hash, of all its words. A bit table of fixed size, filled from the benchmark's hashes, drops nearly all of a
document's hashes where they arise; it is the only thing broadcast. What is left meets the benchmark's distinct hashes, and per document and item the
shared seeds are tiled: the longest run of words that both hold is marked, then the longest of what is left unmarked, until none of five words is
left (or of the whole item, if it is shorter). Runs are found by running hashes of seeds, so places that repeat are never paired with each
other. An item's coverage is the share of its words under tiles.

Defined results: NULL and empty texts and items without words match nothing; ids may be of any type and come back unchanged, NULL too; of documents that
share an id each is compared by itself and the best coverage counts; repeated rows give one row; empty tables give no rows; very long and very
repetitive texts are compared whole; other columns, whatever their names, are not read. A seed of 64 bits stands for its words.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mentionkit.llm.common import small_batches, text_of
from mentionkit.sources.shared import store

SEED_WORDS = 5
COVERAGE = 0.5
"""Share of an item's words from which a document counts as contaminated."""
TABLE_BITS = 22
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
# Thai, Lao, Myanmar, Khmer; kana; Han: scripts written without spaces
_UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff"
_TOKEN = re.compile(rf"[{_UNSPACED}]|[^\W{_UNSPACED}]+")
_CACHE_MOST = 200_000


def words(text: str) -> list[str]:
    return _TOKEN.findall(text.lower())


def seeds(found: list[str], cache: dict[str, int], width: int = SEED_WORDS) -> np.ndarray:
    """The running hash of every ``width`` words, signed 64 bits."""
    n = len(found) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.int64)
    if len(cache) > _CACHE_MOST:
        cache.clear()
    for w in set(found):
        if w not in cache:
            cache[w] = xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"), 5)
    h = np.fromiter((cache[w] for w in found), dtype=np.uint64, count=len(found))
    # hashes of different widths have nothing to do with each other
    out = np.full(n, SEED_WORDS - width, dtype=np.uint64)
    for j in range(width):
        out = out * _BASE + h[j : j + n]
    out ^= out >> np.uint64(32)
    out *= _BASE
    return out.view(np.int64)


def _place(hashes: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Where in a table of a power of two the hashes belong: their first bits."""
    return (hashes.view(np.uint64) >> np.uint64(65 - len(table).bit_length())).astype(np.int64)


def _seed_rows(df: DataFrame, key: str, widths: list[int] | None, table=None) -> DataFrame:
    """``key`` as text, ``version``, ``n_words``, and arrays ``pos, seed``; without ``widths`` of five words or all there are, with a table only seeds whose bit is set.

    ``version`` tells texts of one key apart.
    """
    small_batches(df.sparkSession)

    @F.pandas_udf("struct<n: int, pos: array<int>, seed: array<long>>")
    def found(texts: pd.Series) -> pd.DataFrame:
        cache: dict[str, int] = {}
        bits = table.value if table is not None else None
        out = []
        for t in texts:
            w = words(t)
            parts = []
            for width in widths or [max(1, min(SEED_WORDS, len(w)))]:
                h = seeds(w, cache, width)
                pos = np.arange(len(h)) if bits is None else np.flatnonzero(bits[_place(h, bits)])
                parts.append((pos.astype(np.int32), h[pos]))
            out.append((len(w), *(np.concatenate(x) for x in zip(*parts))))
        return pd.DataFrame(out, columns=["n", "pos", "seed"])

    rows = df.select(F.col(key).cast("string").alias(key), F.xxhash64("text").alias("version"), found.asNondeterministic()(text_of()).alias("f"))
    return rows.select(key, "version", F.col("f.n").alias("n_words"), "f.pos", "f.seed")


class _Runs:
    """Seeds in a row, some of them taken, with hashes of any number that follow each other."""

    def __init__(self, seed: np.ndarray, place: np.ndarray) -> None:
        self.place, self.free = place, np.ones(len(seed), dtype=bool)
        powers = np.cumprod(np.r_[np.uint64(1), np.full(max(0, len(seed) - 1), _BASE)])[: len(seed)]
        self.back = np.cumprod(np.r_[np.uint64(1), np.full(max(0, len(seed) - 1), _INVERSE)])[: len(seed)]
        self.sums = np.r_[np.uint64(0), np.cumsum(seed.view(np.uint64) * powers, dtype=np.uint64)]

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Where ``n`` free seeds follow each other without a gap, and the hashes of those."""
        last = len(self.place) - n + 1
        if last <= 0:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
        taken = np.r_[0, np.cumsum(~self.free)]
        whole = (self.place[n - 1 :] - self.place[:last] == n - 1) & (taken[n:] == taken[:last])
        at = np.flatnonzero(whole)
        return at, (self.sums[at + n] - self.sums[at]) * self.back[at]

    def take(self, start: int, end: int) -> None:
        self.free[np.searchsorted(self.place, start) : np.searchsorted(self.place, end)] = False


def _longest(item: _Runs, doc: _Runs) -> tuple[int, int, int] | None:
    """The longest common run: its place in the item, in the document, and its seeds. Of equals the first in the item, then in the document."""

    def common(n: int):
        (i, a), (j, b) = item.of(n), doc.of(n)
        shared = np.flatnonzero(np.isin(a, b))
        return (i, a, j, b, shared[0]) if len(shared) else None

    found = common(1)
    if found is None:
        return None
    low, step = 1, 1
    # a run of n holds one of n - 1
    while (more := common(low + step)) is not None:
        low, found, step = low + step, more, 2 * step
    high = low + step
    while high - low > 1:
        middle = (low + high) // 2
        more = common(middle)
        if more is None:
            high = middle
        else:
            low, found = middle, more
    i, a, j, b, first = found
    return int(item.place[i[first]]), int(doc.place[j[np.flatnonzero(b == a[first])[0]]]), low


def tiles(item: np.ndarray, pos: np.ndarray, doc: np.ndarray, width: int = SEED_WORDS) -> list[tuple[int, int, int]]:
    """Greedy tiling of an item's seeds and a document's seeds at ``pos``: tiles (item start, document start, words)."""
    order = np.argsort(pos, kind="stable")
    ours, theirs = _Runs(item, np.arange(len(item))), _Runs(doc[order], pos[order].astype(np.int64))
    out = []
    while (best := _longest(ours, theirs)) is not None:
        i, j, run = best
        size = run + width - 1
        out.append((i, j, size))
        # seeds that hold a marked word are gone
        ours.take(i - width + 1, i + size)
        theirs.take(j - width + 1, j + size)
    return out


def _tiled(batches):
    for batch in batches:
        out = []
        for doc, item, n, pos, found, own in zip(*(batch[c] for c in ("doc_id", "item_id", "n_words", "pos", "seed", "own"))):
            marked = tiles(np.asarray(own), np.asarray(pos), np.asarray(found), min(SEED_WORDS, int(n)))
            covered = sum(size for _, _, size in marked)
            out.append((doc, item, covered / n, len(marked), max(size for _, _, size in marked), covered))
        yield pd.DataFrame(out, columns=["doc_id", "item_id", "coverage", "n_tiles", "longest", "words"])


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, coverage, n_tiles, longest, words`` of every pair with a shared seed, best version of each."""
    spark = docs.sparkSession
    items = store(_seed_rows(benchmark.select("item_id", "text"), "item_id", None).distinct().where("n_words > 0"), "bench-seeds")
    own = items.select("item_id", F.col("version").alias("item_version"), F.explode("seed").alias("seed")).distinct()
    # at most 2^TABLE_BITS small numbers, whatever the benchmark's size
    places = own.select(F.shiftrightunsigned("seed", 64 - TABLE_BITS).cast("int").alias("p")).distinct()
    bits = np.zeros(1 << TABLE_BITS, dtype=bool)
    bits[places.toPandas()["p"].to_numpy(dtype=np.int64)] = True
    widths = sorted(r[0] for r in items.select(F.least("n_words", F.lit(SEED_WORDS))).distinct().collect()) or [SEED_WORDS]
    found = _seed_rows(docs.select("doc_id", "text"), "doc_id", widths, spark.sparkContext.broadcast(bits))
    pairs = F.explode(F.arrays_zip("pos", F.col("seed").alias("seed"))).alias("p")
    found = found.select("doc_id", F.col("version").alias("doc_version"), pairs).select("doc_id", "doc_version", F.col("p.pos").alias("pos"), F.col("p.seed").alias("seed"))
    shared = found.join(own, "seed")
    # a document and an item meet in one row, as long as the document's seeds that the item has
    keys = ["doc_id", "doc_version", "item_id", "item_version"]
    grouped = shared.groupBy(*keys).agg(F.collect_set(F.struct("pos", "seed")).alias("p"))
    packed = items.select(F.col("item_id").alias("_item"), F.col("version").alias("_version"), "n_words", F.col("seed").alias("own"))
    met = grouped.join(packed, F.col("item_id").eqNullSafe(F.col("_item")) & (F.col("item_version") == F.col("_version")))
    met = met.select("doc_id", "item_id", "n_words", F.col("p.pos").alias("pos"), F.col("p.seed").alias("seed"), "own")
    tiled = met.mapInPandas(_tiled, "doc_id string, item_id string, coverage double, n_tiles int, longest int, words int")
    best = F.max_by(F.struct("coverage", "n_tiles", "longest", "words"), F.struct("coverage", "longest", -F.col("n_tiles"))).alias("b")
    best = tiled.groupBy("doc_id", "item_id").agg(best)
    ids = [F.col(c).cast(df.schema[c].dataType).alias(c) for c, df in (("doc_id", docs), ("item_id", benchmark))]
    return best.select(*ids, "b.*")


def contaminated(docs: DataFrame, benchmark: DataFrame, least: float = COVERAGE) -> DataFrame:
    """One row per document and item of at least that coverage, with ``contaminated`` true."""
    return matches(docs, benchmark).where(F.col("coverage") >= least).withColumn("contaminated", F.lit(True))


def clean_documents(docs: DataFrame, benchmark: DataFrame, least: float = COVERAGE) -> DataFrame:
    """The documents whose own text is not contaminated, whatever their id, columns unchanged."""
    # the text's hash stands for the id, so that a missing or shared one neither hides a leak nor costs a clean row
    texts = docs.select(F.xxhash64("text").alias("doc_id"), "text")
    found = store(contaminated(texts, benchmark, least).select(F.col("doc_id").alias("_hash")).distinct(), "contaminated-texts")
    return docs.join(found, F.xxhash64("text") == F.col("_hash"), "left_anti").select(*docs.columns)
