"""How five text filters interact, in every order, with duplicates found by radix tries of whole texts.

Filters, each named by its failure: A under 200 words; B fewer distinct words than half the words; C over 3 % letters A-Z; D one of ``#$%&*|``;
E a text that a smaller doc_id has. A to D follow from the text alone.

Duplicates: each task inserts the texts it reads into a compressed trie that holds the least id at the end of each text, and hands on one row per
distinct text whenever the trie is full, so a text of any number of copies leaves a task a few times at most. These rows go to ranges of text prefixes:
a prefix is made longer, step by step, as long as too many rows share it. Per range the tries are built again from whole texts, prefix after prefix, and
traversed for the least id of each text. A document fails E if its id is larger than that.

Masks of failures are counted per part, and all 120 orders of the filters are derived from those counts, of which there are at most 128 per part.

Defined results: a NULL text is empty, a NULL lang is part ''; documents without an id are neither earlier nor later than any, so they neither fail E nor
make others fail; rows that share id and text do not fail by each other; of several labels for an id a 1 counts; labels without a document
and NULL labels count nowhere; no documents give no rows; very long texts count whole; other columns, whatever their names, are not read.
"""

from __future__ import annotations

from itertools import permutations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mentionkit.llm.common import small_batches, text_of
from mentionkit.sources.shared import store

FILTERS = "ABCDE"
LEAST_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT, SYMBOLS = 200, 50, 3, "#$%&*|"
TRIE_BYTES = 16 << 20
"""Characters after which a task's trie is handed on."""
PREFIXES = (8, 32, 128, 512, 2048, 8192)
"""Steps of prefix length; a text whose longest prefix is still crowded goes by all of it."""
CROWDED = 64
"""A prefix is crowded if it has more rows than this part of what a range holds on average."""
_CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def mask(text: str) -> int:
    """Bits 0 to 3 for failing A to D."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes: ASCII white space only
    bits = len(words) < LEAST_WORDS
    bits |= (100 * len(set(words)) < DISTINCT_PERCENT * len(words)) << 1
    bits |= (100 * (len(raw) - len(raw.translate(None, _CAPITALS))) > CAPITAL_PERCENT * len(text)) << 2
    bits |= any(s in text for s in SYMBOLS) << 3
    return int(bits)


def _common(a: str, b: str, at: int) -> int:
    """Length of what ``a`` shares with ``b`` from place ``at`` of ``b`` on."""
    low, high = 0, min(len(a), len(b) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if b.startswith(a[low:middle], at + low):
            low = middle
        else:
            high = middle - 1
    return low


class Trie:
    """A compressed trie: an edge is a string; a node has edges by first character and, where a text ends, ``least`` and a payload."""

    __slots__ = ("root", "size")

    def __init__(self) -> None:
        self.root: list = [{}, None, None]
        self.size = 0

    def insert(self, text: str, least, payload) -> None:
        """Put a text in; of equal texts the smaller ``least`` stays, None counting as none."""
        node, at = self.root, 0
        while at < len(text):
            edge = node[0].get(text[at])
            if edge is None:
                new: list = [{}, None, None]
                node[0][text[at]] = (text[at:], new)
                self.size += len(text) - at + 64
                node, at = new, len(text)
                break
            label, child = edge
            if text.startswith(label, at):
                node, at = child, at + len(label)
                continue
            same = _common(label, text, at)
            middle: list = [{label[same]: (label[same:], child)}, None, None]
            node[0][text[at]] = (label[:same], middle)
            self.size += 64
            node, at = middle, at + same
        if node[2] is None or (least is not None and (node[1] is None or least < node[1])):
            node[1] = least
        node[2] = payload

    def ends(self):
        """Every text with its least id and payload, in no given order."""
        stack = [("", self.root)]
        while stack:
            text, (edges, least, payload) = stack.pop()
            if payload is not None:
                yield text, least, payload
            stack.extend((text + label, child) for label, child in edges.values())


_READ = "doc_id long, part string, mask int, hash long, text string"


def _read_batch(rows: list) -> pd.DataFrame:
    # by column with its type, as a list of numbers and None would become floats
    types = {"doc_id": "Int64", "part": object, "mask": "Int32", "hash": "Int64", "text": object}
    columns = zip(*rows) if rows else ([] for _ in types)
    return pd.DataFrame({name: pd.array(list(c), dtype=t) for (name, t), c in zip(types.items(), columns)})


def _least_batch(rows: list) -> pd.DataFrame:
    return pd.DataFrame({name: pd.array([r[k] for r in rows], dtype="Int64") for k, name in enumerate(("hash", "least"))})


def _read(batches):
    """A row per document with its mask, and a row per distinct text of the task's trie with its least id."""

    def handed_on(trie: Trie):
        rows, size = [], 0
        for text, least, payload in trie.ends():
            rows.append((least, None, None, payload, text))
            size += len(text)
            if size > 4 << 20:
                yield _read_batch(rows)
                rows, size = [], 0
        if rows:
            yield _read_batch(rows)

    trie = Trie()
    for batch in batches:
        docs = []
        # ids come as text, as a column with NULLs would turn into floats
        for doc, part, hashed, text in zip(batch["doc_id"], batch["part"], batch["hash"].tolist(), batch["text"]):
            doc = None if doc is None else int(doc)
            docs.append((doc, part, mask(text), hashed, None))
            trie.insert(text, doc, hashed)
            if trie.size >= TRIE_BYTES:
                yield from handed_on(trie)
                trie = Trie()
        yield _read_batch(docs)
    yield from handed_on(trie)


def _firsts(batches):
    """Rows in order of their prefix to ``hash, least``, one per distinct text."""
    trie, now = Trie(), None
    for batch in batches:
        done = []
        for prefix, least, hashed, text in zip(batch["prefix"].tolist(), batch["least"], batch["hash"].tolist(), batch["text"]):
            if prefix != now and trie.size >= TRIE_BYTES:
                # equal texts have equal prefixes, so none of these comes again
                done.extend((h, m) for _, m, h in trie.ends())
                trie = Trie()
            now = prefix
            trie.insert(text, None if least is None else int(least), hashed)
        yield _least_batch(done)
    yield _least_batch([(h, m) for _, m, h in trie.ends()])


def _ranges(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def with_prefix(texts: DataFrame) -> DataFrame:
    """Add ``prefix``: the shortest step of the text that is not crowded.

    The crowded ones of a step are fewer than ``CROWDED`` times the number of ranges, whatever the size of the table, so they are broadcast, as hashes.
    """
    most = max(1, texts.count() // (CROWDED * _ranges(texts.sparkSession)))
    rows = texts.withColumn("cut", F.lit(PREFIXES[0]))
    for length, longer in zip(PREFIXES, (*PREFIXES[1:], (1 << 31) - 1)):
        key = F.xxhash64(F.left(F.col("text"), F.lit(length)))
        reached = (F.col("cut") == length) & (F.length("text") > length)
        counts = rows.where(reached).groupBy(key.alias("_key")).agg(F.count(F.lit(1)).alias("n"))
        crowded = store(counts.where(F.col("n") > most).select("_key"), "audit-crowded")
        if crowded.isEmpty():
            break
        hit = rows.join(F.broadcast(crowded), reached & (key == F.col("_key")), "left")
        rows = hit.withColumn("cut", F.when(F.col("_key").isNotNull(), F.lit(longer)).otherwise(F.col("cut"))).drop("_key")
    return rows.withColumn("prefix", F.left(F.col("text"), F.col("cut")))


def first_ids(texts: DataFrame) -> DataFrame:
    """``doc_id, hash, text`` (several rows per text) to ``hash, least``: the least id of each distinct text, compared whole."""
    small_batches(texts.sparkSession)
    rows = with_prefix(texts.where("doc_id IS NOT NULL")).select("prefix", F.col("doc_id").cast("string").alias("least"), "hash", "text")
    # ranges of prefixes; within one the same prefix comes in one go
    dealt = rows.repartitionByRange(_ranges(texts.sparkSession), "prefix").sortWithinPartitions("prefix")
    return dealt.mapInPandas(_firsts, "hash long, least long")


def masks(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, part, mask`` with bit 4 for E."""
    small_batches(docs.sparkSession)
    part = F.coalesce(F.col("lang").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), part.alias("part"), F.xxhash64(text_of()).alias("hash"), text_of().alias("text"))
    read = store(rows.mapInPandas(_read, _READ), "audit-read")
    firsts = first_ids(read.where("text IS NOT NULL").select("doc_id", "hash", "text"))
    # an id and the hash of its own text name the text; that texts are equal was decided on the texts
    firsts = store(firsts.select(F.col("least").alias("_id"), F.col("hash").alias("_hash")), "audit-firsts")
    narrow = read.where("text IS NULL").select("doc_id", "part", "mask", "hash")
    met = narrow.join(firsts.hint("merge"), (F.col("doc_id") == F.col("_id")) & (F.col("hash") == F.col("_hash")), "left")
    later = F.col("doc_id").isNotNull() & F.col("_id").isNull()
    return met.select("doc_id", "part", F.col("mask").bitwiseOR(F.when(later, F.lit(16)).otherwise(F.lit(0))).alias("mask"))


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, good, toxic, n``: documents by what they fail and how they are labelled."""
    one = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)))
    marked = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_id")).agg(one("quality").alias("good"), one("toxic").alias("toxic"))
    rows = masks(docs).join(marked.hint("merge"), F.col("doc_id") == F.col("_id"), "left")
    rows = rows.select("part", "mask", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")])
    return rows.groupBy("part", "mask", "good", "toxic").agg(F.count(F.lit(1)).alias("n"))


def _steps(spark: SparkSession) -> DataFrame:
    """Every order and step, 600 rows: the filter's bit and the bits of those before it."""
    rows = []
    for order in permutations(range(len(FILTERS))):
        for k, f in enumerate(order):
            rows.append(("".join(FILTERS[g] for g in order), k + 1, 1 << f, sum(1 << g for g in order[:k])))
    return spark.createDataFrame(rows, "filter_order string, step int, bit int, before int")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order and step: ``kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley``, zeros included."""
    counts = store(mask_counts(docs, labels), "audit-counts")
    bits = F.explode(F.array(*[F.lit(1 << k) for k in range(len(FILTERS))]))
    rows = counts.withColumn("bit", bits).join(F.broadcast(_steps(docs.sparkSession)), "bit")
    fails = F.col("mask").bitwiseAND(F.col("bit")) != 0
    gone = F.col("mask").bitwiseAND(F.col("before")) != 0
    removed = fails & ~gone
    total = lambda condition, value=F.col("n"): F.sum(F.when(condition, value).otherwise(F.lit(0))).cast("long")
    # of a document's failing filters each is the first in an equal share of all orders
    orders = 1
    for k in range(2, len(FILTERS) + 1):
        orders *= k
    return rows.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~gone).alias("kept"),
        total(removed).alias("removed"),
        total(fails & gone).alias("redundant"),
        total(F.col("mask") == F.col("bit")).alias("unique_fails"),
        total(removed & F.col("good")).alias("good_lost"),
        total(removed & F.col("toxic")).alias("toxic_lost"),
        total(fails, (F.col("n") * orders / F.greatest(F.bit_count("mask"), F.lit(1))).cast("long")).alias("shapley"),
    )
