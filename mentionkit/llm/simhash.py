"""SimHash fingerprints, and groups of texts whose fingerprints differ in at most three bits.

Exact copies fall together first: everything after the fingerprint works on distinct ones. Two fingerprints that differ in three bits or fewer
agree on at least two of five pieces, so they share one of ten blocks: ten choices of two pieces, with the bits of those. A block of many members is
not compared pair by pair but split in the same way over the bits it leaves open (three of six pieces), until at most 12 bits are open; then it has
4,096 members at most, whatever the data. Members of a block are compared bit by bit, and only links that join something new within
the block leave it, at most one less than it has members; as links, these give the same groups as all pairs.

Defined results: NULL text is empty; a text without words has fingerprint zero and is linked like any other; repeated rows and ties fall
together; no documents give no rows. Other columns are not read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mentionkit.llm.common import small_batches, text_of
from mentionkit.llm.components import components
from mentionkit.sources.shared import store

SHINGLE = 3
DISTANCE = 3
SEED = 42
BLOCK_MOST = 4096
"""Members of a block that are compared directly; a block of at most 12 open bits never has more."""
_CHUNK = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """A bit is set if it is set in over half of the shingles' hashes; signed 64 bits."""
    words = text.lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    if len(words) < shingle:
        words, shingle = [b" ".join(words)], 1
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - shingle + 1].tolist()
    ends = ends[shingle - 1 :].tolist()
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(starts), _CHUNK):
        part = [digest(joined[s:e], SEED) for s, e in zip(starts[at : at + _CHUNK], ends[at : at + _CHUNK])]
        raw = np.array(part, dtype="<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(starts), bitorder="little")
    return int(bits.view("<i8")[0])


def with_fingerprint(docs: DataFrame, name: str = "fp", shingle: int = SHINGLE) -> DataFrame:
    small_batches(docs.sparkSession)

    @F.pandas_udf("long")
    def prints(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return docs.withColumn(name, prints.asNondeterministic()(F.encode(text_of(), "UTF-8")))


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _pieces(open_bits: list[int], n: int) -> list[int]:
    """Masks of ``n`` runs of the given bits, as even as can be."""
    cuts = [len(open_bits) * i // n for i in range(n + 1)]
    return [sum(1 << b for b in open_bits[i:j]) for i, j in zip(cuts, cuts[1:])]


def finer(mask: int, distance: int = DISTANCE) -> list[int]:
    """Masks of more bits, of which any two fingerprints that agree on ``mask`` and differ in ``distance`` bits share one."""
    open_bits = [b for b in range(64) if not mask >> b & 1]
    n = distance + (2 if mask == 0 else 3)
    return [mask | sum(chosen) for chosen in combinations(_pieces(open_bits, n), n - distance)]


def _levels(distance: int) -> list[list[int]]:
    """Masks by level; at the last one at most 12 bits are open."""
    levels = [finer(0, distance)]
    while any(64 - m.bit_count() > BLOCK_MOST.bit_length() - 1 for m in levels[-1]):
        levels.append(sorted({f for m in levels[-1] for f in finer(m, distance)}))
    return levels


def _spread(values: list[int]) -> Column:
    return F.explode(F.array(*[F.lit(_signed(v)) for v in values]))


def _forest(batches, distance: int):
    """Per block the links that join its members into groups, found by comparing whole blocks of numbers."""
    for batch in batches:
        a, b = [], []
        for members in batch["members"]:
            rest = np.sort(np.asarray(members, dtype=np.int64)).view(np.uint64)
            todo: list = []
            while len(rest):
                if not todo:
                    todo, rest = [rest[0]], rest[1:]
                    continue
                one = todo.pop()
                near = np.bitwise_count(rest ^ one) <= distance
                if near.any():
                    found = rest[near]
                    a.extend([one] * len(found))
                    b.extend(found)
                    todo.extend(found)
                    rest = rest[~near]
        yield pd.DataFrame({"a": np.array(a, dtype=np.uint64).view(np.int64), "b": np.array(b, dtype=np.uint64).view(np.int64)})


def links(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Distinct fingerprints ``fp`` to links ``a, b`` that join exactly the groups of all pairs within ``distance`` bits."""
    small_batches(prints.sparkSession)
    levels = _levels(distance)
    rows = prints.select("fp", _spread(levels[0]).alias("mask"))
    parts = []
    for k, masks in enumerate(levels):
        if k:
            # only members of crowded blocks come here, each with the finer masks of its block's mask
            table = F.create_map(*[x for m in levels[k - 1] for x in (F.lit(_signed(m)), F.array(*[F.lit(_signed(f)) for f in finer(m, distance)]))])
            rows = rows.select("fp", F.explode(F.element_at(table, F.col("mask"))).alias("mask"))
        rows = rows.withColumn("block", F.col("fp").bitwiseAND(F.col("mask")))
        sizes = rows.groupBy("mask", "block").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        shared = store(rows.join(sizes, ["mask", "block"]), "simhash-blocks")
        if k + 1 < len(levels):
            small, crowded = shared.where(F.col("n") <= BLOCK_MOST), shared.where(F.col("n") > BLOCK_MOST)
        else:
            small, crowded = shared, None
        grouped = small.groupBy("mask", "block").agg(F.collect_list("fp").alias("members")).select("members")
        parts.append(grouped.mapInPandas(lambda batches: _forest(batches, distance), "a long, b long"))
        if crowded is None or crowded.isEmpty():
            break
        rows = crowded.select("fp", "mask").distinct()
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out.distinct()


def near_groups(docs: DataFrame, distance: int = DISTANCE, shingle: int = SHINGLE) -> DataFrame:
    """One row per document: ``doc_id, fp, component_id``, the least doc_id it is linked to, itself included."""
    prints = store(with_fingerprint(docs.select("doc_id", "text"), "fp", shingle).select("doc_id", "fp"), "simhash-prints")
    classes = store(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-classes")
    roots = components(store(links(classes.select("fp"), distance), "simhash-links"))
    named = classes.join(roots, classes["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = store(named, "simhash-roots")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    groups = named.join(least, "root").select("fp", "component_id")
    return prints.join(groups, "fp").select("doc_id", "fp", "component_id")


def hex_of(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def group_report(docs: DataFrame) -> DataFrame:
    return near_groups(docs).select("doc_id", hex_of(F.col("fp")).alias("fingerprint"), "component_id")


def by_fingerprint(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, hash, root``, the text's hash and its group of fingerprints."""
    prints = with_fingerprint(docs.select("doc_id", "text")).select("doc_id", F.xxhash64(text_of()).alias("hash"), "fp")
    prints = store(prints, "simhash-prints")
    roots = components(store(links(prints.select("fp").distinct()), "simhash-links"))
    rows = prints.join(roots, F.col("fp") == F.col("node"), "left")
    return store(rows.select("doc_id", "hash", F.coalesce("root", "fp").alias("root")), "simhash-roots")


def one_per_group(docs: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """One row of each group: of least doc_id, those without an id last, then of least text hash. Of rows alike in both one stays, by the hash of all columns.

    ``groups``: rows ``doc_id, hash, root``, one per document; those of the fingerprints if not given. A row is known by its id and its text's
    hash, so neither a missing nor a shared id loses a group. Only narrow rows are grouped; the texts are shuffled once, to meet the list of kept rows.
    """
    groups = by_fingerprint(docs) if groups is None else groups
    rows = groups.groupBy("root", "doc_id", "hash").agg(F.count(F.lit(1)).alias("n"))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "hash", "n")).alias("k")
    kept = store(rows.groupBy("root").agg(least).select(F.col("k.doc_id").alias("_id"), F.col("k.hash").alias("_hash"), F.col("k.n").alias("_n")), "simhash-kept")
    own = [F.col(f"d.`{c}`") for c in docs.columns]
    # one plan at every size: the rows to keep are nearly as many as the documents, so both sides are shuffled once
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64(text_of()) == F.col("_hash"))
    out = docs.alias("d").join(kept.hint("merge"), same)
    ties = out.where("_n > 1").groupBy("_id", "_hash").agg(F.min_by(F.struct(*own), F.xxhash64(*own)).alias("_r"))
    return out.where("_n = 1").select("d.*").unionAll(ties.select("_r.*"))
