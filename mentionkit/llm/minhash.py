"""Groups of texts whose sets of two-word shingles are 0.8 similar or more, by bottom-k sketches.

One hash function gives every shingle a number; a set's sketch is its ``SKETCH`` least numbers. Sets that are equal fall together first, and
everything after works on distinct sets, the classes.

Candidates: the sketches of a pair at 0.8 share at least ``_least_shared`` numbers but for a chance of 2 in 100 million (none if both sets are no
larger than their sketches). So, with each sketch in one order, rarest number first, such a pair shares one of the first few, and only these have inverted lists.
A list's members are compared with one of them, the lead, which is in the longest lists. What these links join is done. Short lists that still
hold several groups give the pairs between groups. Long lists of one lead are one block of sets, cut into tiles by size and hash; pairs of tiles are
compared on whole sets inside a task, and only links that join something new leave it.

Filter: the least numbers of the union of two sketches are a sample of the union of the sets; pairs whose share of common ones is too small for 0.8 go.
Check: every link is confirmed on the whole sets.

Defined results: NULL text is empty; a text without words is linked with nothing; one word alone is a set of one; repeated rows and rows that share an id
fall together by their texts; a group without any id has component NULL, and ``kept`` compares NULL-safely; no documents give no rows; of very long texts all
shingles count; other columns, whatever their names, are not read. A hash of 64 bits stands for its shingle and one of 128 bits for its set.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mentionkit.llm.common import small_batches, text_of
from mentionkit.llm.components import components
from mentionkit.sources.shared import store

SHINGLE = 2
SKETCH = 64
SEED = 42
PERCENT = 80
"""A link needs 100 * shared >= PERCENT * union."""
SHORT_LIST = 32
"""Members up to which a list's pairs are made; longer lists are compared in tiles."""
TILE_SETS, TILE_SHINGLES = 1024, 500_000
GROUP_SETS = 1024
"""Sets that one task compares with the same set."""
TABLE_BITS = 22
_DEVIATIONS = 5.5
_CHUNK = 1 << 16
_DENSE = 16
_COLUMNS = 4096


def shingles(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """The distinct hashes of a text's shingles in order, as signed 64 bits."""
    words = text.lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return np.empty(0, dtype=np.int64)
    if len(words) < shingle:
        words, shingle = [b" ".join(words)], 1
    digest, parts = xxhash.xxh64_intdigest, []
    for at in range(0, len(words) - shingle + 1, _CHUNK):
        part = words[at : at + _CHUNK + shingle - 1]
        found = {b" ".join(s) for s in zip(*[part[j:] for j in range(shingle)])}
        hashes = np.fromiter((digest(s, SEED) for s in found), dtype=np.uint64, count=len(found))
        parts.append(np.unique(hashes.view(np.int64)))
    return np.unique(np.concatenate(parts))


def _least_shared(sketch: int, percent: int) -> int:
    """Numbers that two full sketches share at that similarity, but for a negligible chance."""
    s = percent / 100
    return max(1, math.floor(sketch * s - _DEVIATIONS * math.sqrt(sketch * s * (1 - s))))


def _prefix(n: Column, sketch: int, percent: int) -> Column:
    """How many of a set's sketched numbers, in the common order, a partner has to meet one of; ``n`` is the set's size."""
    whole = F.ceil(n * percent / F.lit(100)).cast("int")
    shared = F.lit(_least_shared(sketch, percent))
    # a set a little smaller than its sketch may have a partner that is larger
    need = F.when(n * 100 < sketch * percent, whole).otherwise(F.least(whole, shared))
    return F.least(n, F.lit(sketch)) - need + 1


def _prints(docs: DataFrame, shingle: int, sketch: int) -> DataFrame:
    """``doc_id, hash, digest, n, sketch`` of every document."""

    @F.pandas_udf("struct<digest: binary, n: int, sketch: array<long>>")
    def prints(texts: pd.Series) -> pd.DataFrame:
        found = [shingles(t, shingle) for t in texts]
        rows = [(xxhash.xxh3_128_digest(f.tobytes()), len(f), f[:sketch]) for f in found]
        return pd.DataFrame(rows, columns=["digest", "n", "sketch"])

    rows = docs.select("doc_id", F.xxhash64(text_of()).alias("hash"), prints.asNondeterministic()(F.encode(text_of(), "UTF-8")).alias("p"))
    return rows.select("doc_id", "hash", "p.*")


def _classes(prints: DataFrame) -> DataFrame:
    """Distinct sets: ``set`` (a number), ``digest, n, sketch``, one document ``doc_id, hash`` that has it, and ``least``, its least id."""
    one = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "hash", "n", "sketch")).alias("c")
    rows = prints.where("n > 0").groupBy("digest").agg(one, F.min("doc_id").alias("least"))
    # numbered where written, so the number stays with the row
    return store(rows.select(F.monotonically_increasing_id().alias("set"), "digest", "c.doc_id", "c.hash", "c.n", "c.sketch", "least"), "minhash-classes")


def _lists(classes: DataFrame, sketch: int, percent: int) -> DataFrame:
    """``value, set, n, m``: the inverted lists of more than one member, ``m`` their length."""
    postings = classes.select("set", "n", F.explode("sketch").alias("value"))
    counts = postings.groupBy("value").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    live = postings.join(counts.hint("merge"), "value")
    # numbers of one set only come first in the order and have no list
    own = live.groupBy("set", "n").agg(F.sort_array(F.collect_list(F.struct("df", "value"))).alias("v"))
    left = _prefix(F.col("n"), sketch, percent) - (F.least("n", F.lit(sketch)) - F.size("v"))
    kept = own.where(left > 0).select("set", "n", F.explode(F.slice("v", 1, left)).alias("v")).select("v.value", "set", "n")
    kept = store(kept, "minhash-postings")
    sizes = kept.groupBy("value").agg(F.count(F.lit(1)).alias("m")).where("m > 1").hint("merge")
    return store(kept.join(sizes, "value"), "minhash-lists")


def _similar_size(a: Column, b: Column, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def union_estimate(a: str, b: str, sketch: int) -> tuple[Column, Column]:
    """Of the least numbers of the union of two sketches: how many are in both, and how many there are."""
    union = F.slice(F.array_sort(F.array_union(a, b)), 1, sketch)
    return F.size(F.array_intersect(union, F.array_intersect(a, b))), F.size(union)


def _filtered(pairs: DataFrame, classes: DataFrame, sketch: int, percent: int) -> DataFrame:
    """Pairs ``a, b`` that the sketches do not rule out, with ``sure`` where both sketches are whole sets."""
    # stored pairs are known by their bytes: few are broadcast to the sketches, many meet them in a shuffle
    first = classes.select(F.col("set").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa")).join(pairs, "a")
    second = classes.select(F.col("set").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb")).join(pairs, "b")
    both = first.join(second.hint("merge"), ["a", "b"])
    whole = F.greatest("na", "nb") <= sketch
    shared, seen = union_estimate("sa", "sb", sketch)
    meet = F.size(F.array_intersect("sa", "sb"))
    exact = meet * 100 >= (F.col("na") + F.col("nb") - meet) * percent
    likely = F.when(whole, exact).otherwise(shared >= F.least(F.lit(_least_shared(sketch, percent)), seen))
    return store(both.where(likely).select("a", "b", whole.alias("sure")), "minhash-filtered")


def _placed_sets(docs: DataFrame, classes: DataFrame, places: DataFrame, shingle: int) -> DataFrame:
    """``places`` (rows of ``set`` and where it is wanted) with ``found``, the set's shingles, read from the one document that stands for it.

    A set travels once per place and is never stored. A table of bits of fixed size, filled from the documents wanted, keeps most others where they lie; when
    it is full, at a size far beyond its own, all texts travel.
    """
    spark = docs.sparkSession
    where = places.groupBy("set").agg(F.collect_list(F.struct(*[c for c in places.columns if c != "set"])).alias("places"))
    ids = classes.select("set", F.col("doc_id").alias("_id"), F.col("hash").alias("_hash")).join(where, "set")
    ids = store(ids, "minhash-wanted")
    spots = ids.select(F.shiftrightunsigned("_hash", 64 - TABLE_BITS).cast("int").alias("p")).distinct()
    table = np.zeros(1 << TABLE_BITS, dtype=bool)
    table[spots.toPandas()["p"].to_numpy(dtype=np.int64)] = True
    shared = spark.sparkContext.broadcast(np.packbits(table))

    @F.pandas_udf("boolean")
    def wanted(hashes: pd.Series) -> pd.Series:
        spot = hashes.to_numpy(dtype=np.int64).view(np.uint64) >> np.uint64(64 - TABLE_BITS)
        return pd.Series((shared.value[spot >> np.uint64(3)] >> (7 - (spot & np.uint64(7))).astype(np.uint8)) & 1).astype(bool)

    @F.pandas_udf("array<long>")
    def found(texts: pd.Series) -> pd.Series:
        return pd.Series([shingles(t, shingle) for t in texts])

    texts = docs.select("doc_id", text_of().alias("text")).withColumn("_own", F.xxhash64("text"))
    texts = texts.where(wanted(F.col("_own")))
    met = texts.join(ids.hint("merge"), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_hash")))
    # repeated rows of one id and text
    one = met.groupBy("set").agg(F.first("text").alias("text"), F.first("places").alias("places"))
    sets = one.select("set", "places", found.asNondeterministic()(F.encode("text", "UTF-8")).alias("found"))
    return sets.select("set", "found", F.explode("places").alias("p")).select("set", "found", "p.*")


def _compared(batches, percent: int):
    """Rows in order, a group's own set before those to compare it with, to links."""
    own, a, b = None, [], []
    for batch in batches:
        for group, is_own, node, found in zip(batch["a"].tolist(), batch["own"].tolist(), batch["set"].tolist(), batch["found"]):
            if is_own:
                own = (group, found)
                continue
            if own is None or own[0] != group:
                raise ValueError(f"set {group} is not there to be compared with")
            shared = len(np.intersect1d(own[1], found, assume_unique=True))
            if shared * 100 >= (len(own[1]) + len(found) - shared) * percent:
                a.append(group)
                b.append(node)
        yield pd.DataFrame({"a": a, "b": b}, dtype="int64")
        a, b = [], []


def _verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links ``a, b``: the sure pairs, and those of the rest that hold on whole sets. Pairs of one ``a`` are dealt to parts of bounded size."""
    open_pairs = pairs.where("NOT sure").select("a", "b")
    sizes = open_pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / GROUP_SETS).cast("int").alias("parts"))
    own = sizes.select(F.col("a").alias("set"), F.col("a"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(True).alias("own"))
    part = F.pmod(F.xxhash64("b"), F.col("parts")).cast("int")
    other = open_pairs.join(sizes.hint("merge"), "a").select(F.col("b").alias("set"), "a", part.alias("part"), F.lit(False).alias("own"))
    rows = _placed_sets(docs, classes, own.unionAll(other), shingle)
    dealt = rows.repartition("a", "part").sortWithinPartitions("a", "part", F.col("own").desc())
    links = dealt.select("a", "own", "set", "found").mapInPandas(lambda batches: _compared(batches, percent), "a long, b long")
    return store(pairs.where("sure").select("a", "b").unionAll(links), "minhash-links")


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many numbers each set on the left shares with each on the right; the numbers of a set are distinct."""
    sets = [*left, *right]
    sizes = np.fromiter(map(len, sets), dtype=np.int64, count=len(sets))
    owner = np.repeat(np.arange(len(sets)), sizes)
    values = np.concatenate(sets) if sets else np.empty(0, dtype=np.int64)
    order = np.argsort(values, kind="stable")
    owner, values = owner[order], values[order]
    starts = np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if len(values) else np.empty(0, dtype=np.int64)
    counts = np.diff(np.r_[starts, len(values)])
    out = np.zeros(len(left) * len(right), dtype=np.int64)
    # numbers of few sets: every pair of their places, one place at a time
    for d in range(2, _DENSE + 1):
        at = starts[counts == d]
        for i in range(d):
            for j in range(i + 1, d) if len(at) else ():
                a, b = owner[at + i], owner[at + j]
                cross = (a < len(left)) & (b >= len(left))
                out += np.bincount(a[cross] * len(right) + b[cross] - len(left), minlength=len(out))
    # numbers of many sets: products of membership tables
    out = out.reshape(len(left), len(right))
    dense = np.flatnonzero(counts > _DENSE)
    for at in range(0, len(dense), _COLUMNS):
        table = np.zeros((len(sets), min(_COLUMNS, len(dense) - at)), dtype=np.float32)
        for column, k in enumerate(dense[at : at + _COLUMNS]):
            table[owner[starts[k] : starts[k] + counts[k]], column] = 1
        out += (table[: len(left)] @ table[len(left) :].T).astype(np.int64)
    return out


def _joined(batches, percent: int):
    """Per pair of tiles the links that join groups not joined before, at most one less than the groups there are."""
    for batch in batches:
        out = []
        for left, right in zip(batch["left"], batch["right"]):
            a, b = ([x["found"] for x in side] for side in (left, right))
            shared = overlaps(a, b)
            sizes = np.add.outer([len(x) for x in a], [len(x) for x in b])
            ra, rb = (np.array([x["root"] for x in side]) for side in (left, right))
            near = (shared * 100 >= (sizes - shared) * percent) & (ra[:, None] != rb[None, :])
            heads: dict[int, int] = {}

            def head(x: int) -> int:
                while heads.get(x, x) != x:
                    heads[x] = heads.get(heads[x], heads[x])
                    x = heads[x]
                return x

            for i, j in zip(*np.nonzero(near)):
                x, y = head(int(ra[i])), head(int(rb[j]))
                if x != y:
                    heads[max(x, y)] = min(x, y)
                    out.append((left[i]["set"], right[j]["set"]))
        yield pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def _tiled(blocks: DataFrame, docs: DataFrame, classes: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Blocks, ``lead, set, n, root, lead_root``, to links between different roots, confirmed on whole sets."""
    # sizes of a link differ by at most one step of the scale
    step = math.log(100 / percent) if percent < 100 else 1.0
    # sets of the lead's root have tiles of their own, as they need not be compared with each other
    rows = blocks.withColumn("scale", F.floor(F.log(F.col("n").cast("double")) / step).cast("int")).withColumn("main", F.col("root") == F.col("lead_root"))
    keys = ["lead", "scale", "main"]
    sums = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("s"))
    parts = F.greatest(F.ceil(F.col("k") / TILE_SETS), F.ceil(F.col("s") / TILE_SHINGLES)).cast("int")
    place = F.pmod(F.xxhash64("set"), F.col("parts")).cast("int")
    placed = rows.join(sums.select(*keys, parts.alias("parts")).hint("merge"), keys).select(*keys, "set", "root", place.alias("part"))
    tiles = _placed_sets(docs, classes, placed, shingle).groupBy(*keys, "part").agg(F.collect_list(F.struct("set", "root", "found")).alias("members"))
    tiles = tiles.withColumn("tile", F.struct("scale", "main", "part")).select("lead", "tile", "members")
    left, right = tiles.alias("l"), tiles.alias("r").hint("merge")
    # each tile meets itself and, once, every other of its own or the next step, unless all sets of both have the lead's root
    near = (F.col("l.tile") <= F.col("r.tile")) & (F.col("r.tile.scale") - F.col("l.tile.scale") <= 1) & ~(F.col("l.tile.main") & F.col("r.tile.main"))
    met = left.join(right, (F.col("l.lead") == F.col("r.lead")) & near).select(F.col("l.members").alias("left"), F.col("r.members").alias("right"))
    return met.mapInPandas(lambda batches: _joined(batches, percent), "a long, b long")


def _links(docs: DataFrame, classes: DataFrame, shingle: int, sketch: int, percent: int) -> DataFrame:
    lists = _lists(classes, sketch, percent)
    degrees = store(lists.groupBy("set").agg(F.sum("m").alias("degree")), "minhash-degrees")
    leads = lists.join(degrees.hint("merge"), "set").groupBy("value").agg(F.max(F.struct("degree", "set", "n")).alias("lead"))
    led = store(lists.join(leads.hint("merge"), "value").select("value", "set", "n", "m", F.col("lead.set").alias("lead"), F.col("lead.n").alias("ln")), "minhash-led")
    pairs = led.where(_similar_size(F.col("n"), F.col("ln"), percent) & (F.col("set") != F.col("lead")))
    pairs = store(pairs.select(F.col("lead").alias("a"), F.col("set").alias("b")).distinct(), "minhash-pairs")
    first = _verified(_filtered(pairs, classes, sketch, percent), docs, classes, shingle, percent)
    roots = store(components(first), "minhash-first-roots")
    own = roots.select(F.col("node").alias("set"), "root").hint("merge")
    theirs = roots.select(F.col("node").alias("lead"), F.col("root").alias("lead_root")).hint("merge")
    named = led.drop("ln").join(own, "set", "left").join(theirs, "lead", "left")
    named = named.withColumn("root", F.coalesce("root", "set")).withColumn("lead_root", F.coalesce("lead_root", "lead"))
    named = store(named, "minhash-named")

    open_lists = named.where(F.col("m") <= SHORT_LIST)
    several = open_lists.groupBy("value").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("value")
    rest = store(open_lists.join(several.hint("merge"), "value", "left_semi"), "minhash-rest")
    left, right = rest.alias("l"), rest.alias("r").hint("merge")
    apart = (F.col("l.value") == F.col("r.value")) & (F.col("l.set") < F.col("r.set")) & (F.col("l.root") != F.col("r.root"))
    cross = left.join(right, apart & _similar_size(F.col("l.n"), F.col("r.n"), percent)).select(F.col("l.set").alias("a"), F.col("r.set").alias("b"))
    known = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).hint("merge")
    cross = store(cross.distinct().join(known, ["a", "b"], "left_anti"), "minhash-cross")
    second = _verified(_filtered(cross, classes, sketch, percent), docs, classes, shingle, percent)

    crowded = named.where(F.col("m") > SHORT_LIST).select("lead", "set", "n", "root", "lead_root").distinct()
    several = crowded.where("root <> lead_root").select("lead").distinct()
    blocks = store(crowded.join(several.hint("merge"), "lead", "left_semi"), "minhash-blocks")
    third = store(_tiled(blocks, docs, classes, shingle, percent), "minhash-tiled")
    return first.unionAll(second).unionAll(third)


def near_groups(docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE, sketch: int = SKETCH) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``; the component is the least id that links reach, the own one included."""
    small_batches(docs.sparkSession)
    prints = store(_prints(docs.select("doc_id", "text"), shingle, sketch), "minhash-prints")
    classes = _classes(prints)
    roots = components(store(_links(docs, classes, shingle, sketch, percent), "minhash-all-links"))
    named = classes.select("set", "digest", "least").join(roots.hint("merge"), F.col("set") == F.col("node"), "left")
    named = store(named.select("digest", "least", F.coalesce("root", "set").alias("root")), "minhash-roots")
    least = named.groupBy("root").agg(F.min("least").alias("component"))
    groups = named.join(least.hint("merge"), "root").select(F.col("digest").alias("_digest"), "component")
    rows = prints.select("doc_id", "digest", F.col("n").cast("long").alias("n_shingles"))
    # texts without words have no class
    rows = rows.join(groups.hint("merge"), F.when(F.col("n_shingles") > 0, F.col("digest")) == F.col("_digest"), "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    rows = rows.select("doc_id", "n_shingles", component.alias("component_id"))
    return rows.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
