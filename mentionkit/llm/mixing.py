"""Mix sources to target weights by Pareto order sampling, in DataFrame functions only.

A source's target over its size is the number of copies its documents get on average. The whole
part is certain: every document gets it. The rest is a probability, and documents compete for one
more copy: each draws a random number u, and they are ranked by odds(u) / odds(probability). The
documents of lowest rank are taken until the words they bring come as near as can be to the
words that the whole copies leave open, so the size of the sample is fixed in words.

The place to cut a ranking is found without sorting it: the rank is read as digits, words are
summed by digit, and only the rows of the digit in which the cut lies go on to the next one. A
task never holds more than the sums of one source and the few rows that share all digits.

Defined results: NULL text has size 0 and takes 0 words; a NULL source is a source of its own,
after all others; draws follow from doc_id, source and text, so reruns agree; rows that agree in
all three are told apart by place, and which of such equal rows is taken does not show; a source
of size 0 has target 0; an empty table gives an empty mix; very long texts count whole. ``mix`` reads no other
column; ``mixed_documents`` hands all of them on, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mentionkit.llm.common import WORD, text_of
from mentionkit.sources.shared import store

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST_COPIES = 2.0
_DIGIT = 4096


def size_of(text: Column) -> Column:
    """Words in a text."""
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def draw(seed: int, *columns: Column) -> Column:
    """A number in (0, 1) that follows from the given columns."""
    return (F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 11).cast("double") + 0.5) / float(1 << 53)


def targets(sizes: DataFrame, weights=WEIGHTS, share=SHARE, most=MOST_COPIES) -> DataFrame:
    """``source, source_size`` to the same with ``target``: shares by weight, cut at ``most`` times the size.

    What is cut goes to the others by weight until none is above its limit. In ascending order of
    limit over weight the cut sources come first, so the common level of the rest follows from sums.
    One row per source is all this sees.
    """
    everything = Window.partitionBy()
    order = Window.partitionBy().orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("_n") - 1, F.lit(len(weights))) + 1).cast("int"))
    rows = (
        sizes.withColumn("_n", F.row_number().over(order))
        .withColumn("_w", weight)
        .withColumn("_cap", F.col("source_size") * F.lit(float(most)))
        .withColumn("_budget", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("_all", F.sum("_w").over(everything))
    )
    fill = Window.partitionBy().orderBy(F.col("_cap") / F.col("_w"), "_n").rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("_budget") - F.coalesce(F.sum("_cap").over(fill), F.lit(0.0))
    rows = rows.withColumn("_level", left / (F.col("_all") - F.coalesce(F.sum("_w").over(fill), F.lit(0.0))))
    # the first source that its limit does not cut sets the level; none: all stand at their limits
    open_ = F.when(F.col("_level") * F.col("_w") < F.col("_cap"), F.struct(F.col("_cap") / F.col("_w"), "_n", "_level"))
    level = F.min(open_).over(everything)["_level"]
    return rows.withColumn("target", F.coalesce(F.least("_cap", level * F.col("_w")), "_cap")).select(
        "source", "source_size", "target"
    )


def ranked(docs: DataFrame, seed: int, propensity: Column | None) -> DataFrame:
    """Add ``_size``, ``_u`` and ``_g`` to the documents; row by row."""
    return (
        docs.withColumn("_size", size_of(text_of()))
        .withColumn("_u", draw(seed, F.col("doc_id"), F.col("source"), F.xxhash64("text")))
        .withColumn("_g", (F.lit(1.0) if propensity is None else propensity).cast("double"))
    )


def with_rank(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Join each row to its source; add ``_whole`` copies and the rank ``_z`` for one more, in [0, 1]."""
    names = [c for c in rows.columns if c != "source"]
    joined = rows.alias("r").join(sources.alias("s"), F.col("r.source").eqNullSafe(F.col("s.source")))
    share = F.try_divide("target", F.col("source_size").cast("double")) * F.try_divide("_g", "mean_g")
    expected = F.coalesce(F.least(share, F.lit(MOST_COPIES)), F.lit(0.0))
    part = F.col("_expected") - F.col("_whole")
    odds = F.try_divide(F.col("_u") / (1 - F.col("_u")), part / (1 - part))
    return (
        joined.select("r.source", *[f"r.{c}" for c in names], *[f"s.{c}" for c in sources.columns if c != "source"])
        .withColumn("_expected", expected)
        .withColumn("_whole", F.floor("_expected"))
        # copies beyond the limit are not on offer; no chance ranks after any chance
        .withColumn("_z", F.when(F.col("_whole") >= MOST_COPIES, F.lit(2.0)).when(part <= 0, F.lit(1.0) + F.col("_u") / 2).otherwise(odds / (1 + odds)))
    )


def cuts(rows: DataFrame) -> DataFrame:
    """Per source the first rank not taken: ``source, cut_z, cut_v``; rows below it get one more copy.

    ``rows``: ``source, target, _size, _whole, _z, _v``. ``_v`` tells rows of equal rank apart.
    """
    rows = rows.select(
        "source", "target", "_size", "_whole", "_z", "_v",
        F.floor(F.col("_z") * _DIGIT).alias("_d0"),
        F.floor(F.col("_z") * _DIGIT * _DIGIT).alias("_d1"),
        F.col("_z").alias("_d2"),
        F.shiftright("_v", 52).alias("_d3"),
        F.shiftright("_v", 40).alias("_d4"),
    )
    edge = rows.groupBy("source").agg((F.first("target") - F.sum(F.col("_whole") * F.col("_size"))).alias("gap")).where("gap > 0")
    offered = rows.where(F.col("_z") < 2)
    fixed: list[str] = []
    for digit in ("_d0", "_d1", "_d2", "_d3", "_d4"):
        order = Window.partitionBy("source").orderBy(digit).rowsBetween(Window.unboundedPreceding, -1)
        sums = (
            _within(offered, edge, fixed)
            .groupBy("source", "gap", *fixed, digit)
            .agg(F.sum("_size").alias("_words"))
            .withColumn("_before", F.coalesce(F.sum("_words").over(order), F.lit(0)))
        )
        # the last digit that begins before the gap is filled holds the cut
        last = F.max(F.struct(F.col(digit).alias("d"), F.col("_before").alias("b"), *[F.col(c) for c in fixed])).alias("e")
        edge = sums.where(F.col("_before") < F.col("gap")).groupBy("source", "gap").agg(last)
        edge = edge.select("source", (F.col("gap") - F.col("e.b")).alias("gap"), *[F.col(f"e.{c}").alias(c) for c in fixed], F.col("e.d").alias(digit))
        fixed.append(digit)
    order = Window.partitionBy("source").orderBy("_z", "_v").rowsBetween(Window.unboundedPreceding, -1)
    near = _within(offered, edge, fixed).withColumn("_before", F.coalesce(F.sum("_size").over(order), F.lit(0)))
    # a row that crosses the line is taken if that brings the sum nearer
    left_out = F.when(F.col("_before") + F.col("_size") / 2 > F.col("gap"), F.struct("_z", "_v"))
    found = near.groupBy("source").agg(F.min(left_out).alias("out"), F.max("_z").alias("top"))
    return found.select(
        "source",
        F.coalesce("out._z", "top").alias("cut_z"),
        F.coalesce("out._v", F.lit((1 << 63) - 1)).alias("cut_v"),
    )


def _within(rows: DataFrame, edge: DataFrame, fixed: list[str]) -> DataFrame:
    """The rows that share the digits found so far."""
    same = F.col("r.source").eqNullSafe(F.col("e.source"))
    for c in fixed:
        same = same & (F.col(f"r.{c}") == F.col(f"e.{c}"))
    return rows.alias("r").join(edge.alias("e"), same).select("r.*", "e.gap")


def plan(narrow: DataFrame, weights=WEIGHTS, share=SHARE) -> DataFrame:
    """Per source: size, target, mean propensity and where its ranking is cut.

    ``narrow`` holds ``source, _size, _u, _g, _v`` per row and is read several times, so it should be a
    stored table.
    """
    sums = narrow.groupBy("source").agg(
        F.sum("_size").alias("source_size"),
        F.try_divide(F.sum(F.col("_g") * F.col("_size")), F.sum("_size").cast("double")).alias("mean_g"),
    )
    goals = targets(sums.select("source", "source_size"), weights, share).alias("t")
    sources = (
        sums.alias("m").join(goals, F.col("m.source").eqNullSafe(F.col("t.source")))
        .select("m.source", "m.source_size", "t.target", F.coalesce("m.mean_g", F.lit(1.0)).alias("mean_g"))
    )
    sources = store(sources, "mix-sources")
    found = cuts(with_rank(narrow, sources))
    out = sources.alias("s").join(found.alias("c"), F.col("s.source").eqNullSafe(F.col("c.source")), "left")
    return store(out.select("s.*", "c.cut_z", "c.cut_v"), "mix-plan")


def apply_plan(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Add ``size, source_size, target, copies, taken`` to rows that carry ``_size, _u, _g, _v``."""
    extra = (F.col("_z") < F.col("cut_z")) | ((F.col("_z") == F.col("cut_z")) & (F.col("_v") < F.col("cut_v")))
    copies = F.col("_whole") + F.coalesce(extra, F.lit(False)).cast("long")
    keep = [F.col(c) for c in rows.columns if not c.startswith("_")]
    return (
        with_rank(rows, sources)
        .withColumn("_copies", copies)
        .select(
            *keep,
            F.col("_size").alias("size"),
            F.col("source_size"),
            F.col("target"),
            F.col("_copies").alias("copies"),
            (F.col("_copies") * F.col("_size")).alias("taken"),
        )
    )


def mix(docs: DataFrame, seed: int = 10, weights=WEIGHTS, share=SHARE, propensity: Column | None = None) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, copies, taken``.

    ``propensity`` (positive, over the columns of ``docs``) makes chances unequal within a source;
    without it they differ between sources only.
    """
    rows = ranked(docs, seed, propensity).select("doc_id", "source", "_size", "_u", "_g")
    narrow = store(rows.withColumn("_v", F.xxhash64(F.monotonically_increasing_id())), "mix-rows")
    return apply_plan(narrow, plan(narrow, weights, share))


def mixed_documents(docs: DataFrame, seed: int = 10, weights=WEIGHTS, share=SHARE) -> DataFrame:
    """The documents of the mix with their texts, one row per copy: all their columns, then ``size, source_size, target, copies, copy_no``.

    Texts are not shuffled: a row's rank is computed where it lies and compared with its source's cut. Rows that agree in all columns are told apart by
    their place in the stored documents, so that some of them can be taken and others left. Where the documents have a column of one of the added
    names, theirs keeps it and the added one is called ``mix_...``.
    """
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    rows = ranked(docs.select(own, "doc_id", "source", "text"), seed, None)
    # the place of a row is written down once, beside the row, so that both readings agree on it
    placed = store(rows.select("doc", "source", "_size", "_u", "_g", F.xxhash64(F.monotonically_increasing_id()).alias("_v")), "mix-documents")
    out = apply_plan(placed, plan(placed.select("source", "_size", "_u", "_g", "_v"), weights, share))
    out = out.where("copies > 0").withColumn("copy_no", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    taken = {c.lower() for c in docs.columns}
    added = []
    for c in ("size", "source_size", "target", "copies", "copy_no"):
        name = c
        while name in taken:
            name = f"mix_{name}"
        taken.add(name)
        added.append(F.col(c).alias(name))
    return out.select("doc.*", *added)
