"""Connected components by alternating large and small stars, each round cut off in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mentionkit.sources.shared import store

MOST_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """Edges ``a, b`` to ``node, root``: each node of an edge with the least node of its component.

    Every round replaces the neighbours of a node by links to the least of them, until each component is a star. A
    node's neighbours are reduced to their least one before any shuffle by node; the join that hands it back is a plain
    one, whose hot keys adaptive execution splits. The number of rounds grows with the logarithm of a component's size.
    """
    now = store(_down(edges.select("a", "b")).distinct(), "cc-edges")
    before = None
    for _ in range(MOST_ROUNDS):
        state = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if state == before or state["n"] == 0:
            return _stars(now)
        before = state
        now = store(_small(_large(now)), "cc-edges")
    raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")


def _down(edges: DataFrame) -> DataFrame:
    """Each edge from its larger to its smaller end, loops left out."""
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))


def _large(edges: DataFrame) -> DataFrame:
    """Link each larger neighbour of a node to the least of the node and its neighbours."""
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    # the larger ends are exactly the downward edges seen from their smaller end
    up = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    return _down(up.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _down(moved.unionAll(least.select("a", F.col("m").alias("b")))).distinct()


def _stars(edges: DataFrame) -> DataFrame:
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(roots)
