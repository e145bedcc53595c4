"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from queryset.llm.scratch import checkpointed


def _state(edges: DataFrame) -> tuple:
    """Count and an order-free checksum; both unchanged means converged."""
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum")).first()
    return row["n"], row["sum"]


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node moves to the least of the node and its neighbours."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    moved = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges run from the larger end; all smaller neighbours move to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """Label each node of an edge list with the least node of its component.

    ``edges`` has two long columns ``a`` and ``b``; direction, repeats, loops and
    nulls (ignored) do not matter. Returns ``node, component`` for the nodes that
    have an edge to another node; an empty edge list gives an empty result.

    The minimum per node is combined before the shuffle and nothing is gathered
    to the driver but a count and a checksum per round. The number of rounds
    grows with the logarithm of a component's size.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    edges = checkpointed(edges)
    before = _state(edges)
    while before[0]:
        edges = checkpointed(_small_star(_large_star(edges)))
        after = _state(edges)
        if after == before:
            break
        before = after
    labels = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels.union(edges.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
