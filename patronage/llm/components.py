"""Connected components of an edge list by repeated star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.session import materialize


def _least(edges: DataFrame) -> DataFrame:
    """(u, v, m): each directed edge with the least of u and u's neighbours."""
    least = edges.groupBy("u").agg(F.min("v").alias("w")).select("u", F.least("u", "w").alias("m"))
    return edges.join(least, "u")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); root is the least node
    reachable. Null ends and loops are ignored; no edges give no rows.

    Alternates large stars (each node's larger neighbours move to its least
    neighbour) and small stars (the smaller ones do) until the edges stand
    still: a number of rounds in the logarithm of the nodes. Each round is
    written to the shared folder, so a lost executor costs one round. A hub's
    edges stay rows of a join, which Spark splits when skewed.
    """
    edges = materialize(edges.where("a is not null and b is not null and a != b")
                        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    state = mark(edges)
    while state[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .where("u != v").distinct()
        small = _least(large)
        edges = materialize(
            small.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(small.select("u", F.col("m").alias("v"))).where("u != v").distinct())
        before, state = state, mark(edges)
        if state == before:
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
