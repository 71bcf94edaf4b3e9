"""Connected components of an edge table by star contraction; no driver, no group larger than a node's neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evalspark.llm.order import stored


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(a, b), any orientation -> (node, root): the least node of each node's component, for every node of an edge.

    Each round hangs the larger neighbours of a node on its least neighbour, then all lower ones; depth halves, so that
    the rounds grow as the logarithm of the longest chain. The edges are stored after each round. Edges from a node to
    itself and repeated edges change nothing. No edges give no rows.
    """
    edges = edges.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = stored(edges, "edges")
    seen = _mark(edges)
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("m", "a"))
        large = both.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        lower = large.join(lowest, "a").filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stored(lower.union(lowest.select("a", "m")).distinct(), "edges")
        mark = _mark(edges)
        if mark == seen:
            break
        seen = mark
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select("b", "b").distinct())
