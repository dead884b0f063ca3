"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimflow.llm.scratch import drop, save


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the (a, b) edges; a component is named by its smallest node.

    A large star ties the larger neighbours of a node to the smallest, a small star the smaller
    ones, until only stars are left: a number of rounds that grows with the logarithm of the
    nodes. Each round is written to the shared folder. The smallest neighbours are a table of
    their own, so that the join back can be split at nodes with very many edges. Edges to
    oneself and NULL ends are ignored.
    """
    current = save(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "edges")
    state = None
    while True:
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = save(both.groupBy("a").agg(F.least("a", F.min("b")).alias("least")), "least")
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = save(large.filter("a <> b").distinct(), "large")
        smallest = save(large.groupBy("a").agg(F.min("b").alias("least")), "smallest")
        small = large.join(smallest, "a").filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        following = save(small.union(smallest.select("a", F.col("least").alias("b"))).distinct(), "edges")
        new = following.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003)).first()
        drop(current, least, large, smallest)
        current = following
        if new == state:
            break
        state = new
    roots = current.select("b").distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots.select("b", "b"))
