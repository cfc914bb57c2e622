"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.llm.tables import Stored

ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest of them. Edges have a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    others = edges.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame, stored: Stored) -> DataFrame:
    """(node, root): the smallest node reachable, for every node of ``links`` (a, b) that has one smaller.

    Large-star and small-star rounds, each written to the shared folder, until a round changes nothing.
    The number of rounds grows with the logarithm of the graph; joins on a node with many links can be
    split, the minima combine before the shuffle. Loops, repeats and both directions are allowed;
    links with a null end are ignored.
    """
    edges = stored.put(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    before = None
    for _ in range(ROUNDS):
        sums = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if before == tuple(sums) or not sums[0]:
            break
        before = tuple(sums)
        edges = stored.swap(edges, _small_star(_large_star(edges)))
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
