"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlane.llm.common import staged


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b): root is the smallest node of its component.

    Every round points each node's larger neighbours, then its smaller ones,
    at the smallest it knows; edges become stars in a number of rounds that
    grows with the logarithm of the nodes.  Each half round is a partial
    aggregate and a join whose large side the skew join can split, so a node
    with a third of all edges is no single task's work.  Rounds are written
    tables: no lineage grows, and nothing but a count and a checksum reaches
    the driver.  Self-loops and repeated edges are allowed; an empty edge
    table has no nodes.
    """
    edges = staged(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "edges")
    before = _checksum(edges)
    while before[0]:
        edges = _small_star(_large_star(edges))
        after = _checksum(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("b").alias("a"), "b").distinct()
    return edges.unionByName(roots).toDF("node", "root")


def _checksum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = staged(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "large-least")
    return staged(both.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct(), "large-star")


def _small_star(edges: DataFrame) -> DataFrame:
    least = staged(edges.groupBy("a").agg(F.min("b").alias("m")), "small-least")
    moved = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return staged(moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "small-star")
