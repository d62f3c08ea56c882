"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerledger.session import stage, stage_counted


def _nearest(edges: DataFrame) -> DataFrame:
    """The smallest of each node and its neighbours. Written, so that the join with it can split a node with very many edges."""
    return stage(edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("least")), "least-neighbours")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.join(_nearest(both), "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("least").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """All edges lead to a smaller node here."""
    near = _nearest(edges)
    moved = edges.join(near, "u").filter(F.col("v") > F.col("least")).select(F.col("v").alias("u"), F.col("least").alias("v"))
    return moved.union(near.select("u", F.col("least").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the undirected (u, v) links: root is the smallest node that links lead to.

    Each round moves edges to the smallest neighbour and writes the result, so a lost executor costs one round; the number of rounds
    grows with the logarithm of the nodes. NULL ends and loops are ignored; no edges give an empty result.
    """
    clean = edges.select(F.col("u").cast("bigint"), F.col("v").cast("bigint")).filter("u is not null and v is not null and u <> v")
    downward = clean.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    current, count = stage_counted(downward, "links")
    mark = None
    while count:
        current, count = stage_counted(_small_star(_large_star(current).distinct()).distinct(), "stars")
        seen = current.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.countDistinct("u")).first()
        if seen == mark and seen[0] == seen[2]:
            break
        mark = seen
    nodes = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.union(nodes.select("root", "root").distinct().toDF("node", "root"))
