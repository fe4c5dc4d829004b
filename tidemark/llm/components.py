"""Connected components by alternating large-star and small-star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """Every node's neighbours (lower ones only, if ``small``) are linked to the lowest of them and the node."""
    both = edges if small else edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("low")).withColumn("low", F.least("u", "low"))
    linked = both.join(least, "u")
    if small:
        out = linked.select(F.col("v").alias("u"), F.col("low").alias("v")).unionByName(
            least.select("u", F.col("low").alias("v")))
    else:
        out = linked.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("low").alias("v"))
    return out.where(F.col("u") != F.col("v")).distinct()


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of the undirected ``links (a, b)``; the root is the lowest node.

    Nodes without links, null ends and self-links do not appear. Each round is
    written to the shared folder, so lineage stays short; a node with very
    many links is split by the skew join, and no component meets in one task.
    """
    edges = written(links.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    before = None
    for _ in range(max_rounds):
        edges = written(_star(_star(edges, small=False), small=True), "stars")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).collect()[0]
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
