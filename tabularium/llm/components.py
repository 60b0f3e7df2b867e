"""Connected components of a table of links, by alternating large-star and small-star steps.

Nodes and links stay distributed. Each step is an aggregate (combined before its shuffle) and a
join, in which the links of hubs are not shuffled; its result is written to the shared folder, which
cuts the lineage. The number of rounds grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabularium.llm.common import join_sized, stage


def _large_star(edges: DataFrame, n: int) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour (itself included)."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count("*").alias("links"))
    larger = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    return join_sized(larger, least, "a", "links", 2 * n).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame, n: int) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to its smallest neighbour."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("links"))
    moved = join_sized(edges, least, "a", "links", n).select(F.inline(F.array(
        F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
        F.struct(F.col("a").alias("a"), F.col("m").alias("b")),
    )))
    return moved.where("a <> b").distinct()


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"), F.sum(F.col("b").cast("decimal(38,0)")).alias("s")
    ).first()
    return tuple(row)


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for every node that has a link.

    Links with a null end and links of a node to itself are ignored; repeated links count once.
    """
    edges = (
        links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"), (F.col(a).isNotNull() & F.col(b).isNotNull()).alias("ok"))
        .where("ok and a <> b")
        .select("a", "b")
        .distinct()
    )
    edges = stage(edges, "links")
    mark = _mark(edges)
    while mark[0]:
        large = stage(_large_star(edges, mark[0]), "links")
        edges = stage(_small_star(large, mark[0]), "links")
        new = _mark(edges)
        if new == mark:
            break
        mark = new
    roots = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
