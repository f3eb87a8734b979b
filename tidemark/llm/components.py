"""Connected components of an undirected graph, by alternating star steps.

Every step is two shuffles of the edges; what it leaves is written to the shared
folder, so lineage stays short and a lost executor costs one step. Steps are few:
each halves the depth of the trees. Edges stay in tasks; the driver sees a count
and a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import settle


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour (or itself)."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("low")).select(F.col("u").alias("node"), F.least("u", "low").alias("low"))
    larger = both.where("v > u")
    return larger.join(least, larger["u"] == least["node"]).select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("low")).select(F.col("u").alias("node"), "low")
    joined = edges.join(least, edges["u"] == least["node"])
    moved = joined.where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return moved.unionByName(least.select(F.col("node").alias("u"), F.col("low").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(id, component) for every node of `edges` (columns a, b): component is the smallest node reachable.

    Loops, repeated edges and edges in both directions are allowed; nulls are not edges.
    A node whose only edges are loops has no row.
    """
    current = settle(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), label
    )
    before = _state(current)
    while before[0]:
        current = settle(_small_star(_large_star(current)), label)
        after = _state(current)
        if after == before:
            break
        before = after
    rest = current.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return rest.unionByName(rest.select(F.col("component").alias("id"), "component").distinct())
