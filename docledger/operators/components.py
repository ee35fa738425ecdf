"""Connected components by contraction: each node points to its smallest neighbour, the pointers are doubled
until all of them lead to the smallest node of their tree, edges move to those nodes, and so on until none is left.

A tree has two nodes at least, so the nodes that edges are left of are halved in each round, and doubling reaches the
root of a tree in a number of steps that is the logarithm of its depth: a chain of a thousand edges takes one round of ten
steps.  Every step is joins and combined minima over written tables; no component is gathered anywhere.
Null ends and loops are ignored; repeated edges count once; no edges: an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docledger.storage import written


def _undirected(edges: DataFrame) -> DataFrame:
    return edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()


def _doubled(pointers: DataFrame) -> DataFrame:
    """(node, parent) with every parent a root: pointers of pointers, until none moves."""
    while True:
        # Roots have no pointer of their own, so a root that many nodes point to joins nothing.
        up = pointers.where("parent < node").select(F.col("node").alias("parent"), F.col("parent").alias("up"))
        moved = pointers.join(up, "parent", "left").select("node", F.coalesce("up", "parent").alias("parent"), F.col("up").isNotNull().alias("moved"))
        pointers = written(moved, "pointers")
        if pointers.where("moved").isEmpty():
            return pointers.drop("moved")
        pointers = pointers.drop("moved")


def components(edges: DataFrame) -> DataFrame:
    """node, root (the smallest node of its component) for every node of the edges (a, b)."""
    edges = written(_undirected(edges.where("a is not null and b is not null")), "edges")
    rounds: list[DataFrame] = []
    while not rounds or not edges.isEmpty():
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        nearest = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select("node", F.least("node", "b").alias("parent"))
        parents = _doubled(written(nearest, "parents"))
        rounds.append(parents)
        left, right = (parents.select(F.col("node").alias(x), F.col("parent").alias(f"p{x}")) for x in "ab")
        edges = written(_undirected(edges.join(right, "b").where("pb <> a").join(left, "a").select(F.col("pa").alias("a"), F.col("pb").alias("b"))), "edges")
    out = rounds[0]
    for later in rounds[1:]:
        up = later.select(F.col("node").alias("parent"), F.col("parent").alias("up"))
        out = out.join(up, "parent", "left").select("node", F.coalesce("up", "parent").alias("parent"))
    return out.select("node", F.col("parent").alias("root"))
