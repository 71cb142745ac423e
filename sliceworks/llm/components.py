"""Connected components by hooking and pointer jumping, on tables only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def renamed(parents: DataFrame, above: DataFrame) -> DataFrame:
    """(node, parent) of ``parents``, whose roots move to those that ``above`` (node, parent) gives them, and ``above`` itself."""
    up = above.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
    moved = parents.join(up, "parent", "left").select("node", F.coalesce("above", "parent").alias("parent"))
    return moved.unionByName(above.select("node", "parent"))


def jumped(parents: DataFrame) -> DataFrame:
    """(node, parent) with every parent a root; parents are smaller than their nodes, roots need no row."""
    while True:
        up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
        step = written(parents.join(up, "parent", "left").select("node", F.coalesce("above", "parent").alias("parent"), F.col("above").isNotNull().alias("moved")), "jump")
        parents = step.select("node", "parent")
        if not step.where("moved").limit(1).count():
            return parents


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of an edge (a, b) that is not the smallest of its component.

    Each round hooks every node to its smallest neighbour if that is smaller,
    shortens the trees to stars and contracts the edges; their number of nodes at
    least halves.
    """
    edges = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    found = None
    while edges.limit(1).count():
        parents = jumped(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("parent")))
        # roots alone have edges still, so no node comes twice
        found = parents if found is None else written(renamed(found, parents), "roots")
        pa, pb = (parents.select(F.col("node").alias(x), F.col("parent").alias(f"r{x}")) for x in "ab")
        up = edges.join(pa, "a", "left").join(pb, "b", "left").select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
        edges = written(up.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    if found is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return found.select("node", F.col("parent").alias("root"))
