"""Connected components of many graphs at once: a graph a case, nodes by number.

A case of few edges is joined in memory, by one task for each case.  A case of more
goes through tables: each node hooks to its smallest neighbour, pointers jump until
every tree is a star, the edges are contracted, and so on; the number of nodes at
least halves each time and no task holds more than its share of rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..stages import Stages
from .slices import by_groups

#: Edges of a case up to which one task joins it: about 100 bytes each.
EDGES = 500_000


def joined(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest that edges (a, b) lead to."""
    up = np.arange(n)
    a, b = np.append(a, b), np.append(b, a)
    while True:
        low = up.copy()
        np.minimum.at(low, a, up[b])
        low = low[low]
        if (low == up).all():
            return up
        up = low


def _in_memory(edges: pd.DataFrame, starts: list[int]) -> Iterator[pd.DataFrame]:
    """Of several cases at once: their graphs do not meet."""
    case = np.repeat(np.arange(len(starts)), np.diff([*starts, len(edges)]))
    ends = pd.DataFrame({"case": np.append(case, case), "node": np.concatenate([edges["a"], edges["b"]])})
    at = ends.groupby(["case", "node"]).ngroup().to_numpy()  # in order
    n = int(at.max()) + 1
    node, of = np.zeros(n, np.int64), np.zeros(n, np.int64)
    node[at], of[at] = ends["node"], ends["case"]
    root = joined(n, at[: len(edges)], at[len(edges) :])
    moved = np.flatnonzero(root != np.arange(n))
    yield pd.DataFrame({"case_no": edges["case_no"].to_numpy()[np.asarray(starts)][of[moved]], "node": node[moved], "root": node[root[moved]]})


def _stars(parents: DataFrame, stages: Stages) -> DataFrame:
    """(case_no, node, parent) with every parent a root, which needs no row."""
    while True:
        up = parents.select("case_no", F.col("node").alias("parent"), F.col("parent").alias("above"))
        step = stages.cut(parents.join(up, ["case_no", "parent"], "left").select("case_no", "node", F.coalesce("above", "parent").alias("parent"), F.col("above").isNotNull().alias("moved")), "jump")
        parents = step.select("case_no", "node", "parent")
        if not step.where("moved").limit(1).count():
            return parents


def by_tables(edges: DataFrame, stages: Stages) -> DataFrame:
    """(case_no, node, root) of edges (case_no, a, b) with a > b; roots have no row."""
    edges, found = stages.cut(edges.distinct(), "edges"), None
    while edges.limit(1).count():
        parents = _stars(edges.groupBy("case_no", F.col("a").alias("node")).agg(F.min("b").alias("parent")), stages)
        if found is not None:  # roots alone have edges still, so no node comes twice
            up = parents.select("case_no", F.col("node").alias("root"), F.col("parent").alias("above"))
            moved = found.join(up, ["case_no", "root"], "left").select("case_no", "node", F.coalesce("above", "root").alias("root"))
            found = stages.cut(moved.unionByName(parents.withColumnRenamed("parent", "root")), "roots")
        else:
            found = parents.withColumnRenamed("parent", "root")
        pa, pb = (parents.select("case_no", F.col("node").alias(x), F.col("parent").alias(f"r{x}")) for x in "ab")
        up = edges.join(pa, ["case_no", "a"], "left").join(pb, ["case_no", "b"], "left").select("case_no", F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
        edges = stages.cut(up.where("a <> b").select("case_no", F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    return edges.select("case_no", F.col("a").alias("node"), F.col("b").alias("root")) if found is None else found


def roots(edges: DataFrame, stages: Stages, most: int = EDGES) -> DataFrame:
    """(case_no, node, root) for every node of an edge (case_no, a, b) that is not the smallest of its component.

    ``edges`` is a table: it is read more than once.
    """
    kind = edges.schema["case_no"].dataType.simpleString()
    edges = edges.where("a <> b").select("case_no", F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    large = stages.cut(edges.groupBy("case_no").agg(F.count("*").alias("n")).where(F.col("n") > most).select("case_no"), "large")
    few, schema = edges, f"case_no {kind}, node long, root long"
    if not large.limit(1).count():
        return by_groups(few, ("case_no",), (), _in_memory, schema)
    few = by_groups(edges.join(large, "case_no", "left_anti"), ("case_no",), (), _in_memory, schema)
    return few.unionByName(by_tables(edges.join(large, "case_no", "left_semi"), stages))
