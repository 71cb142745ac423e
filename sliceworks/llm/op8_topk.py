"""Exact top-k inner products by norm buckets.

Candidates are grouped by length (norm).  The longest ones and a sample, both of
bounded number, give every query a first threshold.  A block holds candidates of
one norm bucket: with its longest vector the threshold becomes a cosine.  Queries
are grouped by the length they need, threshold over norm, so that a table of
groups and blocks tells which of them meet at all before any vector is copied.
A query whose cosine exceeds 1 skips the block; else the block is pruned by
length, where the cosine is high also by the query's largest coordinate, and then
by its largest coordinates together: their part of the product and the lengths of
what is left of both vectors bound the whole.  So it prunes where all norms are
alike, too.  What is left is verified by products.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bounded_sample, table, tidy, written

SCALE = 64
K = 20
#: The stated query set: ids divisible by this.
EVERY = 20
#: Longest vectors, and others about, that give the first thresholds; they are broadcast.
PROBE = 2048
#: Query groups up to which their needs are broadcast.
FEW = 1 << 20
#: Queries and candidates of a cell, about.
QUERIES, CANDIDATES = 2048, 4096
#: From this cosine on a block is pruned by one coordinate, too.
COORDINATE = 0.6
#: One in so many coordinates, the query's largest, make the partial product.
FOCUS = 2


def quantised(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = SCALE) -> DataFrame:
    """vec_id, x (array of whole numbers) and its norm; vectors that are null or hold null or non-finite components are left out."""
    e = F.col(embedding)
    top = F.lit(float("inf"))
    good = e.isNotNull() & F.col(vec_id).isNotNull() & F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < top))
    x = F.transform(e, lambda v: F.floor(v.cast("double") * scale))
    rows = vectors.where(good).select(F.col(vec_id).cast("long").alias("vec_id"), x.alias("x"))
    return rows.withColumn("norm", F.sqrt(F.aggregate("x", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double")))).withColumn("dim", F.size("x"))


def _matrix(xs) -> np.ndarray:
    return np.stack([np.asarray(x, np.float64) for x in xs]) if len(xs) else np.zeros((0, 0))


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Whole-number products: in floating point while that is exact, else in Python's integers."""
    top = (np.abs(q).max(initial=0) * np.abs(c).max(initial=0)) * q.shape[-1]
    if top < 2**53:
        return (q @ c.T).astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    return (whole(q) @ whole(c).T).astype(np.int64)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= least)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def _first(probe, k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        longest = probe.value
        for b in batches:
            theta = np.full(len(b), -np.inf)
            for dim, at in b.groupby("dim").indices.items():
                ids, c = longest.get(dim, (np.zeros(0, np.int64), np.zeros((0, dim))))
                if len(ids) > k:
                    s = products(_matrix(b["x"].iloc[at]), c).astype(np.float64)
                    s[b["vec_id"].to_numpy()[at][:, None] == ids[None, :]] = -np.inf
                    theta[at] = np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k]
            yield b.assign(theta=theta)

    return run


def pruned(q: np.ndarray, q_norm: float, theta: float, c: np.ndarray, norms: np.ndarray, units: np.ndarray) -> np.ndarray:
    """Places of a block's candidates that may reach theta with the query; norms descend."""
    top = norms[0] if len(norms) else 0.0
    if theta <= 0 or not np.isfinite(theta):
        return np.arange(len(c))
    if q_norm * top < theta * (1 - 1e-9):
        return np.zeros(0, np.int64)
    cosine = min(theta / (q_norm * top), 1.0) * (1 - 1e-9)
    by_length = int(np.searchsorted(-norms, -(theta * (1 - 1e-9) / q_norm), side="right"))
    at = np.arange(by_length)
    order = np.argsort(-np.abs(q))
    if cosine >= COORDINATE and len(q):
        # the angles to the coordinate's axis differ by no more than the angle between the vectors
        own, most = np.arccos(np.clip(q[order[0]] / q_norm, -1, 1)), np.arccos(cosine)
        low, high = np.cos(min(np.pi, own + most)) - 1e-9, np.cos(max(0.0, own - most)) + 1e-9
        u = units[:by_length, order[0]]
        at = np.flatnonzero((u >= low) & (u <= high))
    f = order[: -(-len(q) // FOCUS)]
    part, q_part = units[np.ix_(at, f)], q[f] / q_norm
    rest = np.sqrt(max(0.0, 1 - q_part @ q_part) * np.clip(1 - (part * part).sum(axis=1), 0, None))
    return at[(part @ q_part + rest + 1e-9) * norms[at] >= theta / q_norm]


def _cells(k: int):
    def run(key, qs: pd.DataFrame, cs: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(qs) and len(cs):
            cs = cs.sort_values(["norm", "vec_id"], ascending=[False, True])
            ids, norms, c = cs["vec_id"].to_numpy(), cs["norm"].to_numpy(), _matrix(cs["x"])
            units = c / np.maximum(norms, 1e-12)[:, None]
            for qid, x, q_norm, theta in zip(qs["vec_id"], qs["x"], qs["norm"], qs["theta"]):
                q = np.asarray(x, np.float64)
                at = pruned(q, q_norm, theta, c, norms, units)
                at = at[ids[at] != qid]
                if len(at):
                    s = products(q[None, :], c[at])[0]
                    full = s >= theta
                    at, s = at[full], s[full]
                    top = best(s, ids[at], k)
                    rows += zip([qid] * len(top), ids[at][top], s[top])
        return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"]).astype("int64")

    return run


def parted(rows: DataFrame, by: Column, size: int, ranges: int = 64) -> DataFrame:
    """``rows`` with a ``part``: ranges of ``by``, and in each as many parts by a hash as its rows need to have about ``size``."""
    rows = rows.withColumn("by", by)
    ranges = int(min(ranges, max(1, -(-rows.count() // size))))  # no more ranges than parts
    edges = sorted(set(rows.approxQuantile("by", [i / ranges for i in range(1, ranges)], 0.005))) if ranges > 1 else []
    at = F.lit(0)
    for e in edges:
        at = at + (F.col("by") >= e).cast("int")
    rows = rows.withColumn("range", at)
    counts = {r[0]: r[1] for r in rows.groupBy("range").count().collect()}  # at most ``ranges`` rows
    parts = [-(-counts.get(i, 0) // size) for i in range(len(edges) + 1)]
    begin = F.array(*map(F.lit, [0, *map(int, np.cumsum(parts)[:-1])]))
    many = F.array(*map(F.lit, [max(1, n) for n in parts]))
    own = F.pmod(F.xxhash64(F.lit(1), "vec_id"), many[F.col("range")])
    return rows.withColumn("part", begin[F.col("range")] + own).drop("by", "range")


def topk(vectors: DataFrame, k: int = K, every: int = EVERY, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = SCALE, queries: int = QUERIES, candidates: int = CANDIDATES) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest products for each query.

    Queries are the ids divisible by ``every`` (a repeated id asks once, with its
    smallest vector); candidates are all rows but those with the query's id.  Ties
    go to the smaller id.  Vectors of another length than the query's are no
    candidates.  Fewer than k candidates: all of them.  No rows: none.  A product
    beyond a long is an error.
    """
    spark = vectors.sparkSession
    all_rows = written(quantised(vectors, vec_id, embedding, scale), "vectors")
    asked = all_rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min(F.struct("x", "norm", "dim")).alias("q")).select("vec_id", "q.*")
    longest = all_rows.orderBy(F.desc("norm"), "vec_id").limit(PROBE).toPandas()  # at most PROBE vectors
    others = bounded_sample(all_rows, "vec_id", PROBE).toPandas()  # about as many
    # a repeated vector counts once for a threshold only if it is the same row
    probe = pd.concat([longest, others[~others["vec_id"].isin(longest["vec_id"])]])
    shared = spark.sparkContext.broadcast({dim: (part["vec_id"].to_numpy(), _matrix(part["x"])) for dim, part in probe.groupby("dim")})
    with_theta = written(asked.mapInPandas(tidy(_first(shared, k)), "vec_id long, x array<long>, norm double, dim int, theta double"), "queries")
    shared.destroy()
    c = parted(all_rows, F.col("norm"), candidates).withColumnRenamed("part", "block")
    # what the longest vector of a block must have to give the query its threshold
    need = F.when((F.col("theta") > 0) & (F.col("norm") > 0), F.col("theta") / F.col("norm")).otherwise(0.0)
    q = parted(with_theta.withColumn("need", need), F.col("need"), queries).withColumnRenamed("part", "group")
    blocks = c.groupBy("dim", "block").agg(F.max("norm").alias("top"))
    groups = q.groupBy("dim", "group").agg(F.min("need").alias("least"))
    few = groups.count() <= FEW
    meet = written(blocks.join(F.broadcast(groups) if few else groups, "dim").where(F.col("top") >= F.col("least") * (1 - 1e-9)).select("dim", "group", "block"), "meetings")
    keys = ["dim", "group", "block"]
    qs = q.select("dim", "group", "vec_id", "x", "norm", "theta").join(meet, ["dim", "group"]).groupBy(*keys)
    cs = c.select("dim", "block", "vec_id", "x", "norm").join(meet, ["dim", "block"]).groupBy(*keys)
    found = qs.cogroup(cs).applyInPandas(_cells(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op8_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk(table(spark, sf_dir, "embeddings"))


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda e: CAST(floor(CAST(e AS DOUBLE) * 64) AS BIGINT)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.x) = len(q.x) WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""
