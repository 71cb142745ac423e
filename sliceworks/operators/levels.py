"""Vertebral levels per slice: span, gaps, monotonicity, centres."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.labels import LevelParams
from ..stages import Stages
from .hist import dominant
from .slices import by_groups


def spans(levels: DataFrame) -> DataFrame:
    """First and last slice with a level; cases without one have no row."""
    return levels.where("level <> 0").groupBy("case_no").agg(F.min("z").alias("z0"), F.max("z").alias("z1"))


class Windows:
    """Running sums of each label along a case's slices; a window's counts are the difference of two of them."""

    def __init__(self, z: np.ndarray, label: np.ndarray, n: np.ndarray, z0: int, z1: int, p: LevelParams):
        inside = (z >= z0) & (z <= z1)
        self.labels, place = np.unique(label[inside], return_inverse=True)
        counts = np.zeros((z1 - z0 + 2, len(self.labels)), np.int64)
        np.add.at(counts, (z[inside] - z0 + 1, place), n[inside])
        self.sums, self.z0, self.z1, self.p = counts.cumsum(axis=0), z0, z1, p

    def dominant(self, at: np.ndarray, w: int) -> np.ndarray:
        """The dominating label within w slices of each place (as ``hist.packed`` has it)."""
        lo, hi = np.maximum(at - w, self.z0) - self.z0, np.minimum(at + w, self.z1) - self.z0 + 1
        n = self.sums[hi] - self.sums[lo]
        score = np.where((self.labels == 0) | (n < self.p.min_voxels), 0, n)
        score = np.where(np.isin(self.labels, self.p.deprioritise), 1, score)
        packed = np.where(n > 0, score * 256 + 255 - self.labels, -1)
        return 255 - packed.max(axis=1) % 256


def _by_case(hist: DataFrame, levels: DataFrame, run) -> DataFrame:
    """``run`` gets a case's histogram, a few labels a slice, and its levels in order; it returns the new levels and where they are."""
    def some(both: pd.DataFrame, starts: list[int]) -> Iterator[pd.DataFrame]:
        is_own = both["own"].to_numpy(bool)
        columns = {c: both[c].fillna(0).to_numpy(np.int64) for c in ("z", "label", "n", "level")}
        found = []
        for a, b in zip(starts, [*starts[1:], len(both)]):
            mid = a + int(np.searchsorted(is_own[a:b], True))  # the histogram, then the levels in order
            found.append(run({c: columns[c][a:mid] for c in ("z", "label", "n")}, columns["z"][mid:b], columns["level"][mid:b]))
        case = np.repeat(both["case_no"].to_numpy()[np.asarray(starts)], [len(z) for z, _ in found])
        yield pd.DataFrame({"case_no": case, "z": np.concatenate([z for z, _ in found]), "level": np.concatenate([level for _, level in found])})

    kind = levels.schema["case_no"].dataType.simpleString()
    rows = hist.select("case_no", "z", "label", "n", F.lit(None).cast("int").alias("level"), F.lit(False).alias("own"))
    own = levels.select("case_no", "z", F.lit(None).cast("int").alias("label"), F.lit(None).cast("long").alias("n"), "level", F.lit(True).alias("own"))
    return by_groups(rows.unionByName(own), ("case_no",), ("own", "z"), some, f"case_no {kind}, z int, level int")


def _span_filled(h: dict[str, np.ndarray], z: np.ndarray, level: np.ndarray, p: LevelParams) -> tuple[np.ndarray, np.ndarray]:
    if not level.any():
        return z[:0], level[:0]
    z0, z1 = int(z[level != 0].min()), int(z[level != 0].max())
    z, level = z[(z >= z0) & (z <= z1)], level[(z >= z0) & (z <= z1)].copy()
    gaps, w = np.flatnonzero(level == 0), 1
    if p.fill and len(gaps):
        windows = Windows(h["z"], h["label"], h["n"], z0, z1, p)
        while len(gaps) and w <= z1 - z0:
            level[gaps] = windows.dominant(z[gaps], w)
            gaps, w = gaps[level[gaps] == 0], w + 1
    return z, level


def _monotonic(h: dict[str, np.ndarray], z: np.ndarray, level: np.ndarray, p: LevelParams) -> tuple[np.ndarray, np.ndarray]:
    level = level.copy()
    if len(level) > 1:
        windows = Windows(h["z"], h["label"], h["n"], int(z[0]), int(z[-1]), p)
        for w in range(1, p.window + 1):
            flags = np.append(0, np.cumsum(np.append(False, level[1:] > level[:-1])))
            at = np.arange(len(level))
            near = np.flatnonzero(flags[np.minimum(at + w + 1, len(level))] > flags[np.maximum(at - w, 0)])
            if not len(near):
                break  # no flag, so no later round changes anything
            level[near] = windows.dominant(z[near], w)
    return z, level


def filled(hist: DataFrame, levels: DataFrame, p: LevelParams) -> DataFrame:
    """Levels within the span; a slice without one takes that of the smallest window in which one dominates.

    A window costs one difference of running sums for each label, so the work
    follows the gaps and the windows they need.  Cases without a level have no row.
    """
    return _by_case(hist, levels, lambda h, z, level: _span_filled(h, z, level, p))


def non_monotonic(levels: DataFrame) -> DataFrame:
    """Slices whose level is above that of the slice below."""
    before = F.lag("level").over(Window.partitionBy("case_no").orderBy("z"))
    return levels.withColumn("before", before).where("level > before").select("case_no", "z", "level", "before")


def monotonic(hist: DataFrame, levels: DataFrame, p: LevelParams) -> DataFrame:
    """Around each flag of a round, slices take the label that dominates the round's window."""
    if not p.monotonic:
        return levels
    return _by_case(hist, levels, lambda h, z, level: _monotonic(h, z, level, p))


def settled(hist: DataFrame, levels: DataFrame, p: LevelParams) -> DataFrame:
    """``filled``, then ``monotonic``, in one pass over a case."""
    def run(h: dict[str, np.ndarray], z: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        z, level = _span_filled(h, z, level, p)
        return _monotonic(h, z, level, p) if p.monotonic else (z, level)

    return _by_case(hist, levels, run)


def center_slices(hist: DataFrame, levels: DataFrame) -> DataFrame:
    """Per label the first slice at which half of its voxels are reached, if the label dominates there."""
    w = Window.partitionBy("case_no", "label")
    run = hist.where("label <> 0").select("case_no", "z", "label", F.sum("n").over(w.orderBy("z").rowsBetween(Window.unboundedPreceding, 0)).alias("cum"), F.sum("n").over(w).alias("total"))
    mid = run.where("cum * 2 >= total").groupBy("case_no", "label").agg(F.min("z").alias("z"))
    return mid.join(levels, ["case_no", "z"]).where("level = label").select("case_no", "z", F.col("label").alias("center"))


def centroid_slices(hist: DataFrame, levels: DataFrame) -> DataFrame:
    """Per label the mean slice of its voxels, halves to even, if the label dominates there."""
    mean = hist.where("label <> 0").groupBy("case_no", "label").agg(F.rint(F.sum(F.col("z") * F.col("n")).cast("double") / F.sum("n").cast("double")).cast("int").alias("z"))
    return mean.join(levels, ["case_no", "z"]).where("level = label").select("case_no", "z", F.col("label").alias("centroid"))


def level_table(hist: DataFrame, p: LevelParams, stages: Stages | None = None) -> DataFrame:
    """case_no, z, level, center, centroid for every slice of the histogram; 0 where undefined.

    A case without any level has rows of zeros here; ``without_levels`` names such cases.
    ``stages``: the levels become a table first, as they are read three times.
    """
    base = dominant(hist, p)
    whole = base.select("case_no", "z").join(settled(hist, base, p), ["case_no", "z"], "left").select("case_no", "z", F.coalesce("level", F.lit(0)).alias("level"))
    whole = stages.cut(whole, "levels") if stages else whole
    with_c = whole.join(center_slices(hist, whole), ["case_no", "z"], "left").join(centroid_slices(hist, whole), ["case_no", "z"], "left")
    return with_c.select("case_no", "z", "level", F.coalesce("center", F.lit(0)).alias("center"), F.coalesce("centroid", F.lit(0)).alias("centroid"))


def without_levels(hist: DataFrame, p: LevelParams) -> DataFrame:
    """case_no and error of the cases in which no slice has a level."""
    base = dominant(hist, p)
    none = base.groupBy("case_no").agg(F.max("level").alias("top")).where("top = 0")
    return none.select("case_no", F.lit("no vertebral level found").alias("error"))
