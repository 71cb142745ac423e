"""Counts per slice and label, areas, and the dominating label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.labels import TISSUES, LevelParams


def slice_histogram(voxels: DataFrame, label: str) -> DataFrame:
    """case_no, z, label, n: the one pass over the voxels that levels and areas need."""
    return voxels.groupBy("case_no", "z", F.col(label).cast("int").alias("label")).agg(F.count("*").alias("n"))


def areas(hist: DataFrame, pixel_mm2: float | DataFrame, tissues: dict[int, str] | None = None) -> DataFrame:
    """Whole mm2 per slice and tissue, halves to even, 0 where there is none.

    ``pixel_mm2``: one area for all cases, or a table (case_no, sx, sy) of each case's own spacing.
    """
    t = tissues or TISSUES
    sums = [F.sum(F.when(F.col("label") == k, F.col("n")).otherwise(0)).alias(name) for k, name in t.items()]
    wide = hist.groupBy("case_no", "z").agg(*sums)
    if isinstance(pixel_mm2, DataFrame):
        wide = wide.join(pixel_mm2.select("case_no", (F.col("sx") * F.col("sy")).alias("pixel")), "case_no")
        pixel = F.col("pixel")
    else:
        pixel = F.lit(float(pixel_mm2))
    return wide.select("case_no", "z", *[F.rint(F.col(n).cast("double") * pixel).cast("long").alias(f"mm2_{n.lower()}") for n in t.values()])


def square_cm(mm2: Column) -> Column:
    return mm2.cast("double") / F.lit(100.0)


def packed(label: Column, n: Column, p: LevelParams) -> Column:
    """Score and label in one number, so that its maximum is the winner, ties to the smaller label."""
    score = F.when((label == 0) | (n < p.min_voxels), F.lit(0)).otherwise(n)
    low = label.isin(*p.deprioritise) if p.deprioritise else F.lit(False)
    # a deprioritised label scores exactly 1, however many voxels it has
    score = F.when(low, F.lit(1)).otherwise(score)
    return score.cast("long") * 256 + (F.lit(255) - label)


def winner(packed_max: Column) -> Column:
    return (F.lit(255) - packed_max % 256).cast("int")


def dominant(hist: DataFrame, p: LevelParams, by: tuple[str, ...] = ("case_no", "z")) -> DataFrame:
    """The dominating label of every group of a histogram (label, n); hash aggregation only."""
    return hist.groupBy(*by).agg(winner(F.max(packed(F.col("label"), F.col("n"), p))).alias("level"))


def windowed_counts(hist: DataFrame, w: int) -> DataFrame:
    """Per slice and label that it holds: voxels of the label within w slices."""
    near = Window.partitionBy("case_no", "label").orderBy("z").rangeBetween(-w, w)
    return hist.select("case_no", "z", "label", F.sum("n").over(near).alias("n_window"))
