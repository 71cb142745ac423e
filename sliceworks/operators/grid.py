"""Coordinates: reorientation and bounding boxes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import BoxParams

AXES = ("x", "y", "z")


def reoriented(voxels: DataFrame, shape: tuple[int, int, int], axes: tuple[int, int, int], flips: tuple[bool, bool, bool]) -> DataFrame:
    """New axis i is old axis axes[i], counted from its other end where flips[i]."""
    new = [(F.lit(shape[a] - 1) - F.col(AXES[a]) if f else F.col(AXES[a])).alias(f"new_{AXES[i]}") for i, (a, f) in enumerate(zip(axes, flips))]
    rest = [c for c in voxels.columns if c not in AXES]
    return voxels.select(*rest, *new).withColumnsRenamed({f"new_{a}": a for a in AXES})


def canonical(affine: list[float]) -> tuple[tuple[int, int, int], tuple[bool, bool, bool]]:
    """Axes and flips that bring a file's 4 x 4 affine (by rows) nearest to right, anterior, superior; tilted ones as well.

    The affine without its spacing is taken to the nearest rotation.  The file's axis
    that points most clearly in one direction takes that one, then the next axis
    the clearest of the directions that are left; so every axis has its own.  An
    affine that makes a plane or a line of the volume is an error.
    """
    m = np.asarray(affine, float).reshape(4, 4)[:3, :3]
    length = np.sqrt((m**2).sum(axis=0))
    if not np.isfinite(m).all() or not length.all():
        raise ValueError("an affine without three directions")
    u, size, v = np.linalg.svd(m / length)
    if size[-1] <= size[0] * 3 * np.finfo(float).eps:
        raise ValueError("an affine without three directions")
    nearest = u @ v
    axes, flips = [0] * 3, [False] * 3
    free = [0, 1, 2]
    for c in np.argsort(-np.abs(nearest).max(axis=0), kind="stable"):
        r = max(free, key=lambda row: abs(nearest[row, c]))
        free.remove(r)
        axes[r], flips[r] = int(c), bool(nearest[r, c] < 0)
    return tuple(axes), tuple(flips)


def bounding_boxes(found: DataFrame, p: BoxParams, inclusive_end: bool = False) -> DataFrame:
    """x0, x1, y0, y1, z0, z1 and error per case, ends exclusive; without the labels the whole extent.

    ``found``: case_no, the labels' first and last places (x_lo, x_hi, ...) and
    each case's own nx, ny, nz, sx, sy, sz.  The last place itself is the
    exclusive end; ``inclusive_end`` adds it.  A box without a voxel has an error.
    """
    out = []
    for i, a in enumerate(AXES):
        extent = F.col(f"n{a}")
        inside = lambda c, extent=extent: F.greatest(F.lit(0), F.least(extent, c))
        low, high = (F.ceil(F.lit(float(m)) / F.col(f"s{a}")) for m in p.margin_mm[2 * i : 2 * i + 2])
        lo = inside(F.col(f"{a}_lo") - low) if p.sides[2 * i] else F.lit(0)
        hi = inside(F.col(f"{a}_hi") + high + int(inclusive_end)) if p.sides[2 * i + 1] else extent
        # greatest() and least() pass over nulls, so cases without a hit are told apart here
        out += [F.when(F.col("z_lo").isNull(), v).otherwise(c).cast("int").alias(f"{a}{k}") for k, c, v in ((0, lo, F.lit(0)), (1, hi, extent))]
    empty = (F.col("x1") <= F.col("x0")) | (F.col("y1") <= F.col("y0")) | (F.col("z1") <= F.col("z0"))
    return found.select("case_no", *out).withColumn("error", F.when(empty, F.lit("the box holds no voxel")))


def bounds(voxels: DataFrame, label: str, p: BoxParams, volumes: DataFrame) -> DataFrame:
    """What ``bounding_boxes`` wants, of voxel rows and a table volumes (case_no, nx, ny, nz, sx, sy, sz)."""
    hit = F.col(label).isin(*p.roi)
    ends = [f(F.when(hit, F.col(a))).alias(f"{a}_{n}") for a in AXES for n, f in (("lo", F.min), ("hi", F.max))]
    return voxels.groupBy("case_no").agg(*ends).join(volumes, "case_no")


def same_grid(a: DataFrame, b: DataFrame, rtol: float = 1e-5, atol: float = 1e-8) -> DataFrame:
    """case_no and error (null if there is none) of the cases of both tables (case_no, shape, spacing, affine arrays).

    Shapes must be equal, spacings and affines close: |a - b| <= atol + rtol * |b|.
    """
    def close(c: str) -> Column:
        pairs = F.arrays_zip(F.col(f"a.{c}").alias("p"), F.col(f"b.{c}").alias("q"))
        near = F.forall(pairs, lambda x: F.abs(x["p"] - x["q"]) <= F.lit(atol) + F.lit(rtol) * F.abs(x["q"]))
        return (F.size(f"a.{c}") == F.size(f"b.{c}")) & F.coalesce(near, F.lit(False))

    both = a.alias("a").join(b.alias("b"), "case_no")
    error = F.when(~close("affine"), F.lit("affines differ")).when(F.col("a.shape") != F.col("b.shape"), F.lit("shapes differ")).when(~close("spacing"), F.lit("spacings differ"))
    return both.select("case_no", error.alias("error"))


def cropped(voxels: DataFrame, boxes: DataFrame, shift: bool = True) -> DataFrame:
    """Voxels inside their case's box, counted from its corner."""
    inside = [(F.col(a) >= F.col(f"{a}0")) & (F.col(a) < F.col(f"{a}1")) for a in AXES]
    rows = voxels.join(boxes, "case_no").where(inside[0] & inside[1] & inside[2])
    if shift:
        rows = rows.withColumns({a: F.col(a) - F.col(f"{a}0") for a in AXES})
    return rows.select(*voxels.columns)


def shifted_affine(volumes: DataFrame, boxes: DataFrame) -> DataFrame:
    """The affine's translation moved to the box's corner: t + R (x0, y0, z0)."""
    def moved(r: int):
        a = [F.element_at("affine", 4 * r + c + 1) for c in range(4)]
        return a[3] + a[0] * F.col("x0") + a[1] * F.col("y0") + a[2] * F.col("z0")

    return volumes.join(boxes, "case_no").select("case_no", *[moved(r).alias(f"t{r}") for r in range(3)])
