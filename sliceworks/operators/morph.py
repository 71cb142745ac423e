"""Connected components of masks: size filters, largest component, holes.

Components need neighbours of neighbours, which no built-in operator follows.  A
slice is labelled by NumPy, in a map.  In 3-D slabs of slices give pieces, joined
within the slab, and what touches across its seam; only the seams' edges, never
pieces or voxels, meet to be joined (``components``), and what is decided of a
component comes from sums by tables.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..stages import Stages
from .components import joined, roots
from .slices import KEY, by_groups, plane, spread, stacks, with_planes, with_stacks


def _steps(rank: int, corners: bool) -> list[tuple[int, ...]]:
    near = itertools.product((-1, 0, 1), repeat=rank)
    return [s for s in near if s > (0,) * rank and (corners or sum(map(abs, s)) == 1)]  # one way: an edge needs no second


def labelled(mask: np.ndarray, corners: bool, apart: int = 0) -> np.ndarray:
    """Components of a mask, each named by its first place in C order; -1 outside.  Nothing connects along the first ``apart`` axes."""
    at = np.argwhere(mask)
    out = np.full(mask.shape, -1, np.int64)
    if not len(at):
        return out
    place = np.full(mask.shape, -1, np.int64)
    place[mask] = np.arange(len(at))
    a, b = [], []
    for s in _steps(mask.ndim - apart, corners):
        to = at + ((0,) * apart + s)
        ok = ((to >= 0) & (to < mask.shape)).all(axis=1)
        j = place[tuple(to[ok].T)]
        a.append(np.flatnonzero(ok)[j >= 0]), b.append(j[j >= 0])
    out[mask] = np.flatnonzero(mask.ravel())[joined(len(at), np.concatenate(a), np.concatenate(b))]
    return out


def large_ones(mask: np.ndarray, least: float) -> np.ndarray:
    """A slice's mask without components under ``least`` voxels; corners connect."""
    comp = labelled(mask, True)
    names, n = np.unique(comp[comp >= 0], return_counts=True)
    return np.isin(comp, names[n >= least])


# --- three dimensions
#: Slices of a slab, the unit in which pieces and where they touch are found.
SLAB = 16


def _cuts(on: np.ndarray, corners: bool) -> np.ndarray:
    """The number of each voxel's piece in its slice, by first place, of several slices (slice, x, y); -1 outside."""
    comp = labelled(on, corners, 1)
    names = np.unique(comp[on])
    before = np.searchsorted(names, np.arange(len(on)) * on[:1].size)
    out = np.full(on.shape, -1, np.int64)
    out[on] = np.searchsorted(names, comp[on]) - before[np.nonzero(on)[0]]
    return out


def _meet(one: np.ndarray, two: np.ndarray, corners: bool, n: int) -> np.ndarray:
    """Pairs of the nodes, under ``n``, of neighbouring slices (slice, x, y) that touch."""
    found = [np.zeros(0, np.int64)]
    (nx, ny), near = one.shape[1:], (-1, 0, 1) if corners else (0,)
    for dx, dy in itertools.product(near, repeat=2):
        a = one[:, max(0, dx) : nx + min(0, dx), max(0, dy) : ny + min(0, dy)]
        b = two[:, max(0, -dx) : nx + min(0, -dx), max(0, -dy) : ny + min(0, -dy)]
        ok = (a >= 0) & (b >= 0)
        found.append(a[ok] * n + b[ok])
    return np.stack(np.divmod(np.unique(np.concatenate(found)), max(n, 1)), axis=1)


def pieces(slices: DataFrame, mask: str, corners: bool, inverted: bool = False) -> DataFrame:
    """A row per piece of a slice: its size ``n``, first place, whether it meets the border, and the ``node`` of its slab that it belongs to.

    Pieces that touch within a slab are one node.  A slab's first slice also goes
    to the slab below it: rows with ``seam`` tell which piece (of the slice above
    the seam) touches the node.  So a task holds SLAB + 1 slices of a mask,
    whatever the scan, and only seams are left to be joined.  Slices without the
    mask have no piece.
    """
    kind = slices.schema["case_no"].dataType.simpleString()
    slab = F.floor(F.col("z") / SLAB)
    copies = F.when(F.col("z") % SLAB == 0, F.array(slab, slab - 1)).otherwise(F.array(slab))
    rows = slices.where(F.col(mask).isNotNull()).select(*KEY, "nx", "ny", F.col(mask).alias("mask"), F.explode(copies).alias("slab"))
    def some(part: pd.DataFrame, starts: list[int]) -> Iterator[pd.DataFrame]:
        rows, group = list(part.itertuples(index=False)), np.searchsorted(starts, np.arange(len(part)), "right") - 1
        slab, z = part["slab"].to_numpy(), part["z"].to_numpy()
        seam = z // SLAB != slab  # the next slab tells of this slice
        tied = np.append(False, (group[1:] == group[:-1]) & (z[1:] == z[:-1] + 1))
        parts, stops = [], list(stacks(rows))
        for a, b in stops:
            parts.append(_cuts(np.stack([plane(r.mask, r) > 0 for r in rows[a:b]]) != inverted, corners))
        n_pieces = np.concatenate([c.reshape(len(c), -1).max(axis=1) + 1 for c in parts])
        offset = np.cumsum(n_pieces) - n_pieces
        n_nodes, edges, own, last = int(n_pieces.sum()), [np.zeros((0, 2), np.int64)], [], None
        for (a, b), comp in zip(stops, parts):
            node = np.where(comp >= 0, comp + offset[a:b, None, None], -1)
            ids = node[node >= 0] - offset[a]
            n, first = np.bincount(ids, minlength=n_pieces[a:b].sum()), np.zeros(n_pieces[a:b].sum(), np.int64)
            places = np.broadcast_to(np.arange(node[0].size).reshape(node[0].shape), node.shape)[node >= 0]
            first[ids[::-1]] = places[::-1]  # of equal ids the last counts, which is the first place
            rim = np.zeros(len(n) + 1, bool)
            for side in (node[:, 0], node[:, -1], node[:, :, 0], node[:, :, -1]):
                rim[side[side >= 0] - offset[a]] = True
            of = np.repeat(np.arange(a, b), n_pieces[a:b])
            own.append(pd.DataFrame({"row": of, "piece": np.arange(len(n)) + offset[a] - offset[of], "n": n, "first": first, "border": rim[:-1]}))
            if last is not None and tied[a] and last.shape == node[0].shape:
                edges.append(_meet(last[None], node[:1], corners, n_nodes))
            joins = np.flatnonzero(tied[a + 1 : b])
            if len(joins):
                edges.append(_meet(node[joins], node[joins + 1], corners, n_nodes))
            last = node[-1]
        pieces = pd.concat(own, ignore_index=True)
        of, pairs = pieces["row"].to_numpy(), np.concatenate(edges)
        over = seam[of[pairs[:, 1]]] if len(pairs) else np.zeros(0, bool)
        inner = pairs[~over]
        base = offset[np.asarray(starts)][group[of]]  # nodes are numbered in their slab
        node = joined(n_nodes, inner[:, 0], inner[:, 1]) - base + (slab[of] << 32)
        case = part["case_no"].to_numpy()
        told = pieces.assign(case_no=case[of], z=z[of], node=node, seam=False)[~seam[of]]
        yield told[names]
        a, b = pairs[over].T
        yield pd.DataFrame({"case_no": case[of[b]], "z": z[of[b]], "piece": pieces["piece"].to_numpy()[b], "node": node[a], "seam": True, "n": 0, "first": 0, "border": False})[names]

    names = ["case_no", "z", "piece", "node", "seam", "n", "first", "border"]
    return by_groups(rows, ("case_no", "slab"), ("z",), some, f"case_no {kind}, z int, piece int, node long, seam boolean, n long, first long, border boolean")


def _chosen(slices: DataFrame, mask: str, corners: bool, choose, inverted: bool = False, stages: Stages | None = None, cut: bool = True) -> DataFrame:
    """``slices`` with the mask of the components that ``choose`` takes.

    ``choose`` gets components (case_no, root, n, first, rim) and a row per case
    (case_no, nx, ny, depth, unit), and gives (case_no, root).  ``inverted``: the
    components are the background's, and the mask is what is not taken.  ``cut``:
    the slices become a table first, as they are read twice; not needed for what
    is one.
    """
    stages = stages or Stages(slices.sparkSession, "components")
    rows = stages.cut(slices, "slices") if cut else slices
    found = stages.cut(pieces(rows, mask, corners, inverted), "pieces")
    own = found.where("NOT seam").drop("seam")
    seams = found.where("seam").select("case_no", "z", "piece", F.col("node").alias("a"))
    edges = stages.cut(seams.join(own.select("case_no", "z", "piece", F.col("node").alias("b")), ["case_no", "z", "piece"]).select("case_no", "a", "b").distinct(), "seams")
    named = own.join(roots(edges, stages), ["case_no", "node"], "left").withColumn("root", F.coalesce("root", "node"))
    cases = rows.groupBy("case_no").agg(F.first("nx").alias("nx"), F.first("ny").alias("ny"), F.min("z").alias("bottom"), F.max("z").alias("top"), F.first(F.col("sx") * F.col("sy") * F.col("sz")).alias("unit"))
    rim = F.col("border") | (F.col("z") == F.col("bottom")) | (F.col("z") == F.col("top"))
    # places are compared in scan order: by the place in the slice, then by the slice
    comps = named.join(cases.select("case_no", "bottom", "top"), "case_no").groupBy("case_no", "root").agg(F.sum("n").alias("n"), F.min(F.struct("first", "z")).alias("first"), F.max(rim).alias("rim"))
    taken = choose(comps, cases.withColumn("depth", F.col("top") - F.col("bottom") + 1))
    per = named.join(taken.select("case_no", "root"), ["case_no", "root"], "left_semi").groupBy(*KEY).agg(F.collect_list("piece").alias("kept_pieces"))

    def paint(some: list) -> dict[str, np.ndarray]:
        comp = _cuts(np.stack([plane(getattr(row, mask), row) > 0 for row in some]) != inverted, corners)
        kept = np.zeros((len(some), comp.max() + 2), bool)  # the last is for -1
        for i, row in enumerate(some):
            if row.kept_pieces is not None:
                kept[i, np.asarray(row.kept_pieces, np.int64)] = True
        return {mask: kept[np.arange(len(some))[:, None, None], comp] != inverted}

    # the slices are cut once more: cheaper than to carry every voxel's piece through a join
    return with_stacks(spread(rows, *KEY).join(per, [*KEY], "left"), paint, (mask,)).select(*slices.columns)


def _first_largest(comps: DataFrame, cases: DataFrame) -> DataFrame:
    best = comps.groupBy("case_no").agg(F.max(F.struct("n", (-F.col("first.first")).alias("f"), (-F.col("first.z")).alias("z"), "root")).alias("best"))  # ties: the first in scan order
    return best.select("case_no", F.col("best.root").alias("root"))


def _surroundings(comps: DataFrame, cases: DataFrame) -> DataFrame:
    """The background's largest part; a frame of one voxel about the volume joins all that meets the border, and wins ties."""
    outside = comps.where("rim").groupBy("case_no").agg(F.sum("n").alias("met"))
    frame = (F.col("nx") + 2).cast("long") * (F.col("ny") + 2) * (F.col("depth") + 2) - F.col("nx").cast("long") * F.col("ny") * F.col("depth")
    whole = cases.join(outside, "case_no", "left").select("case_no", (frame + F.coalesce("met", F.lit(0))).alias("outside"))
    inner = _first_largest(comps.where("NOT rim"), cases).join(comps, ["case_no", "root"]).join(whole, "case_no").where(F.col("n") > F.col("outside")).select("case_no", "root")
    return comps.where("rim").join(inner, "case_no", "left_anti").select("case_no", "root").unionByName(inner)


def without_small(slices: DataFrame, mask: str, limit: float, three_d: bool = False, **how) -> DataFrame:
    """Drops components of the mask under ``limit`` mm2 (3-D: mm3) by each case's spacing; corners connect.  No limit: nothing changes."""
    if limit <= 0:
        return slices
    if three_d:
        return _chosen(slices, mask, True, lambda comps, cases: comps.join(cases.select("case_no", "unit"), "case_no").where(F.col("n") >= F.lit(float(limit)) / F.col("unit")), **how)
    return with_planes(slices, lambda row: {mask: large_ones(plane(getattr(row, mask), row) > 0, limit / (row.sx * row.sy))}, (mask,))


def keep_largest(slices: DataFrame, mask: str, **how) -> DataFrame:
    """The largest component of a case's mask; faces connect.  ``how``: ``stages`` and ``cut``, where the tables between go."""
    return _chosen(slices, mask, False, _first_largest, **how)


def fill_holes(slices: DataFrame, mask: str, **how) -> DataFrame:
    """All but the largest part of the background, the volume's surroundings included, becomes mask; faces connect."""
    return _chosen(slices, mask, False, _surroundings, inverted=True, **how)
