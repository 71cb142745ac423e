"""Models in three dimensions: slabs of slices with halos, a prediction for each.

A slab is ``depth`` slices and ``halo`` more on either side, so a task holds
depth + 2 halo slices of a case, whatever the scan.  A model that answers with
labels is heard on the slab's own slices; one that answers with scores is heard on
all of them, and where slabs overlap their scores are averaged by weights that fall
towards a slab's ends.  The model is loaded once a worker.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.slices import KEY, META, TYPE, by_groups, fault_of, frames, lists_of, packed
from ..stages import Stages

#: Models that this worker has loaded, by call.
_loaded: dict[str, Callable] = {}


def _model(key: str, load: Callable[[], Callable]) -> Callable:
    if key not in _loaded:
        _loaded.clear()  # a worker serves one call at a time
        _loaded[key] = load()
    return _loaded[key]


def _volume(part: list, volume: str) -> np.ndarray:
    """(x, y, z) of a slab's slices, in order; a slice that is missing or broken is an error."""
    if any(a.z + 1 != b.z for a, b in zip(part, part[1:])):
        raise ValueError("slices are missing")
    f = part[0]
    return np.stack([np.frombuffer(getattr(r, volume), TYPE).reshape(f.nx, f.ny) for r in part], axis=2)


def _first_fault(part: list) -> str | None:
    return next((r.fault for r in part if r.fault is not None), None)


def _copies(depth: int, halo: int) -> Column:
    """The slabs that a slice is read for."""
    z = F.col("z")
    return F.explode(F.sequence(F.floor((z - halo) / depth), F.floor((z + halo) / depth))).alias("slab")


def modelled(rows: DataFrame, load: Callable[[], Callable], made: str, depth: int = 32, halo: int = 8, volume: str = "hu") -> DataFrame:
    """``rows`` with the volume ``made`` that a model makes of ``volume``.

    ``load()`` gives predict(array (x, y, z), spacing), which returns labels of the
    same shape; they equal those of the whole volume if no answer looks further
    than ``halo`` slices.  Where the rows are ``guarded``, a slab that cannot be
    predicted is a fault of its slices, else of the job.
    """
    key, columns = uuid.uuid4().hex, [c for c in rows.columns if c != made]
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    own = F.col("slab") == F.floor(F.col("z") / depth)
    needed = {*KEY, *META, volume, "fault"}
    # the halo's copies carry the volume alone
    dealt = rows.select(*columns, _copies(depth, halo)).select("slab", own.alias("own"), *[F.col(c) if c in needed else F.when(own, F.col(c)).alias(c) for c in columns])

    def one(part: list) -> Iterator[tuple]:
        own = [i for i, r in enumerate(part) if r.own]
        try:
            if "fault" in columns and (fault := _first_fault(part)) is not None:
                raise ValueError(f"in the slab: {fault}")
            found = np.asarray(_model(key, load)(_volume(part, volume), tuple(getattr(part[0], c) for c in META[2:])))
            if found.shape[2:] != (len(part),):
                raise ValueError(f"the model gave {found.shape} for {len(part)} slices")
            out = [(*(getattr(part[i], c) for c in columns), packed(found[:, :, i])) for i in own]
        except Exception as e:
            if "fault" not in columns:
                raise
            fault = fault_of(e)
            out = [(*(fault if c == "fault" and part[i].fault is None else getattr(part[i], c) for c in columns), None) for i in own]
        yield from out

    schema = ", ".join(f"{c} {kinds[c]}" for c in columns) + f", {made} binary"
    return by_groups(dealt, ("case_no", "slab"), ("z",), _each(one, [*columns, made]), schema)


def _each(one: Callable[[list], Iterator[tuple]], names: list[str]):
    """``one`` for the groups of a frame, one after the other."""
    return lambda part, starts: frames((r for group in lists_of(part, starts) for r in one(group)), names)


def scored(rows: DataFrame, load: Callable[[], Callable], made: str, depth: int = 32, halo: int = 8, margin: int = 0, volume: str = "hu", stages: Stages | None = None, cut: bool = True) -> DataFrame:
    """As ``modelled``, of a model whose predict returns scores (class, x, y, z): ``made`` is the class with the best mean score.

    A slice's weight in a slab grows with its distance from the slab's ends; the
    ``margin`` slices next to an end that is not the volume's own count nothing
    there, so a model that looks no further answers as on the whole volume.
    ``margin`` is at most ``halo``.  ``cut``: the rows become a table first, as they
    are read three times; not needed for what is one.
    """
    if not 0 <= margin <= halo:
        raise ValueError("the margin lies within the halo")
    key, kind = uuid.uuid4().hex, rows.schema["case_no"].dataType.simpleString()
    rows = (stages or Stages(rows.sparkSession, "scores")).cut(rows, "slices") if cut else rows
    ends = rows.groupBy("case_no").agg(F.min("z").alias("bottom"), F.max("z").alias("top"))
    guarded = ["fault"] if "fault" in rows.columns else []
    dealt = rows.select(*KEY, *META, volume, *guarded).join(ends, "case_no").select("*", _copies(depth, halo))

    def one(part: list) -> Iterator[tuple]:
        z, first = np.array([r.z for r in part]), part[0]
        below = np.where(z[0] == first.bottom, np.inf, z - z[0] - margin + 1)
        above = np.where(z[-1] == first.top, np.inf, z[-1] - z - margin + 1)
        weight = np.clip(np.minimum(np.minimum(below, above), len(z)), 0, None).tolist()
        try:
            if guarded and (fault := _first_fault(part)) is not None:
                raise ValueError(f"in the slab: {fault}")
            found = np.asarray(_model(key, load)(_volume(part, volume), tuple(getattr(first, c) for c in META[2:])), np.float32)
            out = [(r.case_no, r.z, first.slab, first.nx * first.ny, w, np.ascontiguousarray(found[..., i]).tobytes(), None) for i, (r, w) in enumerate(zip(part, weight)) if w > 0]
        except Exception as e:
            if not guarded:
                raise
            out = [(r.case_no, r.z, first.slab, first.nx * first.ny, w, None, fault_of(e)) for r, w in zip(part, weight) if w > 0]
        yield from out

    names = ["case_no", "z", "slab", "n_voxels", "weight", "scores", "fault"]
    parts = by_groups(dealt, ("case_no", "slab"), ("z",), _each(one, names), f"case_no {kind}, z int, slab long, n_voxels long, weight double, scores binary, fault string")

    def best(part: list) -> Iterator[tuple]:
        fault, label = _first_fault(part), None
        if fault is None:
            total = sum(np.frombuffer(r.scores, np.float32).astype(float) * r.weight for r in part)
            label = packed(total.reshape(-1, int(part[0].n_voxels)).argmax(axis=0))
        yield part[0].case_no, part[0].z, label, fault

    merged = by_groups(parts, KEY, ("slab",), _each(best, [*KEY, made, "scored_fault"]), f"case_no {kind}, z int, {made} binary, scored_fault string")
    out = rows.drop(made).join(merged, [*KEY])
    return out.withColumn("fault", F.coalesce("fault", "scored_fault")).drop("scored_fault") if guarded else out.drop("scored_fault")
