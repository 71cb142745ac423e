"""Slice rows: the physical form of volumes.

A row is one slice of a case: case_no (of any type), z, nx, ny, the spacing sx,
sy, sz in mm, and one binary column for each volume, 16-bit little-endian with y
running fastest.  Slice-wise work is a map without a shuffle; volumes of a case
meet by a join on (case_no, z).  ``has`` marks the voxels that exist; without it
all do.  Rows with a column ``fault`` (``guarded``) carry what went wrong with
them from step to step instead of failing the job.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = ("case_no", "z")
META = ("nx", "ny", "sx", "sy", "sz")
TYPE = "<i2"
#: Voxels that are worked on together, and bytes that leave a task together: many small slices at once, large ones one at a time.
VOXELS = 1 << 18
BYTES = 1 << 22


def plane(data: bytes, row) -> np.ndarray:
    """A volume's values in the slice, (x, y)."""
    return np.frombuffer(data, TYPE).reshape(row.nx, row.ny)


def guarded(rows: DataFrame) -> DataFrame:
    """``rows`` with a column ``fault``, null so far: later steps write there why a slice could not be worked on, and pass it over from then on."""
    return rows if "fault" in rows.columns else rows.withColumn("fault", F.lit(None).cast("string"))


def fault_of(e: Exception) -> str:
    return str(e) or type(e).__name__


def packed(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).astype(TYPE).tobytes()


def spread(rows: DataFrame, *key: str) -> DataFrame:
    """Rows by key over all shuffle partitions: small slices cost much time a byte, so that partitions merged by bytes would leave cores idle."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *key)


def mapped(slices: DataFrame, run: Callable[..., Iterable[tuple]], schema: str) -> DataFrame:
    """Rows that ``run`` makes of each slice (a named tuple)."""
    names = [c.split()[0] for c in schema.split(", ")]

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [r for row in batch.itertuples(index=False) for r in run(row)]
            yield pd.DataFrame(rows, columns=names)

    return slices.mapInPandas(each, schema)


def frames(rows: Iterable[tuple], names: list[str]) -> Iterator[pd.DataFrame]:
    """Rows as frames of about ``BYTES``, so that a small slice costs no frame of its own."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 64 + sum(len(v) for v in row if isinstance(v, bytes))
        if size >= BYTES:
            yield pd.DataFrame(held, columns=names)
            held, size = [], 0
    if held:
        yield pd.DataFrame(held, columns=names)


def by_groups(rows: DataFrame, key: tuple[str, ...], order: tuple[str, ...], run: Callable[[pd.DataFrame, list[int]], Iterable[pd.DataFrame]], schema: str) -> DataFrame:
    """Frames that ``run`` makes of whole groups of ``key``, each group in ``order``: many small ones come in one frame, with the places where they begin.

    The groups come as a stream over the sorted rows of one shuffle, so a task holds
    one batch and what is left of a group before it.
    """
    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            part = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            if not len(part):
                continue
            starts = _starts(part, key)
            if len(starts) > 1:
                yield from run(part.iloc[: starts[-1]], starts[:-1])
            rest = part.iloc[starts[-1] :].reset_index(drop=True)
        if rest is not None:
            yield from run(rest, [0])

    return spread(rows, *key).sortWithinPartitions(*key, *order).mapInPandas(each, schema)


def _starts(part: pd.DataFrame, key: tuple[str, ...]) -> list[int]:
    new = np.zeros(len(part), bool)
    new[0] = True
    for c in key:
        values = part[c].to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new).tolist()


def lists_of(part: pd.DataFrame, starts: list[int]) -> Iterator[list]:
    """The groups of a frame, each a list of named tuples."""
    rows = list(part.itertuples(index=False))
    for a, b in zip(starts, [*starts[1:], len(rows)]):
        yield rows[a:b]


def stacks(rows: list) -> Iterator[tuple[int, int]]:
    """Runs (from, to) of rows of one shape and of at most ``VOXELS`` voxels, or of one row."""
    at = 0
    for i in range(1, len(rows) + 1):
        if i == len(rows) or (rows[i].nx, rows[i].ny) != (rows[at].nx, rows[at].ny) or (i + 1 - at) * rows[at].nx * rows[at].ny > VOXELS:
            yield at, i
            at = i


def with_stacks(slices: DataFrame, run: Callable[[list], dict[str, np.ndarray]], made: tuple[str, ...]) -> DataFrame:
    """As ``with_planes``; ``run`` gets several slices of one shape at once, and makes (slice, x, y) of them."""
    kept = [c for c in slices.columns if c not in made]
    kinds = {f.name: f.dataType.simpleString() for f in slices.schema.fields}
    schema = ", ".join([*(f"{c} {kinds[c]}" for c in kept), *(f"{c} binary" for c in made)])
    safe = "fault" in kept

    def several(rows: list) -> Iterator[tuple]:
        try:
            new = run(rows)
            out = [(*(getattr(row, c) for c in kept), *(packed(new[c][i]) for c in made)) for i, row in enumerate(rows)]
        except Exception as e:
            if not safe:
                raise
            if len(rows) > 1:  # which of them it was
                out = [r for row in rows for r in several([row])]
            else:
                out = [(*(fault_of(e) if c == "fault" else getattr(rows[0], c) for c in kept), *(None,) * len(made))]
        yield from out

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = list(batch.itertuples(index=False))
            yield from frames(every(rows), [*kept, *made])

    def every(rows: list) -> Iterator[tuple]:
        for row in rows:
            if safe and row.fault is not None:
                yield (*(getattr(row, c) for c in kept), *(None,) * len(made))
        good = [row for row in rows if not safe or row.fault is None]
        for a, b in stacks(good):
            yield from several(good[a:b])

    return slices.mapInPandas(each, schema)


def with_planes(slices: DataFrame, run: Callable[..., dict[str, np.ndarray]], made: tuple[str, ...]) -> DataFrame:
    """``slices`` with the volumes ``made`` that ``run`` makes of each slice, new or in place of old ones."""
    kept = [c for c in slices.columns if c not in made]
    kinds = {f.name: f.dataType.simpleString() for f in slices.schema.fields}
    schema = ", ".join([*(f"{c} {kinds[c]}" for c in kept), *(f"{c} binary" for c in made)])

    def each(row):
        new = run(row)
        yield (*(getattr(row, c) for c in kept), *(packed(new[c]) for c in made))

    def safe(row):
        fault = row.fault
        if fault is None:
            try:
                yield from each(row)
                return
            except Exception as e:  # a fault of one slice is a row, not a failed job
                fault = fault_of(e)
        yield (*(fault if c == "fault" else getattr(row, c) for c in kept), *(None,) * len(made))

    return mapped(slices, safe if "fault" in kept else each, schema)


def stacked(voxels: DataFrame, columns: tuple[str, ...], shape: tuple[int, int, int] | None = None, spacing: tuple[float, float, float] | None = None, volumes: DataFrame | None = None) -> DataFrame:
    """Voxel rows (case_no, x, y, z and the columns, whole numbers) as slice rows.

    One shape and spacing for all cases, or each case's own by ``volumes``
    (case_no, nx, ny, nz, sx, sy, sz).
    """
    kind = voxels.schema["case_no"].dataType.simpleString()
    rows = spread(voxels, *KEY).groupBy(*KEY).agg(*[F.collect_list(F.col(c).cast("int")).alias(c) for c in ("x", "y", *columns)])
    if volumes is None:
        rows = rows.select("*", *[F.lit(n).cast("int").alias(c) for c, n in zip(META, shape[:2])], *[F.lit(float(v)).alias(c) for c, v in zip(META[2:], spacing)])
    else:
        rows = rows.join(volumes.select("case_no", *[F.col(c).cast("int" if c[0] == "n" else "double").alias(c) for c in META]), "case_no")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column("nx").to_numpy().astype(np.int64) * batch.column("ny").to_numpy()
            after = np.cumsum(size)
            for lo, hi in _runs(size):
                yield _filled(batch.slice(lo, hi - lo), size[lo:hi], after[lo:hi] - (after[lo - 1] if lo else 0), columns)

    schema = f"case_no {kind}, z int, nx int, ny int, sx double, sy double, sz double, " + ", ".join(f"{c} binary" for c in (*columns, "has"))
    return rows.mapInArrow(each, schema)


def _runs(size: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of rows of at most ``VOXELS`` voxels, or of one row."""
    at, n = 0, 0
    for i, k in enumerate(size.tolist()):
        if i > at and n + k > VOXELS:
            yield at, i
            at, n = i, 0
        n += k
    if at < len(size):
        yield at, len(size)


def _filled(batch: pa.RecordBatch, size: np.ndarray, after: np.ndarray, columns: tuple[str, ...]) -> pa.RecordBatch:
    """Slices of voxels that come as lists."""
    lists = {c: batch.column(c) for c in ("x", "y", *columns)}
    n = np.diff(lists["x"].offsets.to_numpy())
    flat = {c: v.flatten().to_numpy() for c, v in lists.items()}
    if any((np.diff(v.offsets.to_numpy()) != n).any() for v in lists.values()):
        raise ValueError("voxels without a value")
    within = flat["x"].astype(np.int64) * np.repeat(batch.column("ny").to_numpy(), n) + flat["y"]
    if ((within < 0) | (within >= np.repeat(size, n))).any():
        raise ValueError("voxels outside their slice")
    at, total = within + np.repeat(after - size, n), int(size.sum())
    places = pa.array(np.append(0, after) * np.dtype(TYPE).itemsize, pa.int32()).buffers()[1]
    out = []
    for values in (*(flat[c] for c in columns), 1):
        whole = np.zeros(total, TYPE)
        whole[at] = values
        out.append(pa.Array.from_buffers(pa.binary(), len(size), [None, places, pa.py_buffer(whole)]))
    return pa.RecordBatch.from_arrays([*(batch.column(c) for c in (*KEY, *META)), *out], names=[*KEY, *META, *columns, "has"])


def unstacked(slices: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Slice rows as voxel rows: case_no, x, y, z and the columns as int."""
    kind = slices.schema["case_no"].dataType.simpleString()
    has = "has" in slices.columns

    def several(rows: pd.DataFrame, size: np.ndarray) -> pd.DataFrame:
        flat = {}
        for c in (*columns, *(["has"] if has else [])):
            if any(len(v) != 2 * n for v, n in zip(rows[c], size.tolist())):
                raise ValueError(f"{c} does not fill its slice")
            flat[c] = np.frombuffer(b"".join(rows[c]), TYPE)
        at = np.flatnonzero(flat["has"]) if has else np.arange(size.sum())
        of = np.repeat(np.arange(len(rows)), size)[at]
        x, y = np.divmod(at - (np.cumsum(size) - size)[of], rows["ny"].to_numpy()[of])
        return pd.DataFrame({"case_no": rows["case_no"].to_numpy()[of], "x": x, "y": y, "z": rows["z"].to_numpy()[of]} | {c: flat[c][at] for c in columns})

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            size = batch["nx"].to_numpy().astype(np.int64) * batch["ny"].to_numpy()
            for lo, hi in _runs(size):
                yield several(batch.iloc[lo:hi], size[lo:hi])

    wanted = slices.select(*KEY, "nx", "ny", *columns, *(["has"] if has else []))
    return wanted.mapInPandas(each, f"case_no {kind}, x int, y int, z int, " + ", ".join(f"{c} int" for c in columns))


def histogram(slices: DataFrame, column: str) -> DataFrame:
    """case_no, z, label, n of a volume: what levels and areas need."""
    kind = slices.schema["case_no"].dataType.simpleString()
    has = "has" in slices.columns

    def count(row):
        values = np.frombuffer(getattr(row, column), TYPE)
        if has:
            values = values[np.frombuffer(row.has, TYPE) > 0]
        for label, n in zip(*np.unique(values, return_counts=True)):
            yield row.case_no, row.z, int(label), int(n)

    return mapped(slices.select(*KEY, column, *(["has"] if has else [])), count, f"case_no {kind}, z int, label int, n long")


def histograms(slices: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """case_no, z, volume, label, n, sx, sy, fault of several volumes in one pass; a faulty slice is one row without counts."""
    kind = slices.schema["case_no"].dataType.simpleString()
    rows = guarded(slices)
    has = ["has"] if "has" in rows.columns else []

    def count(row):
        fault, found = row.fault, []
        try:
            for c in columns if fault is None else ():
                values = np.frombuffer(getattr(row, c), TYPE)
                if has:
                    values = values[np.frombuffer(row.has, TYPE) > 0]
                found += [(row.case_no, row.z, c, int(label), int(n), row.sx, row.sy, None) for label, n in zip(*np.unique(values, return_counts=True))]
        except Exception as e:
            fault = fault_of(e)
        yield from found if fault is None else [(row.case_no, row.z, None, None, None, row.sx, row.sy, fault)]

    return mapped(rows.select(*KEY, "sx", "sy", "fault", *columns, *has), count, f"case_no {kind}, z int, volume string, label int, n long, sx double, sy double, fault string")


def median_filtered(slices: DataFrame, column: str = "hu", to: str = "hu_median", kernel: tuple[int, int] = (3, 3)) -> DataFrame:
    """The median of the kernel in the slice, borders reflected (edge voxel repeated)."""
    def run(row):
        hx, hy = kernel[0] // 2, kernel[1] // 2
        padded = np.pad(plane(getattr(row, column), row), ((hx, kernel[0] - 1 - hx), (hy, kernel[1] - 1 - hy)), mode="symmetric")
        near = np.lib.stride_tricks.sliding_window_view(padded, kernel).reshape(row.nx, row.ny, -1)
        half = near.shape[2] // 2
        return {to: np.partition(near, half, axis=2)[:, :, half]}

    return with_planes(slices, run, (to,))


def bounds(slices: DataFrame, column: str, roi: tuple[int, ...]) -> DataFrame:
    """x_lo, x_hi, y_lo, y_hi, z_lo, z_hi of the labels and nx, ny, nz, sx, sy, sz, per case; null bounds without them."""
    kind, safe = slices.schema["case_no"].dataType.simpleString(), "fault" in slices.columns

    def edge(row):
        try:
            hit = np.isin(plane(getattr(row, column), row), roi)
        except Exception:
            if not safe:
                raise
            hit = np.zeros((1, 1), bool)  # the slice's own fault is told where it is counted
        x, y = np.flatnonzero(hit.any(axis=1)), np.flatnonzero(hit.any(axis=0))
        found = (int(x[0]), int(x[-1]), int(y[0]), int(y[-1]), row.z, row.z) if len(x) else (None,) * 6
        yield (row.case_no, row.z, *found, *(getattr(row, c) for c in META))

    names = [f"{a}_{n}" for a in "xyz" for n in ("lo", "hi")]
    schema = f"case_no {kind}, z int, " + ", ".join(f"{c} double" for c in names) + ", nx int, ny int, sx double, sy double, sz double"
    per = mapped(slices.select(*KEY, *META, column), edge, schema)
    ends = [(F.min if c.endswith("lo") else F.max)(c).cast("int").alias(c) for c in names]
    return per.groupBy("case_no").agg(*ends, *[F.first(c).alias(c) for c in META], (F.max("z") + 1).alias("nz"))


def shifted(affine, x: int, y: int, z: int) -> list[float]:
    """A 4 x 4 affine (by rows) whose first voxel is the one at (x, y, z)."""
    out = [float(v) for v in affine]
    for r in range(3):
        out[4 * r + 3] += out[4 * r] * x + out[4 * r + 1] * y + out[4 * r + 2] * z
    return out


def cropped(slices: DataFrame, boxes: DataFrame) -> DataFrame:
    """Slices inside their case's box, cut to it; x and y count from the corner, and so does the column ``affine``, if there is one.

    z stays the scan's own number, so that results name the slices of the scan.
    """
    safe = "fault" in slices.columns
    volumes = tuple(f.name for f in slices.schema.fields if f.dataType.simpleString() == "binary")
    rows = slices.join(boxes.select("case_no", "x0", "x1", "y0", "y1", "z0", "z1"), "case_no").where("z >= z0 AND z < z1 AND x1 > x0 AND y1 > y0")
    kinds, columns = {f.name: f.dataType.simpleString() for f in slices.schema.fields}, slices.columns

    def cut(row):
        own = {"nx": row.x1 - row.x0, "ny": row.y1 - row.y0}
        try:
            own |= {c: packed(plane(getattr(row, c), row)[row.x0 : row.x1, row.y0 : row.y1]) for c in volumes if not (safe and row.fault is not None)}
        except Exception as e:
            if not safe:
                raise
            own |= {"fault": fault_of(e)} | dict.fromkeys(volumes)
        if "affine" in columns:
            own["affine"] = shifted(row.affine, row.x0, row.y0, 0)
        yield tuple(own[c] if c in own else getattr(row, c) for c in columns)

    return mapped(rows, cut, ", ".join(f"{c} {kinds[c]}" for c in columns))
