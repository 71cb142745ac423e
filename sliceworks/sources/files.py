"""Files: directories, case lists, metadata pairs, volumes (NIfTI-1) and their sinks."""

from __future__ import annotations

import functools
import io
import json
import os
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cases import base_name, case_id
from ..operators.slices import shifted
from . import nifti

SLICES = "case_id string, volume string, z int, nx int, ny int, nz int, spacing array<float>, affine array<double>, data binary, error string"
ROW = pa.schema([("case_id", pa.string()), ("volume", pa.string()), *((c, pa.int32()) for c in ("z", "nx", "ny", "nz")), ("spacing", pa.list_(pa.float32())), ("affine", pa.list_(pa.float64())), ("data", pa.binary()), ("error", pa.string())])
#: Bytes of slices in a batch, about.
BATCH_BYTES = 4 << 20


def directory(spark: SparkSession, path: str) -> DataFrame:
    """path and case_id of the files in a folder, hidden ones left out; contents are not read."""
    files = spark.read.format("binaryFile").load(path).select("path")
    return files.where(~base_name(F.col("path")).startswith(".")).select("path", case_id(F.col("path")).alias("case_id"))


def inputs(spark: SparkSession, path: str) -> DataFrame:
    """path and case_id of a case list (.json), a volume (.nii, .nii.gz) or a folder; anything else is refused."""
    name = path.rstrip("/").rsplit("/", 1)[-1]
    if name.endswith(".json"):
        return datalist(spark, path)
    if "." in name and not name.endswith((".nii", ".nii.gz")):
        raise ValueError(f"neither a case list, a volume nor a folder: {path}")
    return directory(spark, path)


def datalist(spark: SparkSession, path: str) -> DataFrame:
    """Cases of a JSON list: {'testing'|'imagesTs': [{'image'}]}, a list of names, or of {'image'}; files that are missing are left out."""
    text = spark.read.text(path, wholetext=True).first()[0]
    data = json.loads(text)
    if isinstance(data, dict):
        found = [data[k] for k in ("testing", "imagesTs") if k in data]
        if not found:
            raise ValueError("no known key in the case list")
        data = found[0]
    names = [d if isinstance(d, str) else d["image"] for d in data]
    folder = path.rsplit("/", 1)[0]
    full = [n if "/" == n[:1] or "://" in n else f"{folder}/{n}" for n in names]
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    places = [spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p) for p in dict.fromkeys(p.rsplit("/", 1)[0] for p in full)]
    there = [p.toString() for p in places if p.getFileSystem(conf).exists(p)]
    listed = spark.createDataFrame([(p,) for p in full], "path string")
    if not there:
        return listed.limit(0).select("path", case_id(F.col("path")).alias("case_id"))
    # a folder is listed once, however many of its files the list names
    plain = lambda c: F.regexp_replace(c, "^[a-z]+:/+", "/")
    seen = spark.read.format("binaryFile").load(there).select(plain(F.col("path")).alias("plain"))
    kept = listed.withColumn("plain", plain(F.col("path"))).join(seen, "plain", "left_semi")
    return kept.select("path", case_id(F.col("path")).alias("case_id"))


def metadata_pairs(spark: SparkSession, path: str) -> DataFrame:
    """case_id, line, k, v of key,value files: the first two fields of each line, quoted or not; lines without a second are left out."""
    lines = spark.read.text(path, wholetext=True).select(case_id(F.col("_metadata.file_path")).alias("case_id"), F.posexplode(F.split("value", r"\r?\n")).alias("line", "text"))
    fields = F.from_csv("text", "k string, v string, rest string", {"mode": "PERMISSIVE"})
    return lines.where(F.col("text").contains(",")).select("case_id", "line", fields.alias("f")).select("case_id", "line", "f.k", F.coalesce("f.v", F.lit("")).alias("v"))


def series_folders(spark: SparkSession, path: str) -> DataFrame:
    """dir and n of every folder below the path that holds more than one file, hidden ones not counted."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path").where(~base_name(F.col("path")).startswith("."))
    folders = files.select(F.regexp_replace("path", "/[^/]*$", "").alias("dir"))
    return folders.groupBy("dir").agg(F.count("*").alias("n")).where("n > 1")


#: The whole volume of a file as stored, its affine and spacing; and back.
decode, encode = nifti.volume, nifti.encoded


def oriented(data: np.ndarray, affine: np.ndarray, spacing: tuple[float, ...]) -> tuple[np.ndarray, np.ndarray, tuple[float, ...]]:
    """The volume with axes to the right, anterior, superior (a view), and its affine and spacing; tilted ones go to the nearest axes."""
    h = nifti.Header(data.dtype.str, data.shape, 0, 1.0, 0.0, np.asarray(affine, float), tuple(spacing))
    axes, flips = h.turned()
    _, turned, step = h.grid()
    return np.flip(data.transpose(axes), [i for i, f in enumerate(flips) if f]), turned, step


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Files (case_id, volume, content) as slice rows, one slice in hand at a time."""
    for batch in batches:
        for case, volume, content in zip(*(batch.column(i) for i in range(3))):
            packed = content.as_buffer() if content.is_valid else b""
            yield from slice_batches(case.as_py(), volume.as_py(), lambda packed=packed: pa.BufferReader(packed))


def slice_batches(case: str, volume: str, opened: Callable, **how) -> Iterator[pa.RecordBatch]:
    """Slice rows of one file; a fault is a row of its own, after the slices that came before it."""
    rows, held, meta = [], 0, None
    try:
        for h, z, plane in nifti.slices_of(opened, **how):
            if meta is None:
                shape, affine, spacing = h.grid()
                meta = (*shape, list(map(float, spacing)), affine.ravel().tolist())
            rows.append((case, volume, z, *meta, np.ascontiguousarray(plane).tobytes(), None))
            held += plane.nbytes
            if held > BATCH_BYTES:
                yield _batch(rows)
                rows, held = [], 0
    except Exception as e:  # one bad file is one row, not a failed job
        rows.append((case, volume, *(None,) * 7, str(e) or type(e).__name__))
    if rows:
        yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), ROW)], schema=ROW)


def volumes(spark: SparkSession, path: str | list[str], volume: str = "image") -> DataFrame:
    """One row per slice, to the right, anterior, superior, 16-bit little-endian.

    A file that cannot be read gives a row with its error; one that ends early
    also the slices before that.  Works on every store that Spark reads; in a
    worker are the packed file and one slice (a slab of them, where the stored
    planes are not slices).  ``source.VolumeSource`` reads from a mounted folder,
    without the packed file in memory.
    """
    files = spark.read.format("binaryFile").load(path)
    rows = files.where(~base_name(F.col("path")).startswith(".")).select(case_id(F.col("path")).alias("case_id"), F.lit(volume).alias("volume"), "content")
    return rows.mapInArrow(_slices, SLICES)


def from_array(spark: SparkSession, data: np.ndarray, affine: np.ndarray, case: str = "tmp", volume: str = "image", spacing: tuple[float, ...] | None = None, slab: int = 64) -> DataFrame:
    """An array (x, y, z) and its affine as slice rows, turned as files are; a slab of ``slab`` slices at a time goes to Spark.

    Without ``spacing`` the affine's own.  Values are cut to whole numbers; such
    as 16 bits do not hold are an error.
    """
    data, affine = np.asarray(data), np.asarray(affine, float)
    if data.ndim != 3 or not data.size:
        raise ValueError(f"not one volume of three dimensions: {data.shape}")
    view, turned, step = oriented(data, affine, tuple(spacing or np.sqrt((affine[:3, :3] ** 2).sum(axis=0))))
    h = nifti.Header(data.dtype.str, data.shape, 0, 1.0, 0.0, affine, step)
    meta = (*view.shape, list(map(float, step)), turned.ravel().tolist())
    parts = []
    for first in range(0, view.shape[2], slab):
        planes = [(z, np.ascontiguousarray(nifti.whole(view[:, :, z], h)).tobytes()) for z in range(first, min(view.shape[2], first + slab))]
        parts.append(spark.createDataFrame(pa.Table.from_batches([_batch([(case, volume, z, *meta, plane, None) for z, plane in planes])]), SLICES))
    return functools.reduce(DataFrame.unionByName, parts)


def voxels_of(slices: DataFrame, value: str = "hu") -> DataFrame:
    """case_id, x, y, z, value of slice rows; decoding stays on the JVM's side of no shuffle."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for case, z, nx, ny, data in zip(batch["case_id"], batch["z"], batch["nx"], batch["ny"], batch["data"]):
                x, y = np.divmod(np.arange(nx * ny), ny)
                yield pd.DataFrame({"case_id": case, "x": x, "y": y, "z": z, value: np.frombuffer(data, "<i2")})

    good = slices.where("error IS NULL").select("case_id", "z", "nx", "ny", "data")
    return good.mapInPandas(run, f"case_id string, x int, y int, z int, {value} smallint")


def write_slices(slices: DataFrame, path: str) -> None:
    """A folder for each volume and case; other cases there stay as they are."""
    writer = slices.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("volume", "case_id").parquet(path)


def stored(spark: SparkSession, path: str, volume: str | Sequence[str]) -> DataFrame:
    """The slice rows of a volume, or of several by a list of names, below ``path``, none if nothing is there; folders of other volumes are not read."""
    wanted = [volume] if isinstance(volume, str) else list(volume)
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    names = [c.split()[0] for c in SLICES.split(", ")]
    if not place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], SLICES)
    return spark.read.schema(SLICES).parquet(path).where(F.col("volume").isin(wanted)).select(*names)


def reused(rows: DataFrame, path: str, volume: str, make: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The slice rows of ``volume`` for the cases of ``rows``: what is stored at ``path``, and what ``make`` makes of the others' rows, stored there too.

    ``make`` gets no row of a case that is stored, so a model runs once a case;
    cases stored with an error are made again.  Runs at once; a run that fails
    leaves only whole cases behind, which the next one reuses.
    """
    spark = rows.sparkSession
    there = stored(spark, path, volume).where("error IS NULL").select("case_id").distinct()
    # rows that ``make`` gives for a stored case would overwrite it
    made = make(rows.join(there, "case_id", "left_anti")).join(there, "case_id", "left_anti")
    write_slices(made.withColumn("volume", F.lit(volume)), path)
    return stored(spark, path, volume).join(rows.select("case_id").distinct(), "case_id", "left_semi")


def write_frame(frame: DataFrame, path: str, key: str = "case_no", order: Sequence[str | Column] = ()) -> None:
    """CSV with a header, a folder for each case: cases written again replace their rows, others stay.

    With ``order`` (``frame.place(ref)`` and ``ref``, or ``slice``) a case is one
    file, its rows in that order.  Rejects are written alike: case, error.
    """
    if order:
        frame = frame.repartition(key).sortWithinPartitions(key, *order)
    frame.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("header", True).partitionBy(key).csv(path)


def unpivoted(metadata: DataFrame, keys: list[str], case: str = "case_id") -> DataFrame:
    """(case, k, v), a row for each key that a case has; what ``cases.pivoted`` undoes."""
    rows = metadata.select(case, F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(k).cast("string").alias("v")) for k in keys])).alias("p"))
    return rows.select(case, "p.*").where("v IS NOT NULL")


def write_volumes(packed: DataFrame, path: str) -> None:
    """Each row's content (case_id, volume, content) as a file ``volume/case_id.nii.gz`` below the path, by its executor."""
    target = path.rstrip("/")
    if "://" in target and not target.startswith("file://"):
        raise ValueError("volumes are written to a mounted folder that all executors share")
    folder = target.removeprefix("file://")

    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for case, volume, content in zip(batch["case_id"], batch["volume"], batch["content"]):
                os.makedirs(f"{folder}/{volume}", exist_ok=True)
                temporary = f"{folder}/{volume}/.{case}.{uuid.uuid4().hex}"
                with open(temporary, "wb") as f:
                    f.write(content)
                os.replace(temporary, f"{folder}/{volume}/{case}.nii.gz")  # a task that runs twice leaves one whole file
            yield batch[["case_id"]]

    packed.where("content IS NOT NULL").select("case_id", "volume", "content").mapInPandas(put, "case_id string").count()


def packed_volumes(slices: DataFrame) -> DataFrame:
    """case_id, volume, content, error: each case's slices as one packed file, in its place in space.

    The affine belongs to the scan's first slice; where the slices begin further up
    (a cropped volume) it is moved there.  Slices that are missing, broken or of
    several sizes are the case's error.
    """
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("z")
        f, content, error = pdf.iloc[0], None, None
        try:
            if (np.diff(pdf["z"]) != 1).any():
                raise ValueError("slices are missing")
            data = np.stack([np.frombuffer(d, "<i2").reshape(nx, ny) for d, nx, ny in zip(pdf["data"], pdf["nx"], pdf["ny"])], axis=2)
            affine = np.array(shifted(f["affine"], 0, 0, int(f["z"]))).reshape(4, 4)
            content = encode(data, affine, tuple(f["spacing"]))
        except ValueError as e:
            error = str(e)
        return pd.DataFrame([(f["case_id"], f["volume"], content, error)], columns=["case_id", "volume", "content", "error"])

    return slices.where("error IS NULL").groupBy("case_id", "volume").applyInPandas(run, "case_id string, volume string, content binary, error string")


def as_slices(volumes: DataFrame, column: str) -> DataFrame:
    """Rows of a volume as slice rows: case_no, z, nx, ny, sx, sy, sz, affine and the volume as ``column``."""
    spacing = [F.col("spacing")[i].cast("double").alias(c) for i, c in enumerate(("sx", "sy", "sz"))]
    return volumes.where("error IS NULL").select(F.col("case_id").alias("case_no"), "z", "nx", "ny", *spacing, "affine", F.col("data").alias(column))


def as_volume(slices: DataFrame, column: str, volume: str) -> DataFrame:
    """The other way round, of slice rows with ``affine``: what ``packed_volumes`` and ``write_slices`` take; faulty slices become errors."""
    fault = F.col("fault") if "fault" in slices.columns else F.lit(None).cast("string")
    spacing = F.array("sx", "sy", "sz").cast("array<float>").alias("spacing")
    return slices.select(F.col("case_no").cast("string").alias("case_id"), F.lit(volume).alias("volume"), "z", "nx", "ny", F.lit(None).cast("int").alias("nz"), spacing, "affine", F.col(column).alias("data"), fault.alias("error"))


def write_errors(errors: DataFrame, path: str) -> None:
    """``case,error`` as CSV, in one table for all cases; a later run adds its own."""
    errors.select(F.col(errors.columns[0]).alias("case"), "error").write.mode("append").option("header", True).csv(path)
