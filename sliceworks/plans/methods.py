"""The registered methods as lazy plans over slice rows."""

from __future__ import annotations

import functools
from dataclasses import replace

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.labels import BOXES, IMAT, METHODS, PSOAS, PSOAS_SOURCE, SACRUM, SAT, SM, VAT, Method, TissueParams
from ..operators import cases, frame, grid, hist, levels, morph, slices
from ..operators.slices import plane, with_planes
from ..sources import files
from ..sources.results import Results
from ..stages import Stages

#: Volumes that a method reads besides hu, tissue and vert.
EXTRA = {"vertebral_bodies": "vb", "trunk": "trunk", "psoas": "iliopsoas"}


def needed(method: str) -> tuple[str, ...]:
    """The volumes that the method reads."""
    if method not in METHODS:
        raise ValueError(f"unknown method {method}; there are {sorted(METHODS)}")
    return ("hu", "tissue", "vert", *(v for k, v in EXTRA.items() if getattr(METHODS[method], k)))


def vertebrae(rows: DataFrame, m: Method) -> DataFrame:
    """The vertebra labels in our numbers, inside the vertebral bodies where the method says so."""
    if not (m.spine or m.vertebral_bodies):
        return rows
    table = np.zeros(1 << 16, np.int16)
    for old, new in (m.spine or {}).items():
        table[old] = new

    def run(row):
        vert = plane(row.vert, row)
        if m.spine:
            vert = table[vert.astype(np.uint16)]
        if m.vertebral_bodies:
            vert = np.where((plane(row.vb, row) == 1) | ((vert == SACRUM) & m.readd_sacrum), vert, 0)
        return {"vert": vert}

    return with_planes(rows, run, ("vert",))


def tissues(rows: DataFrame, m: Method, stages: Stages | None = None) -> DataFrame:
    """Tissue after psoas, intensity ranges and their size filters; muscle in the fat range becomes IMAT."""
    p: TissueParams = m.tissue

    def marked(name: str, hu: np.ndarray, tissue: np.ndarray) -> np.ndarray:
        low, high = getattr(p, name)
        inside = (hu >= low) & (hu <= high)
        labels = {"imat": (), "sm": (SM, PSOAS), "vat": (VAT,), "sat": (SAT,)}[name]
        return np.isin(tissue, labels) & ~inside if labels else inside

    def applied(name: str, mask: np.ndarray, tissue: np.ndarray) -> np.ndarray:
        if name == "imat":
            return np.where(mask & np.isin(tissue, (SM, PSOAS)), IMAT, tissue)
        return np.where(mask, 0, tissue)

    def small(name: str, mask: np.ndarray, row) -> np.ndarray:
        least = p.least_mm2.get(name, 0)
        return morph.large_ones(mask, least / (row.sx * row.sy)) if least > 0 else mask

    def begin(row):
        hu, tissue = plane(row.hu, row), plane(row.tissue, row)
        if p.clip:
            hu = np.clip(hu, *p.clip)
        if m.psoas:
            tissue = np.where(np.isin(plane(row.iliopsoas, row), PSOAS_SOURCE), PSOAS, tissue)
        return {"hu": hu, "tissue": tissue}

    rows = with_planes(rows, begin, ("hu", "tissue"))
    if p.median:
        rows = slices.median_filtered(rows, to="hu", kernel=p.median)
    if not any(p.least_mm3.get(n, 0) > 0 for n in ("imat", "sm", "vat", "sat")):
        def every(row):
            hu, tissue = plane(row.hu, row), plane(row.tissue, row)
            for name in ("imat", "sm", "vat", "sat"):
                tissue = applied(name, small(name, marked(name, hu, tissue), row), tissue)
            return {"tissue": tissue}

        return with_planes(rows, every, ("tissue",))
    kept = rows.columns
    for name in ("imat", "sm", "vat", "sat"):
        rows = with_planes(rows, lambda row, n=name: {"marked": small(n, marked(n, plane(row.hu, row), plane(row.tissue, row)), row)}, ("marked",))
        rows = morph.without_small(rows, "marked", p.least_mm3.get(name, 0), three_d=True, stages=stages)
        rows = with_planes(rows, lambda row, n=name: {"tissue": applied(n, plane(row.marked, row) > 0, plane(row.tissue, row))}, ("tissue",)).select(*kept)
    return rows


def trunk_of(rows: DataFrame, stages: Stages | None = None) -> DataFrame:
    """The trunk as one body without holes; ``rows`` are a table, as they are read more than once."""
    whole = with_planes(rows, lambda row: {"trunk": plane(row.trunk, row) == 1}, ("trunk",))
    return morph.fill_holes(morph.keep_largest(whole, "trunk", stages=stages, cut=False), "trunk", stages=stages)


def run(rows: DataFrame, method: str = "lumbar_quick", min_voxels: int | None = None, tissue: TissueParams | None = None, stages: Stages | None = None) -> dict[str, DataFrame]:
    """Results of slice rows with the volumes that the method needs, each case by its own shape and spacing.

    raw: a row per slice, by the scan's own slice number.  l3_mean: a row per case,
    for the methods that have it.  errors: case_no and error of the cases whose box
    is empty, in which no slice has a level, or with a slice that could not be
    worked on; they have no other rows.

    The voxels are worked on here and now: what comes of them is a table of counts,
    from which the results follow.  ``stages`` holds the tables until it is closed,
    which is after the results were read; without it they go with the session.
    """
    wanted, m = needed(method), METHODS[method]
    m = replace(m, tissue=tissue or m.tissue)
    p = m.levels if min_voxels is None else replace(m.levels, min_voxels=min_voxels)
    stages = stages or Stages(rows.sparkSession, method)
    extra = [c for c in ("has", "fault") if c in rows.columns]
    rows = vertebrae(slices.guarded(rows.select(*slices.KEY, *slices.META, *wanted, *extra)), m)
    if m.box or m.trunk:
        rows = stages.cut(rows, "slices")  # read for the boxes, for the trunk and for the tissue
    errors = []
    if m.box:
        boxes = stages.cut(grid.bounding_boxes(slices.bounds(rows, "vert", BOXES[m.box].roi), BOXES[m.box]), "boxes")
        errors.append(boxes.where("error IS NOT NULL").select("case_no", "error"))
        rows = slices.cropped(rows, boxes)
    masked = tissues(rows, m, stages)
    if m.trunk:
        trunk = trunk_of(rows.select(*slices.KEY, *slices.META, "trunk", "fault"), stages).select(*slices.KEY, "trunk", F.col("fault").alias("trunk_fault"))
        both = masked.drop("trunk").join(trunk, [*slices.KEY]).withColumn("fault", F.coalesce("fault", "trunk_fault")).drop("trunk_fault")
        masked = with_planes(both, lambda row: {"tissue": np.where(plane(row.trunk, row) > 0, plane(row.tissue, row), 0)}, ("tissue",))
    counts = stages.cut(slices.histograms(masked, ("vert", "tissue")), "counts")
    faulty = counts.where("fault IS NOT NULL").groupBy("case_no").agg(F.min(F.struct("z", "fault")).alias("f")).select("case_no", F.concat(F.lit("slice "), F.col("f.z"), F.lit(": "), "f.fault").alias("error"))
    whole = counts.join(faulty, "case_no", "left_anti")
    counted = whole.where("volume = 'vert'").select("case_no", "z", "label", "n")
    none = levels.without_levels(counted, p)
    errors += [none, faulty]
    pixels = whole.groupBy("case_no").agg(F.first("sx").alias("sx"), F.first("sy").alias("sy"))
    raw = frame.combined(levels.level_table(counted, p, stages), hist.areas(whole.where("volume = 'tissue'"), pixels)).join(none, "case_no", "left_anti")
    out = {"raw": raw, "errors": functools.reduce(DataFrame.unionByName, errors)}
    if m.l3_mean:
        out["l3_mean"] = frame.aggregated(frame.subset(raw, "level", "L3"), "mean", "level")
    return out


def run_files(spark: SparkSession, image: str | list[str], labels: dict[str, str | list[str]], method: str = "lumbar_quick", metadata: str | None = None, stages: Stages | None = None, **how) -> dict[str, DataFrame]:
    """``run`` over files: ``image`` and, for every other volume that the method needs, a folder or pattern of NIfTI files.

    A case is a file name up to its first dot; files of one case must lie on one
    grid.  Files that cannot be read, cases that lack a volume and cases of
    different grids are rows of errors, the others go on.  Each file is decoded
    once.  ``metadata``: a folder of key,value files by case; with it the rows of
    the results carry the ten columns of ``frame.CASE``, and dates that are none
    are rows of errors too (their cases stay, without a date).
    """
    stages = stages or Stages(spark, method)
    wanted = needed(method)
    if missing := set(wanted[1:]) - set(labels):
        raise ValueError(f"the method needs {sorted(missing)}")
    tables = {n: stages.cut(files.volumes(spark, image if n == "hu" else labels[n], n), n) for n in wanted}
    unread = [t.where("error IS NOT NULL").select(F.col("case_id").alias("case_no"), F.concat(F.lit(f"{n}: "), "error").alias("error")) for n, t in tables.items()]
    good = {n: t.where("error IS NULL") for n, t in tables.items()}
    grids = {n: t.groupBy(F.col("case_id").alias("case_no")).agg(F.first(F.array("nx", "ny", "nz")).alias("shape"), F.first(F.col("spacing").cast("array<double>")).alias("spacing"), F.first("affine").alias("affine")) for n, t in good.items()}
    bad = [grid.same_grid(grids["hu"], grids[n]).where("error IS NOT NULL").select("case_no", F.concat(F.lit(f"{n}: "), "error").alias("error")) for n in wanted[1:]]
    bad += [grids["hu"].join(grids[n], "case_no", "left_anti").select("case_no", F.lit(f"{n}: no volume").alias("error")) for n in wanted[1:]]
    errors = unread[0]
    for e in (*unread[1:], *bad):
        errors = errors.unionByName(e)
    rows = files.as_slices(good["hu"], "hu").drop("affine")
    for n in wanted[1:]:
        rows = rows.join(good[n].select(F.col("case_id").alias("case_no"), "z", F.col("data").alias(n)), ["case_no", "z"])
    errors = stages.cut(errors, "errors")
    found = run(rows.join(errors.select("case_no").distinct(), "case_no", "left_anti"), method, stages=stages, **how)
    errors = errors.unionByName(found["errors"])
    if metadata:
        thickness = grids["hu"].select("case_no", F.col("spacing")[2].alias("scan_slicethickness"))
        given = stages.cut(cases.pivoted(files.metadata_pairs(spark, metadata), list(cases.METADATA)), "metadata")
        about = frame.case_columns(thickness, given)
        errors = errors.unionByName(cases.date_errors(given, "AcquisitionDate").select(F.col("case_id").alias("case_no"), "error"))
        found |= {k: frame.described(t, about) for k, t in found.items() if k != "errors"}
    return found | {"errors": errors}


def run_open(spark: SparkSession, image: str, labels: dict[str, str], results: Results, workspace: str, method: str = "lumbar_quick", again: bool = False, **how) -> str | None:
    """``run_files`` for the cases of the folder ``image`` that ``results`` has not done (``again``: for all), and their commit; the run's name, None if none was open.

    Only files of open cases are read.  A run that fails leaves nothing that is
    seen; one that is repeated adds no row twice.
    """
    listed = files.directory(spark, image).select("path", F.col("case_id").alias("case_no"))
    todo = listed if again else results.remaining(listed, workspace)
    paths = {r["case_no"]: r["path"] for r in todo.toLocalIterator()}  # names of files, as Spark lists them anyway
    if not paths:
        return None
    own = {n: [r["path"] for r in files.directory(spark, place).toLocalIterator() if r["case_id"] in paths] for n, place in labels.items()}
    with Stages(spark, method) as stages:
        if not all(own.values()):
            missing = [n for n, found in own.items() if not found]
            lost = spark.createDataFrame([(c, f"{n}: no volume") for c in paths for n in missing], "case_no string, error string")
            return results.commit({}, lost, workspace, lost)
        out = run_files(spark, list(paths.values()), own, method, stages=stages, **how)
        errors = out.pop("errors")
        return results.commit(out, todo, workspace, errors)


def modelled(rows: DataFrame, predict, made: str) -> DataFrame:
    """A pluggable model: ``predict`` gets a slice (x, y) of intensities and returns its labels, the volume ``made``.  ``models`` has those in three dimensions."""
    return with_planes(rows, lambda row: {made: predict(plane(row.hu, row))}, (made,))
