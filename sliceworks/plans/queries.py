"""One query per operator over the synthetic relation."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import BOXES, METHODS, SPINE_A, SPINE_B, BoxParams, LevelParams, TissueParams
from ..operators import cases, frame, grid, hist, levels, morph, slices, voxel
from ..sources.synthetic import MIN_VOXELS, SHAPE, SPACING, voxels
from ..stages import Stages
from . import methods, models

P = LevelParams(min_voxels=MIN_VOXELS)
PIXEL = SPACING[0] * SPACING[1]
KEY = ["case_no", "x", "y", "z"]


def _slices(s, d, *columns, **made):
    """Slice rows of the relation's columns, and of others made from them."""
    return slices.stacked(voxels(s, d).withColumns({k: v.cast("int") for k, v in made.items()}), (*columns, *made), SHAPE, SPACING)


def _volumes(s, d):
    """Each case with the relation's one shape and spacing."""
    grid_of = [F.lit(v).alias(c) for c, v in zip(("nx", "ny", "nz", "sx", "sy", "sz"), (*SHAPE, *SPACING))]
    return voxels(s, d).select("case_no").distinct().select("case_no", *grid_of)


def _vert(s, d):
    return hist.slice_histogram(voxels(s, d), "vert")


def _masked(s, d):
    return voxels(s, d).withColumn("tissue", voxel.masked_tissue(F.col("tissue"), F.col("hu")))


def _csa(s, d):
    return hist.areas(hist.slice_histogram(_masked(s, d), "tissue"), PIXEL)


def _frame(s, d):
    return frame.combined(levels.level_table(_vert(s, d), P), _csa(s, d))


def _meta(s, d):
    return s.read.parquet(f"{d}/customer.parquet").select(F.col("c_custkey").cast("int").alias("case_no"), F.col("c_mktsegment").alias("pat_sex"), F.col("c_acctbal").alias("pat_weight"))


def flagship_l3_mean(s, d):
    both = frame.combined(hist.dominant(_vert(s, d), P).select("case_no", "z", "level", F.lit(0).alias("center"), F.lit(0).alias("centroid")), _csa(s, d))
    return frame.aggregated(frame.subset(both, "level", "L3"), "mean", "level").drop("slice", "center", "centroid", "tag")


def _remap(column, mapping):
    def q(s, d):
        v = voxels(s, d)
        return v.select(*KEY, voxel.remapped(column(v), mapping).alias("label"))

    return q


remap_labels = _remap(lambda v: F.col("tissue"), {1: 7, 2: 7, 4: 3})
remap_spine_a = _remap(lambda v: F.col("event_id") % 50, SPINE_A)
remap_spine_b = _remap(lambda v: F.col("event_id") % 30, SPINE_B)


def hu_filter(s, d):
    return voxels(s, d).where(voxel.in_range(F.col("hu"), TissueParams().sm)).select(*KEY, "hu")


def hu_clip(s, d):
    return voxels(s, d).select(*KEY, voxel.clipped(F.col("hu"), (-100, 120)).alias("hu"))


def hu_median_filter(s, d):
    return slices.unstacked(slices.median_filtered(_slices(s, d, "hu")), ("hu_median",))


def overlay_psoas(s, d):
    return voxels(s, d).select(*KEY, voxel.with_psoas(F.col("tissue"), F.col("iliopsoas")).alias("tissue"))


def tissue_mask(s, d):
    return _masked(s, d).select(*KEY, "tissue")


def reduce_to_vb(s, d):
    return voxels(s, d).select(*KEY, voxel.within_bodies(F.col("vert"), F.col("vb")).alias("vert"))


def csa(s, d):
    return frame.in_cm(_csa(s, d))


def dominant_level(s, d):
    return hist.dominant(_vert(s, d), P)


def windowed_counts(s, d):
    return hist.windowed_counts(_vert(s, d), 2)


def level_span(s, d):
    return levels.spans(hist.dominant(_vert(s, d), P))


def fill_levels(s, d):
    h = _vert(s, d)
    return levels.filled(h, hist.dominant(h, P), P)


def non_monotonic(s, d):
    return levels.non_monotonic(fill_levels(s, d))


def correct_monotonic(s, d):
    h = _vert(s, d)
    return levels.monotonic(h, levels.filled(h, hist.dominant(h, P), P), P)


def center_slice(s, d):
    h = _vert(s, d)
    return levels.center_slices(h, hist.dominant(h, P))


def centroid_slice(s, d):
    h = _vert(s, d)
    return levels.centroid_slices(h, hist.dominant(h, P))


def level_names(s, d):
    return levels_named(levels.level_table(_vert(s, d), P))


def levels_named(t: DataFrame) -> DataFrame:
    return t.select("case_no", "z", *[frame.named(F.col(c)).alias(c) for c in ("level", "center", "centroid")])


def combine(s, d):
    return frame.numbered(frame.in_cm(_frame(s, d)))


def export_with_metadata(s, d):
    return frame.with_metadata(frame.in_cm(_frame(s, d)).drop("tag"), _meta(s, d))


def _subset(level):
    return lambda s, d: frame.in_cm(frame.subset(_frame(s, d), "level", level)).drop("tag")


subset_l3, subset_all, subset_lumbar = _subset("L3"), _subset("ALL"), _subset("L")


def _aggregate(method, ref, before=lambda f: f):
    return lambda s, d: frame.aggregated(before(_frame(s, d)), method, ref).drop("tag" if ref != "tag" else "slice")


aggregate_mean, aggregate_median, aggregate_sum = (_aggregate(m, "level") for m in ("mean", "median", "sum"))
aggregate_by_center, aggregate_by_centroid = _aggregate("mean", "center"), _aggregate("mean", "centroid")
aggregate_tag = _aggregate("mean", "tag", lambda f: frame.tagged(f, {"L3": "mid", "L2": "near", "L4": "near"}))
aggregate_case = _aggregate("mean", None)

BOX = BoxParams((15,), (True,) * 6, (0.0, 0.0, 2.0, 2.0, 6.0, 6.0))


def _boxes(s, d, box):
    return grid.bounding_boxes(grid.bounds(voxels(s, d), "vert", box, _volumes(s, d)), box)


def bbox_create(s, d):
    return _boxes(s, d, BOX).drop("error")


def bbox_apply(s, d):
    return grid.cropped(voxels(s, d), _boxes(s, d, BOXES["L234CranioCaudal"])).select(*KEY, "hu")


def bbox_spine(s, d):
    return _boxes(s, d, BOXES["SpineCranioCaudal"])


def bbox_affine(s, d):
    boxes = bbox_create(s, d)
    affine = F.array(*[F.lit(float(v)) for v in (-1.5, 0, 0, 10, 0, 1.5, 0, -20, 0, 0, 5, 30, 0, 0, 0, 1)])
    return grid.shifted_affine(boxes.select("case_no", affine.alias("affine")), boxes)


def reorient(s, d):
    return grid.reoriented(voxels(s, d).select(*KEY, "hu"), SHAPE, (1, 0, 2), (False, True, True))


def _kept(rows):
    return slices.unstacked(rows, ("mask",)).where("mask > 0").select("case_no", "x", "y", "z")


def size_filter_2d(s, d):
    return _kept(morph.without_small(_slices(s, d, mask=F.col("tissue") == 4), "mask", 6.75))


def size_filter_3d(s, d):
    return _kept(morph.without_small(_slices(s, d, mask=F.col("tissue") == 4), "mask", 56.25, True))


def keep_largest(s, d):
    return _kept(morph.keep_largest(_slices(s, d, mask=F.col("tissue") == 3), "mask"))


def fill_holes(s, d):
    return _kept(morph.fill_holes(_slices(s, d, mask=F.col("hu") > -170), "mask"))


def trunk_restrict(s, d):
    rows = _slices(s, d, "tissue", "trunk")
    stages = Stages(s, "trunk")
    rows = stages.cut(rows, "slices")
    whole = rows.drop("trunk").join(methods.trunk_of(rows.drop("tissue"), stages).select("case_no", "z", "trunk"), ["case_no", "z"])
    return slices.unstacked(whole, ("tissue", "trunk")).select(*KEY, F.when(F.col("trunk") > 0, F.col("tissue")).otherwise(0).alias("tissue"))


#: Above this sum of a voxel's intensity and those above and below, the stand-in for a model says 1.
STANDS_OUT = -300


def _stands_out():
    """A stand-in for a model that looks at the slices above and below."""
    def sums(hu):
        wide = np.pad(hu.astype(np.int64), ((0, 0), (0, 0), (1, 1)))
        return wide[:, :, :-2] + wide[:, :, 1:-1] + wide[:, :, 2:]

    return sums


def _load_labels():
    sums = _stands_out()
    return lambda hu, spacing: sums(hu) > STANDS_OUT


def _load_scores():
    sums = _stands_out()
    return lambda hu, spacing: np.stack([np.zeros(hu.shape), sums(hu) - STANDS_OUT])


def model_slabs(s, d):
    return slices.unstacked(models.modelled(_slices(s, d, "hu"), _load_labels, "label", depth=6, halo=2), ("label",))


def model_scores(s, d):
    return slices.unstacked(models.scored(_slices(s, d, "hu"), _load_scores, "label", depth=6, halo=3, margin=1), ("label",))


# --- cases
def _pages(s, d):
    return s.read.parquet(f"{d}/pages.parquet").select("page_id", "url")


def case_filter(s, d):
    return cases.matching(_pages(s, d), "url", "[0-9]*[02468]").select("page_id", cases.case_id(F.col("url")).alias("case_id"), cases.slug(F.col("url")).alias("slug"))


def _listing(s, d):
    orders = s.read.parquet(f"{d}/orders.parquet")
    return orders.select(F.col("o_custkey").alias("case_id"), F.col("o_orderpriority").alias("item"))


def _customers(s, d):
    return s.read.parquet(f"{d}/customer.parquet").select(F.col("c_custkey").alias("case_id"))


NEEDED = ["1-URGENT", "2-HIGH"]


def require_inputs(s, d):
    return cases.with_required(_customers(s, d), _listing(s, d), NEEDED)


def skip_completed(s, d):
    return cases.not_completed(_customers(s, d), _listing(s, d), NEEDED)


def case_funnel(s, d):
    path = cases.path_of("scans/{case}.nii.gz", F.col("case_id").cast("string"))
    c = _customers(s, d).join(cases.have(_listing(s, d), {"inputs": NEEDED[:1], "done": NEEDED}), "case_id", "left")
    steps = {"all": F.lit(True), "matching": cases.named_like(path, "[12]"), "inputs": F.col("inputs"), "open": ~F.coalesce("done", F.lit(False))}
    return cases.counted(c, steps)


def metadata_left_join(s, d):
    have = s.read.parquet(f"{d}/events.parquet").select((F.col("event_id") / 1000.0).cast("int").alias("case_no")).distinct()
    return have.join(_meta(s, d), "case_no", "left")


def metadata_pivot(s, d):
    o = s.read.parquet(f"{d}/orders.parquet")
    pairs = o.select(F.col("o_custkey").alias("case_id"), F.col("o_orderkey").alias("line"), F.col("o_orderstatus").alias("k"), F.col("o_orderpriority").alias("v"))
    return cases.pivoted(pairs, ["F", "O", "P"])


def metadata_merge(s, d):
    r = s.read.parquet(f"{d}/customer.parquet").select(F.col("c_custkey").alias("case_id"), F.col("c_name").alias("sex"), F.col("c_mktsegment").alias("size"))
    orders = s.read.parquet(f"{d}/orders.parquet").select(F.col("o_custkey").alias("case_id")).distinct()  # some have no last slice
    last = r.join(orders, "case_id").select("case_id", F.when(F.col("case_id") % 4 == 0, F.lit("")).otherwise(F.concat(F.lit("new "), "sex")).alias("sex"), "size")
    return cases.merged_metadata(r.withColumn("size", F.lit("old")), last, ["sex", "size"])


def patient_id_parse(s, d):
    c = s.read.parquet(f"{d}/customer.parquet")
    name = F.when(F.col("c_custkey") % 4 == 0, F.concat(F.lit("AB-"), F.col("c_custkey").cast("string"), F.lit("-x"))).when(F.col("c_custkey") % 4 == 1, F.lit("AB--x")).when(F.col("c_custkey") % 4 == 2, F.lit("AB-")).otherwise(F.col("c_custkey").cast("string"))
    rows = c.select("c_custkey", name.alias("case_id"))
    return rows.select("c_custkey", "case_id", *cases.patient_id(F.col("case_id")))


def date_reformat(s, d):
    o = s.read.parquet(f"{d}/orders.parquet")
    text = F.when(F.col("o_orderkey") % 5 == 0, F.lit("20241399")).otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    return o.select("o_orderkey", cases.scan_date(text).alias("scan_date"))


def dicom_select(s, d):
    line = s.read.parquet(f"{d}/lineitem.parquet")
    kind = F.array(F.when(F.col("l_linenumber") % 2 == 0, F.lit("DERIVED")).otherwise(F.lit("Original")), F.lit("AXIAL"))
    axial = F.when(F.col("l_suppkey") % 7 == 0, F.lit(0.5)).otherwise(F.lit(1.0))
    o = F.array(axial, *[F.lit(float(v)) for v in (0, 0, 0, 1, 0)])
    heads = line.select(F.col("l_suppkey").alias("dir"), *cases.header_flags(kind, o))
    return cases.selected_series(heads, override=True, least=290)


# --- whole methods
def _method(name, what="raw"):
    """The method over the relation, whose vertebrae take the numbers of the method's own spine model before."""
    def q(s, d):
        spine = METHODS[name].spine or {}
        vert = {"vert": voxel.remapped(F.col("vert"), {ours: theirs for theirs, ours in spine.items()})} if spine else {}
        return methods.run(_slices(s, d, *(c for c in methods.needed(name) if c not in vert), **vert), name, MIN_VOXELS)[what].drop("tag")

    return q


method_lumbar_quick, method_whole_trunk = _method("lumbar_quick", "l3_mean"), _method("whole_trunk")
method_muscle_a, method_muscle_a_quick, method_muscle_b = _method("muscle_a"), _method("muscle_a_quick", "l3_mean"), _method("muscle_b")


NAMES = """flagship_l3_mean remap_labels remap_spine_a remap_spine_b hu_filter hu_clip hu_median_filter overlay_psoas tissue_mask
reduce_to_vb csa dominant_level windowed_counts level_span fill_levels non_monotonic correct_monotonic center_slice centroid_slice
level_names combine export_with_metadata subset_l3 subset_all subset_lumbar aggregate_mean aggregate_median aggregate_sum
aggregate_by_center aggregate_by_centroid aggregate_tag aggregate_case bbox_create bbox_apply bbox_affine reorient size_filter_2d
size_filter_3d keep_largest fill_holes trunk_restrict case_filter require_inputs skip_completed case_funnel metadata_left_join
metadata_pivot metadata_merge patient_id_parse date_reformat dicom_select bbox_spine method_lumbar_quick method_whole_trunk
method_muscle_a method_muscle_a_quick method_muscle_b model_slabs model_scores""".split()


def queries() -> dict:
    return {n: globals()[n] for n in NAMES}
