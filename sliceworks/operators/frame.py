"""The result frame: combination, names, subsets, aggregates, export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import TISSUES, VERTEBRAE
from .cases import METADATA, patient_id, scan_date

REFS = ("level", "center", "centroid", "tag")
MEASURES = tuple(f"mm2_{n.lower()}" for n in TISSUES.values())


def named(label: Column) -> Column:
    """A vertebra's name; '0' where undefined."""
    names = F.create_map(*[F.lit(x) for kv in VERTEBRAE.items() for x in kv])
    return F.coalesce(F.element_at(names, label.cast("int")), F.lit("0"))


def combined(levels: DataFrame, csa: DataFrame) -> DataFrame:
    """One row per slice: level, center and centroid by name, an empty tag, areas."""
    rows = levels.join(csa, ["case_no", "z"])
    return rows.select("case_no", F.col("z").alias("slice"), *[named(F.col(c)).alias(c) for c in ("level", "center", "centroid")], F.lit(None).cast("string").alias("tag"), *MEASURES)


def wanted_levels(level) -> list[str]:
    """'ALL', 'L' (lumbar), a name or a list of names; anything else is an error."""
    if level == "ALL":
        return list(VERTEBRAE.values())
    if level == "L":
        return [n for n in VERTEBRAE.values() if n.startswith("L")]
    names = [level] if isinstance(level, str) else list(level)
    unknown = [n for n in names if n not in VERTEBRAE.values()]
    if unknown:
        raise ValueError(f"unknown levels {unknown}")
    return names


def subset(frame: DataFrame, ref: str | None, level) -> DataFrame:
    """Rows whose ``ref`` is among the levels; all rows without a ref."""
    if not ref:
        return frame
    if ref not in REFS:
        raise ValueError(f"unknown ref {ref}")
    return frame.where(F.col(ref).isin(wanted_levels(level)))


def tagged(frame: DataFrame, tags: dict[str, str], source: str = "level") -> DataFrame:
    """The tag of each row's level; null where none is given."""
    return frame.withColumn("tag", F.element_at(F.create_map(*[F.lit(x) for kv in tags.items() for x in kv]), F.col(source)))


def single(c: str) -> Column:
    """The one value of a group, null if it has several or none."""
    return F.when(F.min(c) == F.max(c), F.min(c))


def aggregated(frame: DataFrame, method: str, ref: str | None = None) -> DataFrame:
    """Areas in cm2 by case (and ref), two digits, halves to even; from whole mm2, divided once.

    Rows with a null ref are left out; the undefined level '0' is a group.
    """
    if method not in ("mean", "median", "sum"):
        raise ValueError(f"unknown method {method}")
    if ref is not None and ref not in REFS:
        raise ValueError(f"unknown ref {ref}")

    def value(c: str) -> Column:
        if method == "median":
            v = F.median(F.col(c).cast("double"))
        elif method == "mean":
            v = F.sum(c).cast("double") / F.count(c).cast("double")
        else:
            v = F.sum(c).cast("double")
        return F.rint(v) / F.lit(100.0)

    rows = frame if ref is None else frame.where(F.col(ref).isNotNull())
    keys = ["case_no"] + ([ref] if ref else [])
    kept = [single(c).alias(c) for c in ("slice", "level", "center", "centroid", "tag") if c != ref]
    return rows.groupBy(*keys).agg(*[value(c).alias(c.replace("mm2", "csa")) for c in MEASURES], *kept)


def in_cm(frame: DataFrame) -> DataFrame:
    return frame.select(*[(F.col(c).cast("double") / F.lit(100.0)).alias(c.replace("mm2", "csa")) if c in MEASURES else F.col(c) for c in frame.columns])


def with_metadata(frame: DataFrame, metadata: DataFrame) -> DataFrame:
    """Each case's metadata on all of its rows; nulls for cases without any."""
    return frame.join(metadata, "case_no", "left")


#: What a case is, in front of its rows.
CASE = ("case_id", "case_timestamp", "pat_id", "pat_prefix", "pat_suffix", "pat_sex", "pat_size", "pat_weight", "scan_date", "scan_slicethickness")


def case_columns(thickness: DataFrame, given: DataFrame) -> DataFrame:
    """The ten columns for each case: case_no, and of ``thickness`` (case_no, scan_slicethickness) and ``given`` (case_id and the keys of ``cases.METADATA``) what there is; ids come from the case's name.

    The time is one for all, that of the run.
    """
    both = thickness.join(given.withColumnRenamed("case_id", "case_no"), "case_no", "left")
    rest = [F.col(k).alias(c) for k, c in METADATA.items() if c != "scan_date"]
    made = F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("case_timestamp")
    return both.select("case_no", F.col("case_no").alias("case_id"), made, *patient_id(F.col("case_no")), *rest, scan_date(F.col("AcquisitionDate")).alias("scan_date"), "scan_slicethickness")


def described(frame: DataFrame, about: DataFrame) -> DataFrame:
    """The frame with the case's columns in front, on all of its rows."""
    return frame.join(about, "case_no", "left").select("case_no", *CASE, *[c for c in frame.columns if c != "case_no"])


def numbered(frame: DataFrame) -> DataFrame:
    """Rows from head to foot: rn counts the slices of a case downwards."""
    from pyspark.sql import Window

    return frame.withColumn("rn", F.row_number().over(Window.partitionBy("case_no").orderBy(F.desc("slice"))))


def place(ref: str) -> Column:
    """The place from head to foot of a vertebra's name; names that are none come first."""
    places = F.create_map(*[F.lit(x) for k, v in VERTEBRAE.items() for x in (v, k)])
    return F.coalesce(F.element_at(places, F.col(ref)), F.lit(0))


def ordered(frame: DataFrame, ref: str) -> DataFrame:
    """By case, then by the ref's place, then by its name."""
    return frame.orderBy("case_no", place(ref), ref)
