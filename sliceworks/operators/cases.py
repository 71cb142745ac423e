"""Cases: names, filters, completeness, identifiers, image series."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

MIN_SLICES = 30


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def case_id(path: Column) -> Column:
    """The file name up to its first dot."""
    return F.substring_index(base_name(path), ".", 1)


def named_like(path: Column, pattern: str) -> Column:
    """Whether the file name begins with the pattern and is not hidden."""
    name = base_name(path)
    return name.rlike(f"^(?:{pattern})") & ~name.startswith(".")


def matching(cases: DataFrame, path: str, pattern: str) -> DataFrame:
    """Cases whose file name begins with the pattern, hidden files left out."""
    return cases.where(named_like(F.col(path), pattern))


def with_required(cases: DataFrame, listing: DataFrame, needed: list[str], key: str = "case_id") -> DataFrame:
    """Cases of which the listing (key, item) has every needed item."""
    have = listing.where(F.col("item").isin(needed)).groupBy(key).agg(F.count_distinct("item").alias("n")).where(F.col("n") == len(set(needed)))
    return cases.join(have, key, "left_semi")


def not_completed(cases: DataFrame, listing: DataFrame, outputs: list[str], key: str = "case_id") -> DataFrame:
    """Cases of which some output is missing; without outputs no case counts as complete."""
    if not outputs:
        return cases
    done = listing.where(F.col("item").isin(outputs)).groupBy(key).agg(F.count_distinct("item").alias("n")).where(F.col("n") == len(set(outputs)))
    return cases.join(done, key, "left_anti")


# Fixed value: prefix, then id and suffix if there are any.
PATIENT = r"^([a-zA-Z0-9]+)-([a-zA-Z0-9]+)?-?([a-zA-Z0-9]+)?"


def patient_id(case: Column) -> list[Column]:
    """pat_prefix, pat_id, pat_suffix (null where missing); an id of another form is taken whole."""
    fits = case.rlike(PATIENT)
    part = lambda i: F.nullif(F.regexp_extract(case, PATIENT, i), F.lit(""))
    return [F.when(fits, part(1)).otherwise(F.lit("")).alias("pat_prefix"), F.when(fits, part(2)).otherwise(case).alias("pat_id"), F.when(fits, part(3)).otherwise(F.lit("")).alias("pat_suffix")]


# Keys of metadata files, and the columns they become.
METADATA = {"AcquisitionDate": "scan_date", "PatientSex": "pat_sex", "PatientSize": "pat_size", "PatientWeight": "pat_weight"}


def scan_date(text: Column) -> Column:
    """yyyymmdd as yyyy-mm-dd; null if it is no date."""
    return F.date_format(F.try_to_timestamp(text, F.lit("yyyyMMdd")), "yyyy-MM-dd")


def slug(text: Column) -> Column:
    return F.regexp_replace(text, r"\W+", "")


def pivoted(pairs: DataFrame, keys: list[str], case: str = "case_id") -> DataFrame:
    """(case, line, k, v) to one row per case; of a repeated key the last line counts."""
    return pairs.groupBy(case).agg(*[F.max_by(F.when(F.col("k") == k, F.col("v")), F.when(F.col("k") == k, F.col("line"))).alias(k) for k in keys])


def merged_metadata(first: DataFrame, last: DataFrame, keys: list[str], case: str = "case_id") -> DataFrame:
    """The last slice's values over the first's, where they are not empty."""
    both = first.join(last.select(case, *[F.col(k).alias(f"last_{k}") for k in keys]), case, "left")
    return both.select(case, *[F.coalesce(F.nullif(F.col(f"last_{k}"), F.lit("")), F.col(k)).alias(k) for k in keys])


def selected_series(headers: DataFrame, override: bool = False, least: int = MIN_SLICES) -> DataFrame:
    """dir, kind, n and status of each series.

    ``headers``: dir, is_primary, is_axial.  Primary axial images if there are
    any, else axial ones; with ``override`` also primary ones, then all.
    """
    counts = headers.groupBy("dir").agg(
        F.count_if(F.col("is_primary") & F.col("is_axial")).alias("pa"), F.count_if("is_axial").alias("ax"), F.count_if("is_primary").alias("pr"), F.count("*").alias("total"))
    kind = F.when(F.col("pa") > 0, "primary axial").when(F.col("ax") > 0, "axial")
    n = F.when(F.col("pa") > 0, F.col("pa")).when(F.col("ax") > 0, F.col("ax"))
    if override:
        kind = kind.when(F.col("pr") > 0, "primary").otherwise("all")
        n = n.when(F.col("pr") > 0, F.col("pr")).otherwise(F.col("total"))
    status = F.when(F.col("kind").isNull(), "no axial slices").when(F.col("n") < least, "too few slices").otherwise("ok")
    return counts.select("dir", kind.alias("kind"), F.coalesce(n, F.lit(0)).cast("long").alias("n")).withColumn("status", status)


def header_flags(image_type: Column, orientation: Column) -> list[Column]:
    """is_primary and is_axial of an image's header."""
    primary = F.exists(image_type, lambda t: F.lower(t).isin("primary", "original"))
    axial = orientation == F.array(*[F.lit(float(v)) for v in (1, 0, 0, 0, 1, 0)])
    return [primary.alias("is_primary"), F.coalesce(axial, F.lit(False)).alias("is_axial")]


def counted(cases: DataFrame, steps: dict[str, Column]) -> DataFrame:
    """step and n: how many cases each step leaves of those that the steps before it left; one pass over the cases."""
    left, kept = F.lit(True), {}
    for name, condition in steps.items():
        left = left & F.coalesce(condition, F.lit(False))
        kept[name] = left
    one = cases.agg(*[F.count_if(c).alias(name) for name, c in kept.items()])
    return one.select(F.explode(F.array(*[F.struct(F.lit(n).alias("step"), F.col(n).alias("n")) for n in kept])).alias("s")).select("s.*")


def observed(cases: DataFrame, steps: dict[str, Column], name: str = "funnel") -> tuple[DataFrame, Observation]:
    """The cases that all steps leave, and an observation of the counters: they come with whatever action runs on the cases first."""
    seen, left = Observation(name), F.lit(True)
    counts = []
    for step, condition in steps.items():
        left = left & F.coalesce(condition, F.lit(False))
        counts.append(F.count_if(left).alias(step))
    return cases.observe(seen, *counts).where(left), seen


def have(listing: DataFrame, sets: dict[str, list[str]], key: str = "case_id") -> DataFrame:
    """Per key of a listing (key, item) a flag for each set of items: whether all of it is there; one pass over the listing."""
    every = sorted({i for items in sets.values() for i in items})
    flags = [(F.count_distinct(F.when(F.col("item").isin(items), F.col("item"))) == len(set(items))).alias(name) for name, items in sets.items()]
    return listing.where(F.col("item").isin(every)).groupBy(key).agg(*flags)


def path_of(template: str, case: Column, **values: Column | str) -> Column:
    """The template with the case in place of ``{case}``, and values in place of other names, such as ``{method}``, ``{filter}`` or ``{timestamp}``."""
    known = {"case": case} | {k: v if isinstance(v, Column) else F.lit(v) for k, v in values.items()}
    parts = re.split(r"\{(\w+)\}", template)
    if unknown := set(parts[1::2]) - set(known):
        raise ValueError(f"no value for {sorted(unknown)}")
    return F.concat(*[known[x] if i % 2 else F.lit(x) for i, x in enumerate(parts)])


def date_errors(rows: DataFrame, text: str, case: str = "case_id") -> DataFrame:
    """case and error of the rows whose date is given and is none."""
    return rows.where(F.col(text).isNotNull() & scan_date(F.col(text)).isNull()).select(case, F.concat(F.lit("no date: "), text).alias("error"))
