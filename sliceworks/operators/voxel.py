"""Voxel-wise operators: remapping, intensity ranges, overlays, masks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.labels import IMAT, PSOAS, PSOAS_SOURCE, SACRUM, SAT, SM, VAT, TissueParams


def remapped(label: Column, mapping: dict[int, int]) -> Column:
    """The new label; 0 where the mapping has none."""
    pairs = [F.lit(x) for kv in sorted(mapping.items()) for x in kv]
    return F.coalesce(F.element_at(F.create_map(*pairs), label.cast("int")), F.lit(0)) if pairs else F.lit(0)


def in_range(hu: Column, bounds: tuple[int, int]) -> Column:
    return hu.between(*bounds)


def clipped(hu: Column, bounds: tuple[int, int]) -> Column:
    return F.greatest(F.lit(bounds[0]), F.least(F.lit(bounds[1]), hu))


def with_psoas(tissue: Column, source: Column) -> Column:
    return F.when(source.isin(*PSOAS_SOURCE), F.lit(PSOAS)).otherwise(tissue)


def masked_tissue(tissue: Column, hu: Column, p: TissueParams | None = None) -> Column:
    """Muscle in the fat range becomes IMAT; what is then outside its own range goes."""
    p = p or TissueParams()
    muscle = tissue.isin(SM, PSOAS)
    return (
        F.when(muscle & in_range(hu, p.imat), IMAT)
        .when(muscle & ~in_range(hu, p.sm), 0)
        .when((tissue == VAT) & ~in_range(hu, p.vat), 0)
        .when((tissue == SAT) & ~in_range(hu, p.sat), 0)
        .otherwise(tissue)
    )


def within_bodies(vert: Column, vb: Column, readd_sacrum: bool = True) -> Column:
    """0 outside the vertebral bodies, but for the sacrum."""
    keep = vb == 1
    return F.when(keep | (vert == SACRUM) if readd_sacrum else keep, vert).otherwise(0)
