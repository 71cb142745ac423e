"""Label dictionaries and parameters."""

from __future__ import annotations

from dataclasses import dataclass, field

# Label numbers and names.
VERTEBRAE = {1: "T1", 2: "T2", 3: "T3", 4: "T4", 5: "T5", 6: "T6", 7: "T7", 8: "T8", 9: "T9", 10: "T10", 11: "T11", 12: "T12", 13: "L1", 14: "L2", 15: "L3", 16: "L4", 17: "L5", 18: "L6", 19: "SACRUM", 20: "COCCYX", 21: "T13"}
TISSUES = {1: "SAT", 2: "VAT", 3: "SM", 4: "PSOAS", 5: "IMAT"}
SAT, VAT, SM, PSOAS, IMAT = 1, 2, 3, 4, 5
SACRUM = 19
#: Numbers of the two spine models, by vertebra.
SPINE_A = {43: 1, 42: 2, 41: 3, 40: 4, 39: 5, 38: 6, 37: 7, 36: 8, 35: 9, 34: 10, 33: 11, 32: 12, 31: 13, 30: 14, 29: 15, 28: 16, 27: 17, 26: 19, 25: 19}
SPINE_B = {8 + i: 1 + i for i in range(17)}
PSOAS_SOURCE = (88, 89)


@dataclass(frozen=True)
class TissueParams:
    """Ranges of intensity, both ends inclusive."""

    imat: tuple[int, int] = (-190, -30)
    sm: tuple[int, int] = (-29, 150)
    vat: tuple[int, int] = (-190, -30)
    sat: tuple[int, int] = (-190, -30)
    #: Intensities are clipped to this range before, if given, and filtered by the median of this kernel.
    clip: tuple[int, int] | None = None
    median: tuple[int, int] | None = None
    #: By range name: mm2 under which a 2-D component of what the range marks is passed over.
    least_mm2: dict[str, float] = field(default_factory=dict)
    #: The same in 3-D, in mm3.
    least_mm3: dict[str, float] = field(default_factory=dict)


@dataclass(frozen=True)
class LevelParams:
    min_voxels: int = 20
    fill: bool = True
    monotonic: bool = True
    window: int = 10
    deprioritise: tuple[int, ...] = (SACRUM,)


@dataclass(frozen=True)
class BoxParams:
    """Labels that span the box; per side (x low, x high, y low, ...) whether it limits, and its margin in mm."""

    roi: tuple[int, ...] = (15,)
    sides: tuple[bool, ...] = (False, False, False, False, True, True)
    margin_mm: tuple[float, ...] = (0.0,) * 6


# Boxes by name.
BOXES = {
    "SpineCranioCaudal": BoxParams(tuple(range(1, 22)), margin_mm=(0.0, 0.0, 0.0, 0.0, -20.0, -20.0)),
    "L3CranioCaudal": BoxParams((15,)),
    "L234CranioCaudal": BoxParams((14, 15, 16)),
}


@dataclass(frozen=True)
class Method:
    """What a pipeline does: where vertebrae come from, and which steps run."""

    spine: dict | None = None
    vertebral_bodies: bool = False
    readd_sacrum: bool = False
    box: str | None = None
    trunk: bool = False
    psoas: bool = False
    l3_mean: bool = False
    tissue: TissueParams = field(default_factory=TissueParams)
    levels: LevelParams = field(default_factory=LevelParams)


METHODS = {
    "whole_trunk": Method(trunk=True),
    "lumbar_quick": Method(box="L234CranioCaudal", l3_mean=True),
    "muscle_a": Method(spine=SPINE_A, vertebral_bodies=True, readd_sacrum=True, trunk=True, psoas=True),
    "muscle_a_quick": Method(spine=SPINE_A, box="L234CranioCaudal", l3_mean=True),
    "muscle_b": Method(spine=SPINE_B, vertebral_bodies=True, trunk=True),
}
