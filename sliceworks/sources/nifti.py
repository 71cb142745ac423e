"""NIfTI-1 as a stream: the header, then slices of the turned volume, one after the other.

A volume is stored plane by plane.  Where the planes are the slices that are asked
for (most scans), one plane is held at a time; else the planes are dealt to a slab
of slices, in 16 bits, and a volume larger than a slab is read once for each slab.
"""

from __future__ import annotations

import gzip
import io
import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import BinaryIO

import numpy as np

from ..operators.grid import canonical

# Data types of the format.
TYPES = {2: "u1", 4: "i2", 8: "i4", 16: "f4", 64: "f8", 256: "i1", 512: "u2"}
CODES = {v: k for k, v in TYPES.items()}
#: Bytes of a slab of slices, in 16 bits.
SLAB_BYTES = 64 << 20


def rotation(b: float, c: float, d: float) -> np.ndarray:
    """The rotation of a unit quaternion whose first part follows from the others."""
    a = max(0.0, 1.0 - (b * b + c * c + d * d)) ** 0.5
    return np.array([
        [a * a + b * b - c * c - d * d, 2 * (b * c - a * d), 2 * (b * d + a * c)],
        [2 * (b * c + a * d), a * a + c * c - b * b - d * d, 2 * (c * d - a * b)],
        [2 * (b * d - a * c), 2 * (c * d + a * b), a * a + d * d - b * b - c * c],
    ])


@dataclass(frozen=True)
class Header:
    dtype: str
    shape: tuple[int, int, int]
    offset: int
    slope: float
    inter: float
    affine: np.ndarray
    spacing: tuple[float, float, float]

    @property
    def scaled(self) -> bool:
        """A slope of 0 or one that is no number means unscaled values."""
        return bool(np.isfinite(self.slope) and self.slope != 0.0 and (self.slope != 1.0 or self.inter != 0.0))

    def turned(self) -> tuple[tuple[int, int, int], tuple[bool, bool, bool]]:
        return canonical(self.affine.ravel().tolist())

    def grid(self) -> tuple[tuple[int, int, int], np.ndarray, tuple[float, ...]]:
        """Shape, affine and spacing once the axes run to the right, anterior, superior."""
        axes, flips = self.turned()
        affine, origin = np.eye(4), self.affine[:3, 3].copy()
        for i, (a, flip) in enumerate(zip(axes, flips)):
            affine[:3, i] = -self.affine[:3, a] if flip else self.affine[:3, a]
            if flip:
                origin = origin + self.affine[:3, a] * (self.shape[a] - 1)
        affine[:3, 3] = origin
        return tuple(self.shape[a] for a in axes), affine, tuple(self.spacing[a] for a in axes)


def parsed(raw: bytes) -> Header:
    """The header of a file, of either byte order: the affine is the sform, else the qform, else the spacing alone.  More than one volume is an error."""
    if len(raw) < 348:
        raise ValueError("no NIfTI-1 header")
    order = "<" if struct.unpack("<i", raw[:4])[0] == 348 else ">"
    if struct.unpack(order + "i", raw[:4])[0] != 348:
        raise ValueError("no NIfTI-1 header")
    dims = struct.unpack(order + "8h", raw[40:56])
    if dims[0] < 3 or any(n > 1 for n in dims[4 : dims[0] + 1]) or min(dims[1:4]) < 1:
        raise ValueError(f"not one volume of three dimensions: {dims[1 : dims[0] + 1]}")
    code = struct.unpack(order + "h", raw[70:72])[0]
    if code not in TYPES:
        raise ValueError(f"data type {code} is not read")
    zooms = struct.unpack(order + "8f", raw[76:108])
    offset = int(struct.unpack(order + "f", raw[108:112])[0])
    slope, inter = struct.unpack(order + "2f", raw[112:120])
    affine = np.eye(4)
    qform, sform = struct.unpack(order + "2h", raw[252:256])
    if sform > 0:
        affine[:3] = np.array(struct.unpack(order + "12f", raw[280:328])).reshape(3, 4)
    elif qform > 0:
        b, c, d, *shift = struct.unpack(order + "6f", raw[256:280])
        side = -1.0 if zooms[0] < 0 else 1.0
        affine[:3, :3] = rotation(b, c, d) * np.array([zooms[1], zooms[2], side * zooms[3]])
        affine[:3, 3] = shift
    else:
        affine[[0, 1, 2], [0, 1, 2]] = zooms[1:4]
    return Header(order + TYPES[code], dims[1:4], offset, slope, inter if np.isfinite(inter) else 0.0, affine, zooms[1:4])


def unpacked(stream: BinaryIO) -> BinaryIO:
    """The stream of the volume itself, packed by gzip or not."""
    magic = stream.read(2)
    stream.seek(0)
    return gzip.GzipFile(fileobj=stream) if magic == b"\x1f\x8b" else stream


def _skip(stream: BinaryIO, n: int) -> None:
    if not isinstance(stream, gzip.GzipFile):
        stream.seek(n, io.SEEK_CUR)
        return
    while n > 0:  # in small pieces, so that what is passed over is not held
        got = len(stream.read(min(n, 1 << 20)))
        if not got:
            raise ValueError("the file ends before its volume does")
        n -= got


def whole(values: np.ndarray, h: Header) -> np.ndarray:
    """Stored values as whole numbers of 16 bits; scaled ones are cut to whole numbers."""
    if h.scaled:
        values = np.trunc(values * h.slope + h.inter)
    if values.dtype.kind == "f" and not np.isfinite(values).all():
        raise ValueError("values that are no numbers")
    if values.size and (values.min() < -32768 or values.max() > 32767):
        raise ValueError("values beyond 16 bits")
    return values.astype("<i2")


def begun(stream: BinaryIO) -> Header:
    """The header; the stream then stands where the volume begins."""
    h = parsed(stream.read(348))
    _skip(stream, h.offset - 348)
    return h


def _planes(stream: BinaryIO, h: Header, wanted: range) -> Iterator[tuple[int, np.ndarray]]:
    """The stored planes ``wanted`` (rising), as 16-bit (i, j)."""
    size = int(np.prod(h.shape[:2])) * np.dtype(h.dtype).itemsize
    at = 0
    for k in wanted:
        _skip(stream, (k - at) * size)
        raw = stream.read(size)
        if len(raw) < size:
            raise ValueError("the file ends before its volume does")
        at = k + 1
        yield k, whole(np.frombuffer(raw, h.dtype).reshape(h.shape[:2], order="F"), h)


def slices_of(opened: Callable[[], BinaryIO], part: tuple[int, int] = (0, 1), low: int = 0, high: int | None = None, slab_bytes: int = SLAB_BYTES) -> Iterator[tuple[Header, int, np.ndarray]]:
    """(header, z, slice (x, y)) of the slices low <= z < high that fall to part i of n, axes to the right, anterior, superior.

    ``opened`` gives the file from its start; it is called once, or once a slab
    where the stored planes are not slices.
    """
    stream = unpacked(opened())
    h = begun(stream)
    axes, flips = h.turned()
    depth = h.shape[axes[2]]
    i, n = part
    low, high = max(low, depth * i // n), min(depth if high is None else high, depth * (i + 1) // n)
    if low >= high:
        return

    def flat(plane: np.ndarray, swap: bool, fx: bool, fy: bool) -> np.ndarray:
        plane = plane.T if swap else plane
        return plane[:: -1 if fx else 1, :: -1 if fy else 1]

    if axes[2] == 2:
        wanted = range(depth - high, depth - low) if flips[2] else range(low, high)
        for k, plane in _planes(stream, h, wanted):
            yield h, depth - 1 - k if flips[2] else k, flat(plane, axes[0] == 1, flips[0], flips[1])
        return
    # stored planes lie across the slices: each gives a line to every slice of the slab
    across, (nx, ny, _) = axes.index(2), h.grid()[0]
    step = max(1, slab_bytes // (2 * nx * ny))
    for first in range(low, high, step):
        last = min(high, first + step)
        if first > low:
            stream = unpacked(opened())
            begun(stream)
        slab = np.empty((last - first, nx, ny), "<i2")
        for k, plane in _planes(stream, h, range(h.shape[2])):
            lines = np.moveaxis(plane, axes[2], 0)  # (slice, the other axis)
            lines = lines[::-1] if flips[2] else lines
            other = lines[first:last, :: -1 if flips[1 - across] else 1]
            place = h.shape[2] - 1 - k if flips[across] else k
            if across == 0:
                slab[:, place, :] = other
            else:
                slab[:, :, place] = other
        for z in range(first, last):
            yield h, z, slab[z - first]


def volume(content: bytes) -> tuple[np.ndarray, np.ndarray, tuple[float, ...]]:
    """The whole volume of a file as stored (x, y, z), its affine and spacing."""
    stream = unpacked(io.BytesIO(content))
    h = begun(stream)
    data = np.stack([p for _, p in _planes(stream, h, range(h.shape[2]))], axis=2)
    return data, h.affine, h.spacing


def encoded(data: np.ndarray, affine: np.ndarray, spacing: tuple[float, ...]) -> bytes:
    """A packed single-file volume."""
    head = bytearray(352)
    struct.pack_into("<i", head, 0, 348)
    struct.pack_into("<8h", head, 40, 3, *data.shape, 1, 1, 1, 1)
    struct.pack_into("<2h", head, 70, CODES[data.dtype.str[1:]], data.dtype.itemsize * 8)
    struct.pack_into("<8f", head, 76, 1.0, *spacing, 0, 0, 0, 0)
    struct.pack_into("<3f", head, 108, 352.0, 1.0, 0.0)
    struct.pack_into("<2h", head, 252, 0, 1)
    struct.pack_into("<12f", head, 280, *np.asarray(affine)[:3].ravel())
    head[344:348] = b"n+1\x00"
    return gzip.compress(bytes(head) + data.tobytes(order="F"), mtime=0)
