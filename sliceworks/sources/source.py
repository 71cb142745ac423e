"""A data source for volumes: ``spark.read.format("volumes")``.

A partition is a slab of a file, or several small files.  An unpacked file is read
from where its slab begins; a packed one has one partition, as its stream has no
way in but its start, and ends where the last slice that is asked for ends.
Conditions on ``volume``, ``case_id`` and ``z`` reach the reader: other files are
not opened, other slices not decoded.

Files are opened by the executors, so the folder must be mounted on all of them;
``files.volumes`` reads from any other store.
"""

from __future__ import annotations

import glob
import json
import os
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from . import files

#: Stored bytes of a partition, about.
PART_BYTES = 64 << 20


@dataclass
class Slabs(InputPartition):
    """(path, case, volume, part, parts) of what a task reads."""

    items: list[tuple[str, str, str, int, int]]


class VolumeReader(DataSourceReader):
    def __init__(self, places: dict[str, str], part_bytes: int):
        self.places, self.part_bytes = places, part_bytes
        self.cases: set[str] | None = None
        self.low, self.high = 0, None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            name = f.attribute if hasattr(f, "attribute") else ()
            values = {f.value} if isinstance(f, EqualTo) else set(f.value) if isinstance(f, In) else None
            if name == ("volume",) and values is not None:
                self.places = {n: p for n, p in self.places.items() if n in values}
            elif name == ("case_id",) and values is not None:
                self.cases = values if self.cases is None else self.cases & values
            elif name == ("z",) and isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)):
                if not isinstance(f, (LessThan, LessThanOrEqual)):
                    self.low = max(self.low, f.value + isinstance(f, GreaterThan))
                if not isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                    end = f.value + (not isinstance(f, LessThan))
                    self.high = end if self.high is None else min(self.high, end)
                yield f  # a file without slices has a row with its error and no z
            else:
                yield f

    def partitions(self) -> list[Slabs]:
        """Only names and sizes are read here."""
        parts, small, held = [], [], 0
        for volume, place in self.places.items():
            for path in sorted(glob.glob(f"{place}/*" if os.path.isdir(place) else place)):
                case = os.path.basename(path).split(".", 1)[0]
                if os.path.basename(path).startswith(".") or self.cases is not None and case not in self.cases:
                    continue
                size = os.path.getsize(path)
                n = 1 if path.endswith(".gz") else max(1, -(-size // self.part_bytes))
                if n > 1 or size > self.part_bytes:
                    parts += [Slabs([(path, case, volume, i, n)]) for i in range(n)]
                    continue
                if small and held + size > self.part_bytes:
                    parts.append(Slabs(small))
                    small, held = [], 0
                small, held = [*small, (path, case, volume, 0, 1)], held + size
        return parts + [Slabs(small)] * bool(small)

    def read(self, partition: Slabs | None) -> Iterator[pa.RecordBatch]:
        for path, case, volume, i, n in partition.items if partition else ():  # without a file Spark asks for nothing
            yield from files.slice_batches(case, volume, lambda path=path: open(path, "rb"), part=(i, n), low=self.low, high=self.high)


class VolumeSource(DataSource):
    """Options: ``path`` (a folder or pattern) and ``volume`` (its name), or ``volumes``: a JSON object of names and paths; ``partbytes``."""

    @classmethod
    def name(cls) -> str:
        return "volumes"

    def schema(self) -> str:
        return files.SLICES

    def reader(self, schema) -> VolumeReader:
        named = json.loads(self.options.get("volumes", "{}"))
        if path := self.options.get("path"):
            named[self.options.get("volume", "image")] = path
        if not named:
            raise ValueError("neither path nor volumes is given")
        places = {}
        for name, place in named.items():
            if "://" in place and not place.startswith("file://"):
                raise ValueError(f"not a mounted folder: {place}")
            places[name] = place.removeprefix("file://").rstrip("/")
        return VolumeReader(places, int(self.options.get("partbytes", PART_BYTES)))


def register(spark: SparkSession) -> None:
    """Makes the format known to the session and lets conditions reach it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(VolumeSource)
