"""Helpers shared by the operators: tables, the shared folder, written tables."""

from __future__ import annotations

import contextlib
import ctypes
import threading
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..stages import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class _Made(threading.local):
    """Paths written since each open ``scratch`` of this thread began, the innermost last."""

    def __init__(self):
        self.open: list[list[str]] = []


_made = _Made()


def removed(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that ``written`` makes within, in this thread, go at the end, but for those that stay; what else was computed from them must be written by then."""
    _made.open.append([])
    try:
        yield
    finally:
        for path in _made.open.pop():
            removed(spark, path)


def written(df: DataFrame, what: str, stays: bool = False, paths: list[str] | None = None) -> DataFrame:
    """``df`` as a table written in the shared folder and read again.

    This cuts the lineage: a lost executor costs no recomputation, and both
    readers of a table see the same rows.  The files go at the end of the
    innermost ``scratch`` (of the one around it if the table ``stays``) or with
    the session, as results are lazy and read them.  ``paths`` gets the table's.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    if len(_made.open) > stays:
        _made.open[-1 - stays].append(path)
    if paths is not None:
        paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free(name: str, df: DataFrame) -> str:
    """``name``, made longer until no column of ``df`` has it, in whatever case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def quoted(column: str) -> Column:
    """The column of this name, whatever characters it has."""
    return F.col("`" + column.replace("`", "``") + "`")


def slots(spark: SparkSession) -> int:
    """Shuffle partitions of the session."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fold(doc_id, n: int):
    """crc32 of doc_id as text, modulo n."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % n


def bounded_sample(rows: DataFrame, by: str, bound: int, strata: str | None = None, most: int = 1 << 16) -> DataFrame:
    """About ``bound`` rows (of each of the ``most`` frequent values of ``strata``), chosen by a hash of ``by``.

    All rows are counted; a row is in if its hash lies under bound / count.  The
    choice depends on the rows alone, not on partitions or order.
    """
    share = (F.pmod(F.xxhash64(F.lit(17), F.col(by)), F.lit(1 << 30)) / float(1 << 30))
    if strata is None:
        n = max(rows.count(), 1)
        return rows if n <= bound else rows.where(share < bound / n)
    found = rows.where(F.col(strata).isNotNull()).groupBy(strata).count().orderBy(F.desc("count"), strata).limit(most)
    counts = {r[0]: r[1] for r in found.collect()}
    keep = F.lit(False)
    for value, n in counts.items():
        keep = keep | ((F.col(strata) == F.lit(value)) & (share < bound / n))
    return rows.where(keep)


#: Bytes of an Arrow batch, about: very long texts then come a few at a time.
BATCH_BYTES = 1 << 20


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, whose texts are to go to Python in batches bounded by bytes; another bound of the session stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    conf = df.sparkSession.conf
    if conf.get(name).rstrip("b") == str(64 << 20):  # as Spark sets it out
        conf.set(name, str(BATCH_BYTES))
    return df


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` for ``mapInArrow`` or ``mapInPandas``, whose worker gives back at a task's end what the task has freed.

    Spark keeps workers for later tasks; without this each holds on to its largest task so far.
    """

    def tidied(batches: Iterator) -> Iterator:
        yield from run(batches)
        given_back()

    return tidied


def given_back() -> None:
    """What this worker has freed goes back to the machine."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim:
        trim(0)
