"""Tables between the steps of a run, in the folder that driver and executors share.

What several later steps read is written once and read again, so that nothing is
computed twice and a lost executor costs no more than its own step.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; only in local mode, where there is one machine, a folder of our own may take its place."""
    sc = spark.sparkContext
    conf = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if conf:
        return conf
    if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="sliceworks-"))
    return sc.getCheckpointDir()


class Stages:
    """The tables of one run.  They go at the end of a ``with``, by ``close``, or with the session: results are lazy and read them."""

    def __init__(self, spark: SparkSession, what: str = "run"):
        self.spark, self.path = spark, f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"
        self.made = 0
        self._place(self.path).getFileSystem(self._conf()).deleteOnExit(self._place(self.path))

    def _place(self, path: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)

    def _conf(self):
        return self.spark.sparkContext._jsc.hadoopConfiguration()

    def cut(self, df: DataFrame, what: str) -> DataFrame:
        """``df`` as a table, written now."""
        self.made += 1
        path = f"{self.path}/{self.made}-{what}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        self._place(self.path).getFileSystem(self._conf()).delete(self._place(self.path), True)

    def __enter__(self) -> Stages:
        return self

    def __exit__(self, *_) -> None:
        self.close()
