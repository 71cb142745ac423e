"""Results that become visible as a whole: tables of runs, and a mark for each run that ended.

Every run writes its rows below a folder of its own; what it did with which case is
one more table.  At the end one small file marks the run as done, and only then do
readers see any of it.  Of a case that several runs did, the last counts.  Cases
are known by workspace and id, as equal ids may mean different scans elsewhere.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEY = ("workspace", "case_no")
DONE, FAILED = "done", "error"


class Results:
    def __init__(self, spark: SparkSession, path: str, key_type: str = "string"):
        self.spark, self.path, self.key_type = spark, path.rstrip("/"), key_type

    def _fs(self, path: str):
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return place, place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def runs(self) -> list[str]:
        """The runs that ended, by their names, in order."""
        place, fs = self._fs(f"{self.path}/ended")
        return sorted(s.getPath().getName() for s in fs.listStatus(place)) if fs.exists(place) else []

    def _table(self, name: str, runs: list[str]) -> DataFrame | None:
        places = [p for p in (f"{self.path}/{name}/run={r}" for r in runs) if self._fs(p)[1].exists(self._fs(p)[0])]
        return self.spark.read.option("basePath", f"{self.path}/{name}").option("mergeSchema", True).parquet(*places) if places else None

    def cases(self) -> DataFrame:
        """workspace, case_no, run, status of each case's last run."""
        every = self._table("cases", self.runs())
        if every is None:
            return self.spark.createDataFrame([], f"workspace string, case_no {self.key_type}, run string, status string")
        last = every.groupBy(*KEY).agg(F.max(F.struct("run", "status")).alias("last"))
        return last.select(*KEY, "last.run", "last.status")

    def remaining(self, cases: DataFrame, workspace: str) -> DataFrame:
        """Of ``cases`` (case_no, ...) those that no run of the workspace has done; failed ones are tried again."""
        done = self.cases().where((F.col("workspace") == workspace) & (F.col("status") == DONE))
        return cases.join(done.select("case_no"), "case_no", "left_anti")

    def read(self, name: str) -> DataFrame | None:
        """The rows of a table, each case's from its last run alone; None if no run has it."""
        rows = self._table(name, self.runs())
        return None if rows is None else rows.join(self.cases().select(*KEY, "run"), [*KEY, "run"], "left_semi").drop("run")

    def commit(self, frames: dict[str, DataFrame], cases: DataFrame, workspace: str, errors: DataFrame | None = None) -> str:
        """Writes the frames (each with case_no), what became of ``cases`` (case_no), and then the mark of the run; returns its name.

        ``errors`` (case_no, error) is a table like the others, and makes its cases failed ones.
        """
        run = f"r{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        named = frames if errors is None else frames | {"errors": errors}
        for name, frame in named.items():
            frame.withColumn("workspace", F.lit(workspace)).write.parquet(f"{self.path}/{name}/run={run}")
        known = cases.select("case_no").distinct()
        status = F.lit(DONE).alias("status")
        if errors is not None:
            failed = self.spark.read.parquet(f"{self.path}/errors/run={run}").select("case_no").distinct().withColumn("failed", F.lit(True))
            known, status = known.join(failed, "case_no", "full"), F.when(F.col("failed"), FAILED).otherwise(DONE).alias("status")
        known.select(F.lit(workspace).alias("workspace"), "case_no", status).write.parquet(f"{self.path}/cases/run={run}")
        place, fs = self._fs(f"{self.path}/ended/{run}")
        fs.create(place, False).close()  # from here on the run counts
        return run
