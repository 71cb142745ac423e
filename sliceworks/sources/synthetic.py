"""A voxel relation made from the event table: 5 x 10 x 20 voxels a case."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

COLUMNS = {
    "case_no": "CAST(floor(event_id / 1000.0) AS INT)",
    "x": "CAST(event_id % 5 AS INT)",
    "y": "CAST(floor((event_id % 50) / 5.0) AS INT)",
    "z": "CAST(floor((event_id % 1000) / 50.0) AS INT)",
    "hu": "CAST(floor(value * 4) AS INT) - 200",
    "tissue": "CASE event_type WHEN 'signup' THEN 1 WHEN 'purchase' THEN 2 WHEN 'error' THEN 3 WHEN 'click' THEN CASE WHEN user_id % 2 = 0 THEN 4 ELSE 3 END ELSE 0 END",
    "vb": "CASE WHEN event_id % 4 <> 0 THEN 1 ELSE 0 END",
    "trunk": "CASE WHEN event_id % 5 <> 0 THEN 1 ELSE 0 END",
    "iliopsoas": "CASE WHEN event_id % 13 = 0 THEN 88 WHEN event_id % 13 = 1 THEN 89 ELSE 0 END",
}
VERT = """CASE WHEN user_id % 3 = 0 THEN 0 WHEN (z * 7 + case_no) % 9 = 0 THEN 0 WHEN event_id % 11 = 0 THEN 19
 ELSE CAST(17 - floor((event_id % 1000) / 200.0) AS INT) + CASE WHEN (z * 5 + case_no) % 8 = 3 THEN 1 ELSE 0 END END"""
#: The same relation as SQL, for the oracle.
SQL = f"voxels AS (SELECT *, {VERT} AS vert FROM (SELECT event_id, user_id, {', '.join(f'{e} AS {c}' for c, e in COLUMNS.items())} FROM events))"

SPACING = (1.5, 1.5, 5.0)
SHAPE = (5, 10, 20)
MIN_VOXELS = 12


def voxels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """case_no, x, y, z, hu, tissue, vert, vb, trunk, iliopsoas, event_id; only four columns are read."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    rows = events.selectExpr("event_id", "user_id", *[f"{e} AS {c}" for c, e in COLUMNS.items()])
    return rows.selectExpr("*", f"{VERT} AS vert").drop("user_id")
