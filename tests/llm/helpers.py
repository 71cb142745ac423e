"""Comparison of a query with its SQL, and small tables."""

import duckdb
import pandas as pd

TABLES = "documents embeddings pages benchmark labels conversations".split()
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def by_sql(sql: str, sf_dir: str) -> pd.DataFrame:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con.sql(sql).df()


def same(a: pd.DataFrame, b: pd.DataFrame, by: list[str]) -> None:
    assert sorted(a.columns) == sorted(b.columns)
    a, b = (x[sorted(x.columns)].sort_values(by).reset_index(drop=True) for x in (a, b))
    pd.testing.assert_frame_equal(a, b, check_dtype=False)


def docs(spark, rows):
    """A documents table of (doc_id, text) or (doc_id, text, lang) rows."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src0", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, DOCS)
