"""Every query with SQL against that SQL, by DuckDB on the same files."""

import duckdb
import pandas as pd
import pytest

from sliceworks.plans.oracle import oracle_sql
from sliceworks.plans.queries import queries

TABLES = "region nation customer supplier part orders lineitem events pages".split()


@pytest.fixture(scope="module")
def con(middle):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{middle}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_equals_sql(spark, middle, con, name):
    got, want = queries()[name](spark, middle).toPandas(), con.sql(oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    by = sorted(got.columns)
    got, want = (x[by].sort_values(by).reset_index(drop=True) for x in (got, want))
    assert len(got)
    pd.testing.assert_frame_equal(got.astype(object).where(got.notna(), None), want.astype(object).where(want.notna(), None), check_dtype=False)


def test_every_query_has_sql():
    assert set(queries()) == set(oracle_sql())
