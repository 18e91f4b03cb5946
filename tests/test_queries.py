"""Every query with SQL against DuckDB on the smallest tables, and the contract's shape."""

from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import rows as sorted_rows

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for file in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def test_sql_exists_for_queries_only():
    assert set(oracle_sql()) <= set(queries())


def test_entry_runs(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_same_result_as_sql(spark, con, name):
    df = queries()[name](spark, str(DATA))
    got = sorted_rows(df.columns, df.collect())
    result = con.execute(oracle_sql()[name])
    assert got == sorted_rows([d[0] for d in result.description], result.fetchall())
    assert got[1]
