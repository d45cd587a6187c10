"""Every SQL-checked query against DuckDB on the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as entry_module
from check import TABLES, canonical

SF_DIR = "/root/testdata/sf0.001"
ORACLES = entry_module.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    df = entry_module.queries()[name](spark, SF_DIR)
    cur = con.execute(ORACLES[name])
    columns = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(columns)
    assert canonical([tuple(r) for r in df.collect()], df.columns) == canonical(cur.fetchall(), columns)


def test_entry_has_rows(spark):
    assert entry_module.entry(spark).count() > 0
