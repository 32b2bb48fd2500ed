"""Every registered query beside its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from suite.oracles import ORACLES
from suite.queries import QUERIES
from tools.check_queries import TABLES, comparable

SF_DIR = "/root/testdata/sf0.001"

# DuckDB names of the Spark types that the results use.
TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF_DIR}/{t}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, tables, name):
    df = entry.queries()[name](spark, SF_DIR)
    result = tables.execute(entry.oracle_sql()[name])
    columns = {d[0]: str(d[1]) for d in result.description}
    want = result.fetchall()
    assert {c: TYPES[t] for c, t in df.dtypes} == columns
    at = [list(columns).index(c) for c in df.columns]
    got = comparable([tuple(r) for r in df.collect()])
    assert got == comparable([tuple(r[i] for i in at) for r in want])
    assert got


def test_entry(spark):
    assert entry.entry(spark).count() > 0
