"""Every registered query against DuckDB on the given tables."""

import math
import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as registered

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")
SQL = registered.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    yield con
    con.close()


def canonical(columns, table):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return "NULL"
        if isinstance(v, (int, float)) and not isinstance(v, bool):
            return repr(float(v))
        return str(v)

    return sorted(tuple(cell(row[i]) for i in order) for row in table)


@pytest.mark.parametrize("name", list(SQL))
def test_query(spark, duck, name):
    found = registered.queries()[name](spark, SF_DIR)
    expected = duck.sql(SQL[name])
    assert sorted(found.columns) == sorted(expected.columns)
    assert canonical(found.columns, found.collect()) == canonical(expected.columns, expected.fetchall())


def test_entry(spark):
    assert registered.entry(spark).columns == ["level", "contracts", "pct_of_total"]
    assert set(registered.queries()) >= set(SQL)
