"""Every registered query against its SQL in DuckDB, over the smallest tables."""

import sys
from collections import Counter
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
import __spark_entry__ as contract

SF = Path("/root/testdata/sf0.001")
SQL = contract.oracle_sql()
# The training-data queries have their own tests.
QUERIES = {q.__name__: q for q in contract._QUERIES}
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}
pytestmark = pytest.mark.skipif(not SF.exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in SF.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}'")
    return connection


def test_every_query_has_its_sql():
    assert QUERIES.keys() <= SQL.keys()
    assert SQL.keys() <= contract.queries().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    df = QUERIES[name](spark, str(SF))
    result = duck.execute(SQL[name])
    described = {d[0]: str(d[1]) for d in result.description}
    assert {n: TYPES[t] for n, t in df.dtypes} == described
    order = [list(described).index(c) for c in df.columns]
    expected = Counter(tuple(row[i] for i in order) for row in result.fetchall())
    assert Counter(tuple(r) for r in df.collect()) == expected


def test_entry_has_rows(spark):
    assert not contract.entry(spark).isEmpty()
