"""Every registered query against its SQL on the smallest tables, types included."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from touchline.plans.workload import QUERIES

FOLDER = Path("/root/testdata/sf0.001")
TYPES = {"boolean": "BOOLEAN", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE"}
ORACLE = entry.oracle_sql()

pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in FOLDER.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) <= set(ORACLE)
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLE) <= set(entry.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, database, name):
    result = QUERIES[name](spark, str(FOLDER))
    columns = sorted(result.columns)
    got = sorted(repr(tuple(row)) for row in result.select(*columns).collect())
    listed = ", ".join(f'"{column}"' for column in columns)
    cursor = database.execute(f"SELECT {listed} FROM ({ORACLE[name]})")
    types = [str(column[1]) for column in cursor.description]
    want = sorted(repr(tuple(row)) for row in cursor.fetchall())
    assert got == want
    assert [TYPES[dict(result.dtypes)[column]] for column in columns] == types


def test_entry(spark):
    result = entry.entry(spark)
    assert result.columns == ["player_id", "name", "highest_value"]
    assert result.count() > 0
