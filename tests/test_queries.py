"""Every registered query against its SQL in a second engine, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points

FOLDER = Path(entry_points.SMALLEST)
ORACLES = entry_points.ORACLES
QUERIES = {name: query for name, query in entry_points.queries().items() if name in entry_points.QUERIES}
SPARK_TO_SQL = {
    "bigint": "BIGINT", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP", "date": "DATE", "int": "INTEGER",
    "double": "DOUBLE", "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for file in FOLDER.glob("*.parquet"):
        connection.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_oracle(spark, engine, name):
    result = QUERIES[name](spark, str(FOLDER))
    oracle = engine.sql(ORACLES[name])
    columns = sorted(result.columns)
    assert columns == sorted(oracle.columns)
    types = dict(zip(oracle.columns, map(str, oracle.types)))
    assert {c: SPARK_TO_SQL[t] for c, t in result.dtypes} == types
    expected = oracle.select(*[duckdb.ColumnExpression(c) for c in columns]).fetchall()
    assert ordered(result.select(*columns).collect()) == ordered(expected)
    assert expected or name == "late_slice"


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
