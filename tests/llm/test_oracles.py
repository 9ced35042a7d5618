"""Every corpus query that SQL can express against its SQL in a second engine, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from clicklake.llm.catalogue import ORACLES, QUERIES

FOLDER = Path(entry_points.SMALLEST)
TYPES = {"bigint": "BIGINT", "string": "VARCHAR", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for file in FOLDER.glob("*.parquet"):
        connection.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_oracle(spark, engine, name):
    result = QUERIES[name](spark, str(FOLDER))
    oracle = engine.sql(ORACLES[name])
    columns = sorted(result.columns)
    assert columns == sorted(oracle.columns)
    assert {c: TYPES[t] for c, t in result.dtypes} == dict(zip(oracle.columns, map(str, oracle.types)))
    expected = oracle.select(*[duckdb.ColumnExpression(c) for c in columns]).fetchall()
    assert sorted(map(tuple, result.select(*columns).collect()), key=str) == sorted(expected, key=str)
    assert expected


def test_all_queries_are_registered():
    registered = entry_points.queries()
    assert set(QUERIES) | {"pipeline"} <= set(registered)
    assert {name.partition("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(ORACLES) <= set(entry_points.oracle_sql())
