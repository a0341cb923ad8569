"""Every registered query against its SQL, on the smallest given tables."""

from functools import cache

import duckdb
import pytest

import __spark_entry__ as driver
from tests.conftest import TESTDATA
from workloads import queries
from workloads.oracles import ORACLES
from workloads.queries import QUERIES

TABLES = "lineitem orders part events"
SPARK_TO_SQL = {
    "bigint": "BIGINT",
    "boolean": "BOOLEAN",
    "double": "DOUBLE",
    "int": "INTEGER",
    "string": "VARCHAR",
}


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{TESTDATA}/{name}.parquet'")
    return connection


@pytest.fixture(scope="module", autouse=True)
def shared_runs():
    """Each view is mined once for each threshold and the queries that read the same run share it."""
    names = ("_mined", "_items", "_encoded", "_sweep", "_customer_sweep")
    plain = {name: getattr(queries, name) for name in names}
    for name, run in plain.items():
        setattr(queries, name, cache(run))
    yield
    for name, run in plain.items():
        setattr(queries, name, run)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, sql, name):
    result = QUERIES[name](spark, TESTDATA)
    columns = sorted(result.columns)
    rows = sorted(repr(tuple(r[c] for c in columns)) for r in result.collect())
    cursor = sql.execute(ORACLES[name])
    types = {d[0]: str(d[1]) for d in cursor.description}
    order = [list(types).index(c) for c in columns]
    assert columns == sorted(types)
    assert {f: SPARK_TO_SQL[t] for f, t in result.dtypes} == types
    assert rows == sorted(repr(tuple(r[i] for i in order)) for r in cursor.fetchall())


def test_entry(spark):
    assert driver.entry(spark).count() > 0
