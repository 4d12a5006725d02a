"""Every registered query against its SQL counterpart in DuckDB, over whole tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_module
from workload.catalog import ORACLES, QUERIES
from workload.fixtures import Data

FOLDER = "/root/testdata/sf0.001"
KINDS = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
         "boolean": "BOOLEAN", "int": "INTEGER"}

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables absent")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in os.listdir(FOLDER):
        connection.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{name}'")
    return connection


def cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    return value


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(cell(row[i]) for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, duck, name):
    rows = QUERIES[name](Data(spark, FOLDER))
    got = canonical(rows.columns, [tuple(r) for r in rows.collect()])
    result = duck.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert {d[0]: str(d[1]) for d in result.description} == {c: KINDS[k] for c, k in rows.dtypes}
    assert got == canonical(columns, result.fetchall())


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
    assert set(entry_module.queries()) >= set(QUERIES)
    assert entry_module.oracle_sql().items() >= ORACLES.items()
