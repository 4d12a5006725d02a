"""Queries against their SQL counterparts, over whole driver tables and over the corpus with all odd cases."""

import collections
import os

import duckdb
import pytest

from subledger.llm.queries import ORACLES, QUERIES

DRIVER_TABLES = "/root/testdata/sf0.001"
KINDS = {"bigint": "BIGINT", "string": "VARCHAR", "int": "INTEGER", "boolean": "BOOLEAN"}


def compare(spark, name, folder):
    con = duckdb.connect()
    for file in os.listdir(folder):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{folder}/{file}'")
    rows = QUERIES[name](spark, folder)
    result = con.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert {d[0]: str(d[1]) for d in result.description} == {c: KINDS[k] for c, k in rows.dtypes}
    assert collections.Counter(map(tuple, rows.select(*columns).collect())) == collections.Counter(result.fetchall())


@pytest.mark.skipif(not os.path.isdir(DRIVER_TABLES), reason="driver tables absent")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_driver_tables(spark, name):
    compare(spark, name, DRIVER_TABLES)


# Not op12: vectors of different lengths have no product in SQL.
@pytest.mark.parametrize("name", sorted(set(ORACLES) - {"op12_multi_index_negatives"}))
def test_odd_cases(spark, folder, name):
    compare(spark, name, folder)
