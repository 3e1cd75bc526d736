"""Every registered query against its SQL on the same tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as contract
from topup_analytics.plans import oracle, queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
FAMILIES = {"TINYINT": "int", "INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW events AS SELECT * FROM '{SF_DIR}/events.parquet'")
    return connection


def _sorted(rows):
    return sorted(rows, key=lambda row: tuple((v is None, str(v)) for v in row))


def test_every_query_has_sql():
    assert queries.queries().keys() == oracle.oracle_sql().keys()
    assert queries.queries().items() <= contract.queries().items()


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_matches_sql(spark, duck, name):
    ours = contract.queries()[name](spark, SF_DIR)
    theirs = duck.sql(contract.oracle_sql()[name])
    columns = sorted(ours.columns)
    assert columns == sorted(theirs.columns)
    types = dict(zip(theirs.columns, [FAMILIES[str(t)] for t in theirs.types]))
    assert dict(ours.dtypes) == types
    got = _sorted(tuple(r) for r in ours.select(columns).collect())
    order = ", ".join(f'"{c}"' for c in columns)
    want = _sorted(theirs.project(order).fetchall())
    assert len(got) == len(want) > 0
    for mine, other in zip(got, want):
        for a, b in zip(mine, other):
            assert a == b or (isinstance(a, float) and math.isclose(a, b, abs_tol=1e-9)), (mine, other)


def test_entry(spark):
    assert contract.entry(spark).count() == 30
