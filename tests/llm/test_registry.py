"""Every registered query against its SQL, and the guard around the subpackage."""

import math
import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as contract
from topup_analytics.llm import registry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "documents embeddings conversations labels benchmark".split()
TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def _ordered(rows):
    return sorted(rows, key=lambda row: [(v is None, "" if isinstance(v, float) else str(v)) for v in row])


def _same(a, b):
    return a == b or (isinstance(a, float) and math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9))


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_matches_sql(spark, duck, name):
    ours = contract.queries()[name](spark, SF_DIR)
    theirs = duck.sql(contract.oracle_sql()[name])
    columns = sorted(ours.columns)
    assert dict(ours.dtypes) == {c: TYPES[str(t)] for c, t in zip(theirs.columns, theirs.types)}
    got = _ordered(tuple(r) for r in ours.select(columns).collect())
    want = _ordered(theirs.project(", ".join(f'"{c}"' for c in columns)).fetchall())
    assert len(got) == len(want) > 0
    for mine, other in zip(got, want):
        assert all(map(_same, mine, other)), (mine, other)


def test_one_query_for_each_operator():
    names = [n for n in contract.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in contract.queries()


def test_the_rest_works_without_the_subpackage(tmp_path):
    root = os.path.dirname(os.path.abspath(contract.__file__))
    for name in os.listdir(root):
        if name not in ("topup_analytics", "corpus_pipeline.py"):
            os.symlink(f"{root}/{name}", tmp_path / name)
    os.mkdir(tmp_path / "topup_analytics")
    for name in os.listdir(f"{root}/topup_analytics"):
        if name != "llm":
            os.symlink(f"{root}/topup_analytics/{name}", tmp_path / "topup_analytics" / name)
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), 'pipeline' in q, e.oracle_sql().keys() == q.keys())"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env=env)
    assert done.stdout.split()[1:] == ["False", "True"], done.stderr
