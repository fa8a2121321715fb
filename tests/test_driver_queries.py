"""Every registered query against its DuckDB oracle on the smallest tables,
plus the design rules on its physical plan: no cartesian or nested-loop joins
(no cross joins) and no Python UDF evaluation (everything stays in JVM
built-ins)."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))
sys.path.insert(0, ROOT)

import __spark_entry__ as entry  # noqa: E402
from oracle_check import canon, duck  # noqa: E402

SF = "/root/testdata/sf0.001"
QUERIES = {k: v for k, v in entry.queries().items() if k in entry.QUERIES}
ORACLES = {k: v for k, v in entry.oracle_sql().items() if k in entry.QUERIES}
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "PythonUDF", "MapInPandas", "FlatMapGroupsInPandas")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "event_date" in df.columns


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [f for f in FORBIDDEN if f in plan]
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLES[name])
    ocols = [d[0] for d in cur.description]
    c1, r1 = canon(df.columns, rows)
    c2, r2 = canon(ocols, cur.fetchall())
    assert c1 == c2
    assert len(r1) == len(r2)
    assert r1 == r2
