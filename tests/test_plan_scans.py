"""How often the checks read a table: each raw table once, the rest from what
the cascade wrote."""

import re

import pytest

from tierflow.plans.driver import QUERIES
from tierflow.plans.driver_io import IO_QUERIES

SF = "/root/testdata/sf0.001"


def scans(df, table):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(rf"FileScan parquet [^\n]*/{table}\.parquet", plan)), plan


@pytest.mark.parametrize("name,most", [("recon_report", 1), ("recon_verdict", 1)])
def test_reconciliation_reads_raw_tables_once(spark, name, most):
    for table in ("lineitem", "orders", "customer"):
        n, plan = scans(IO_QUERIES[name](spark, SF), table)
        assert n <= most
    assert "Window" not in plan  # the dedupe ran when the tagged table was written


def test_cascade_reads_the_child_once(spark):
    assert scans(QUERIES["fk_cascade"](spark, SF), "lineitem")[0] == 1
    assert scans(QUERIES["fk_cascade"](spark, SF), "orders")[0] <= 2
