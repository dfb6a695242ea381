"""Every registered query against its DuckDB SQL on the driver tables, and
plan checks: no Python UDF anywhere, scans prune columns."""

import pytest

import __spark_entry__ as entry
from martwise.plans.registry import QUERIES
from tests.conftest import SF001
from tests.oracle_compare import compare

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def results(spark):
    return compare(spark, SF001, NAMES, verbose=False)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(results, name):
    r = results[name]
    assert "error" not in r, r.get("error")
    assert r["rows"][0] > 0
    if name in entry.oracle_sql():
        assert r["hash_match"], r


def test_every_query_has_oracle_sql():
    assert set(NAMES) <= set(entry.oracle_sql()) and set(NAMES) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "report_date" and df.count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_plan_has_no_python_and_prunes(spark, name):
    plan = entry.queries()[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan and "PythonUDF" not in plan
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan  # no cross joins
    assert "ReadSchema" in plan or "FileScan" in plan
