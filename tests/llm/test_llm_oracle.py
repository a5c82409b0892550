"""Queries with SQL against DuckDB on whole tables, and the guard that lets the rest live without this package."""

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[2]
sys.path.insert(0, str(ROOT / "tests"))
from commitlens.llm.queries import ORACLE, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not Path(SF).exists(), reason="test tables are absent")
@pytest.mark.parametrize("key", sorted(ORACLE))
def test_oracle(spark, key):
    import oracle
    ok, message = oracle.compare(QUERIES[key](spark, SF), ORACLE[key], SF)
    assert ok, message


def test_one_query_for_each_operator():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))


def test_native_operators_run_no_python(spark):
    for key in ("op1_secret_scan", "op4_chat", "op6_pii", "op9_quality", "op13_sharding"):
        plan = QUERIES[key](spark, SF)._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
