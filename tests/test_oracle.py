"""Every registered query equals its DuckDB oracle on the smallest supplied tables (the driver's gate, in-repo)."""

import os

import pytest

import __spark_entry__ as E
import oracle
from commitlens.plans.bindings import ORACLE, QUERIES

SF = os.environ.get("COMMITLENS_TEST_SF", "/root/testdata/sf0.001")
KEYS = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return oracle.duck(SF)


def test_every_query_has_an_oracle():
    missing = [k for k in KEYS if k not in ORACLE]
    assert missing == []


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = QUERIES[key](spark, SF)
    ok, msg = oracle.compare(df, ORACLE[key], SF, con)
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["ext", "n"]
    assert df.count() > 0
