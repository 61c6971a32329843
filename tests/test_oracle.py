"""Every registered query against its SQL in DuckDB, on whole tables."""

import os

import pytest

import __spark_entry__ as entry
from oracle_check import compare, connect

SF = os.environ.get("ORACLE_SF", "/root/testdata/sf0.001")
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_same_rows_as_sql(spark, duck, key):
    assert compare(QUERIES[key](spark, SF), duck, ORACLES[key]) is None


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["slice_column", "slice_value", "n_samples", "auc_roc", "approval_rate", "default_rate"]
    assert df.count() > 0
