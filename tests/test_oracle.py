"""Every catalog query against its DuckDB oracle on the sf0.001 test data (the driver's gate at small scale)."""

from __future__ import annotations

import os
import sys

import pytest
from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as entry  # noqa: E402
from stockroom.plans.catalog import QUERIES  # noqa: E402
from stockroom.plans.oracle import oracle_queries  # noqa: E402
from oracle_check import compare, duck_connection  # noqa: E402

SQL = oracle_queries()


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["ProductRootCode", "StoreId", "StartDate", "EndDate", "Stock"]
    assert df.count() == 1036


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    result = compare(spark, SF_SMALL, name, QUERIES[name], SQL[name], con)
    assert result["status"] == "match", result
