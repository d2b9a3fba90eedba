"""Every registered query equals its DuckDB oracle SQL on the smallest test scale."""

from __future__ import annotations

import pytest
from conftest import SF_SMALL
from oracle_compare import compare, duck_connection

import __spark_entry__ as entry
from bazaar.plans.registry import queries
from oracle import oracle_queries

QUERIES = queries()
ORACLE = oracle_queries()


@pytest.fixture(scope="module")
def duck():
    return duck_connection(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n.endswith("_spoiled")))
def test_spoiled_rows_are_reported(spark, name):
    assert QUERIES[name](spark, SF_SMALL).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    res = compare(spark, name, QUERIES[name](spark, SF_SMALL), ORACLE[name], SF_SMALL, duck)
    assert res["columns_match"], res
    assert res["spark_rows"] == res["oracle_rows"], res
    assert not res["type_diff"], res
    assert res["values_match"], res


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "net_revenue_usd" in df.columns
