"""Every registered query against its DuckDB oracle at sf0.01 (order-insensitive)."""

from __future__ import annotations

import pytest
from conftest import SF01
from oracle import compare, duck

import __spark_entry__ as entry
from tidemark.plans import layer_queries, oracle as sql, queries, writes

QUERIES = {**queries.QUERIES, **layer_queries.QUERIES, **writes.QUERIES}
ORACLE = {**sql.ORACLE, **layer_queries.ORACLE, **writes.ORACLE}


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF01), con, ORACLE[name])
    assert ok, msg


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["user_id", "calendar_dt", "attr", "v", "v_delta"]
    assert df.count() == 397

