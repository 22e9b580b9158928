"""The registered queries of the subpackage against their SQL, where there is one."""

from __future__ import annotations

import pytest
from conftest import SF01
from oracle import compare, duck

from tidemark.llm.queries import ORACLE, QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF01), con, ORACLE[name])
    assert ok, msg


def test_every_operator_is_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14)) and set(QUERIES) | {"pipeline"} <= names
