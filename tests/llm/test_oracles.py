"""Queries that SQL can express, against DuckDB on the same tables."""

from __future__ import annotations

import pytest

from quayside.llm.queries import ORACLES, QUERIES
from tests.conftest import SF_CHECK
from tests.oracle_compare import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF_CHECK)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(sp, con, name):
    ok, said = compare(sp, name, SF_CHECK, con)
    assert ok, said


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
