"""Every registered query against its independent DuckDB SQL (the same
check the driver runs at sf0.01; here on the smallest tables for speed)."""

from __future__ import annotations

import pytest
from conftest import SF_SMALL
from oracle_compare import compare, duck

from __spark_entry__ import entry, oracle_sql, queries
from quayside.plans.registry import REGISTRY


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, name, SF_SMALL, con)
    assert ok, msg


def test_every_query_has_an_oracle():
    assert set(REGISTRY) <= set(queries()) and set(REGISTRY) <= set(oracle_sql()) <= set(queries())


def test_entry_smoke(spark):
    df = entry(spark)
    rows = df.collect()
    assert 0 < len(rows) <= 10
    assert df.columns[0] == "customer_id"
