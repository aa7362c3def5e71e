"""Plan-shape checks: the physical plans keep the properties the design
relies on at scale (see README "Design for scale")."""

from __future__ import annotations

import re

import pytest
from conftest import SF_SMALL

from quayside.plans.registry import REGISTRY


def _plan(spark, name: str) -> str:
    df = REGISTRY[name](spark, SF_SMALL)
    return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


@pytest.mark.parametrize("name", ["q3_top_customers", "q6_flagged", "d4_top_customers"])
def test_top_k_is_take_ordered(spark, name):
    assert "TakeOrderedAndProject" in _plan(spark, name)


@pytest.mark.parametrize("name", ["fct_daily_revenue", "q1_revenue_today", "q8_daily_trend_30d", "d5_payment_failure"])
def test_unused_dimension_join_is_eliminated(spark, name):
    plan = _plan(spark, name)
    # no customer-level aggregate is computed at all
    assert "keys=[customer_id" not in plan, plan


def test_dimension_sorts_only_its_narrow_string_part(spark):
    plan = _plan(spark, "dim_customers")
    sort_aggs = [line for line in plan.split("\n") if "SortAggregate" in line]
    # partial + final of the latest-strings aggregate, nothing else
    assert len(sort_aggs) == 2, sort_aggs
    assert all("max_by" in line for line in sort_aggs)
    assert re.search(r"HashAggregate\(keys=\[customer_id#\d+, transaction_date#\d+, product_category#\d+\]", plan)


def test_contract_checks_are_one_global_aggregate(spark):
    plan = _plan(spark, "contract_violations")
    exchanges = [line for line in plan.split("\n") if "Exchange" in line and "Broadcast" not in line]
    # the single-partition exchanges of the global aggregate and of the adapter's
    # count of part rows (a scalar subquery over the table's row count)
    assert sum("SinglePartition" in line for line in exchanges) == 2, exchanges
    assert all("SinglePartition" in line for line in exchanges), exchanges


@pytest.mark.parametrize("name", ["parse_transactions", "split_valid", "split_invalid", "stg_from_stream", "dlq_payload"])
def test_each_message_is_parsed_once(spark, name):
    """One parse of the message in the final plan; the dead-letter query reads its own envelopes back besides."""
    from quayside.schema import EVENT_SCHEMA

    plan = REGISTRY[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(StructField(" + EVENT_SCHEMA.fields[0].name) == 1
    assert plan.count("from_json") == (2 if name == "dlq_payload" else 1)
