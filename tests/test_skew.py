"""One customer holding a third of all rows: results stay exact, the fact
join's hot partition is split by AQE, and every aggregate combines
map-side (no single task receives the hot customer's raw rows)."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import SF_CHECK
from pyspark.sql import functions as F

from quayside.operators import marts, staging
from quayside.plans import registry
from quayside.session import materialize
from quayside.sources import testdata

NOW = dt.datetime(2024, 1, 31)
CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture()
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in CONF}
    for k, v in CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _hot_stg(spark):
    raw = testdata.transactions(spark, SF_CHECK, with_event_id=True)
    hot = raw.withColumn(
        "customer_id", F.when(F.col("event_id") % 3 == 0, F.lit("cust_00000")).otherwise(F.col("customer_id"))
    ).drop("event_id", "sent_at")
    return staging.stg_transactions(hot)


def test_hot_customer(spark, skew_conf):
    registry.prepare(spark)
    stg = _hot_stg(spark)
    dim = materialize(marts.dim_customers(stg, NOW), "dim")  # as the pipeline writes it
    fct = marts.fct_transactions(stg, dim, NOW)
    rows = fct.collect()  # runs the DataFrame's own query execution
    plan = fct._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan
    assert "SortMergeJoin" in plan and "true" in plan.split("SortMergeJoin", 1)[1].split("\n", 1)[0]

    hot = dim.filter(F.col("customer_id") == "cust_00000").collect()[0]
    n_stg = stg.count()
    n_hot = stg.filter(F.col("customer_id") == "cust_00000").count()
    assert n_hot > n_stg / 3 - 50
    assert hot["total_transactions"] == n_hot
    assert len(rows) == n_stg
    assert fct.filter(F.col("customer_segment").isNull()).count() == 0



def test_dimension_aggregates_combine_map_side(spark, skew_conf):
    """Below every exchange of the dimension's plan sits a partial
    aggregate, so the hot customer is shuffled as one row per map task."""
    registry.prepare(spark)
    dim = marts.dim_customers(_hot_stg(spark), NOW)
    lines = dim._jdf.queryExecution().executedPlan().toString().split("\n")
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning(customer_id" in line and "RoundRobin" not in line:
            assert "Aggregate" in lines[i + 1], lines[i : i + 2]


def test_hot_customer_in_the_registered_plan(spark, skew_conf, monkeypatch):
    """The registered fact splits the hot customer's partition too."""
    registry.prepare(spark)
    monkeypatch.setattr(registry, "stg", lambda spark, sf: _hot_stg(spark))
    fct = registry.fct(spark, SF_CHECK)
    n = len(fct.collect())
    plan = fct._jdf.queryExecution().executedPlan().toString()
    assert "skewed=true" in plan or "isSkewJoin=true" in plan or "true" in plan.split("SortMergeJoin", 1)[1].split("\n", 1)[0]
    assert n == _hot_stg(spark).count()
