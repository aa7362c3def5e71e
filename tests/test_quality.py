"""Data-quality report and gates on clean and defect-injected data."""

from __future__ import annotations

import pytest
from conftest import SF_SMALL

from quayside.operators import quality
from quayside.plans import registry


def _report(df):
    return {(r["table"], r["test"], r["column"]): r["failures"] for r in df.collect()}


def test_clean_layers_pass_all_19(spark):
    rep = _report(quality.dq_report(registry.layers(registry.stg(spark, SF_SMALL))))
    assert len(rep) == 19
    assert all(v == 0 for v in rep.values()), rep


def test_stream_with_defects_fails_date_tests(spark):
    rep = _report(registry.REGISTRY["dq_report_stream"](spark, SF_SMALL))
    assert rep[("stg_transactions", "not_null", "transaction_date")] > 0
    assert rep[("fct_daily_revenue", "not_null", "transaction_date")] > 0
    assert rep[("stg_transactions", "unique", "transaction_id")] == 0


def test_semantics_on_small_frame(spark):
    df = spark.createDataFrame(
        [("a", "success"), ("a", "x"), ("b", "y"), ("c", "y"), (None, None)], "k string, status string"
    )
    suite = [
        quality.Check("t", "unique", "k"),
        quality.Check("t", "not_null", "k"),
        quality.Check("t", "accepted_values", "status", ("success",)),
    ]
    rep = _report(quality.dq_report({"t": df}, suite))
    # one duplicated value; one null; two distinct bad values (null passes)
    assert rep == {("t", "unique", "k"): 1, ("t", "not_null", "k"): 1, ("t", "accepted_values", "status"): 2}
    with pytest.raises(quality.DataQualityError):
        quality.gate({"t": df}, suite)


def test_increment_report_equals_whole_table_report(spark):
    from pyspark.sql import functions as F

    stg = registry.stg(spark, SF_SMALL)
    old = stg.filter(F.col("event_timestamp") < F.lit("2024-01-20"))
    new = stg.filter(F.col("event_timestamp") >= F.lit("2024-01-20"))

    def rep(df):
        return {(r["table"], r["test"], r["column"]): r["failures"] for r in df.collect()}

    whole = rep(quality.dq_report({"stg_transactions": old.unionByName(new)}))
    assert rep(quality.increment_report(new, old, "stg_transactions")) == whole
    # an id already present (on another day) is a uniqueness failure
    reused = new.limit(1).withColumn("transaction_id", F.lit(old.first()["transaction_id"]))
    got = rep(quality.increment_report(new.unionByName(reused), old, "stg_transactions"))
    assert got[("stg_transactions", "unique", "transaction_id")] == 1
    with pytest.raises(quality.DataQualityError):
        quality.raise_on_failures(quality.increment_report(new.unionByName(reused), old, "stg_transactions"))


def test_fact_checks_are_implied_by_staging_checks(spark):
    stg = registry.stg(spark, SF_SMALL)
    rep = quality.with_implied(quality.increment_report(stg, None, "stg_transactions"), "stg_transactions", "fct_transactions")
    fct_rows = {(r["test"], r["column"]) for r in rep.filter("table = 'fct_transactions'").collect()}
    assert fct_rows == {(c.test, c.column) for c in quality.SUITE if c.table == "fct_transactions"}
