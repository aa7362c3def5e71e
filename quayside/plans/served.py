"""The windowed queries over the day states of :mod:`quayside.operators.states`.

Same names, columns and values as in :mod:`quayside.plans.queries`; the input is a few rows a day instead of the
transactions. Averages divide exact sums by counts, so they round once, as over the rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.columns import day_floor, rate_pct, ratio_money
from quayside.operators.states import CANDIDATES
from quayside.plans.queries import q6_flagged as q6_over_rows

TOTAL = "decimal(28,9)"


def _amount(where: Column | None = None) -> Column:
    value = F.col("amount") if where is None else F.when(where, F.col("amount")).otherwise(F.lit(0))
    return F.sum(value).cast(TOTAL)


def _rows(where: Column | None = None) -> Column:
    return F.sum("n_rows") if where is None else F.sum(F.when(where, F.col("n_rows")).otherwise(F.lit(0)))


def _average() -> Column:
    return ratio_money(F.sum("amount"), F.sum("n_amounts"))


def _is(status: str) -> Column:
    return F.col("status") == status


def q1_revenue_today(measures: DataFrame, as_of: dt.date) -> DataFrame:
    today = measures.filter(_is("success") & (F.col("transaction_date") == F.lit(as_of)))
    return today.groupBy(F.col("transaction_date").alias("date")).agg(
        _amount().alias("total_revenue"), _rows().alias("transaction_count"), _average().alias("avg_transaction_value")
    )


def q2_category_7d(measures: DataFrame, as_of: dt.date, days: int = 7) -> DataFrame:
    window = measures.filter(F.col("transaction_date") >= day_floor(as_of, days))
    return (
        window.groupBy("product_category")
        .agg(
            _amount().alias("total_revenue"),
            _rows().alias("transaction_count"),
            _average().alias("avg_order_value"),
            _rows(_is("failed")).alias("failed_transactions"),
        )
        .orderBy(F.desc("total_revenue"))
    )


def q4_hourly_today(measures: DataFrame, as_of: dt.date) -> DataFrame:
    return (
        measures.filter(F.col("transaction_date") == F.lit(as_of))
        .groupBy("transaction_hour")
        .agg(
            _rows().alias("transactions"),
            _amount().alias("revenue"),
            _rows(_is("success")).alias("successful"),
            _rows(_is("failed")).alias("failed"),
        )
        .orderBy("transaction_hour")
    )


def q5_failure_by_payment_30d(measures: DataFrame, as_of: dt.date, days: int = 30) -> DataFrame:
    return (
        measures.filter(F.col("transaction_date") >= day_floor(as_of, days))
        .groupBy("payment_method")
        .agg(_rows().alias("total"), _rows(_is("failed")).alias("failed"))
        .withColumn("failure_rate_pct", F.round(F.col("failed") / F.col("total") * 100, 2))
        .orderBy(F.desc("failure_rate_pct"))
    )


def q6_flagged(candidates: DataFrame | None, dim: DataFrame, rows: Callable[[], DataFrame], k: int = 50) -> DataFrame:
    """Every high-value row is larger than every row that is flagged for its customer's failure rate alone. So if
    there are ``k`` high-value rows, the answer is the first ``k`` of them, and they are among the candidates for
    ``k`` up to ``CANDIDATES``. Otherwise the answer takes the fact, ``rows()``."""
    if candidates is None or k > CANDIDATES:
        return q6_over_rows(rows(), k)
    first = candidates.orderBy(F.desc("amount"), F.asc("transaction_id")).limit(k)
    if first.count() < k:
        return q6_over_rows(rows(), k)
    named = first.join(dim.select("customer_id", "customer_name"), "customer_id", "left")
    columns = ("transaction_id", "customer_id", "customer_name", "amount", "product_category", "device_type", "ip_address", "event_timestamp")
    return named.select(*columns).orderBy(F.desc("amount"), F.asc("transaction_id"))


def q8_daily_trend_30d(measures: DataFrame, customers: DataFrame, as_of: dt.date, days: int = 30) -> DataFrame:
    """A day's customers come beside its measures by a union: one small aggregate, no join."""
    parts = measures.select("transaction_date", "status", "amount", "n_rows", F.lit(0).cast("long").alias("unique_customers"))
    counted = customers.select(
        "transaction_date", F.lit(None).cast("string").alias("status"), F.lit(0).cast("decimal(28,9)").alias("amount"),
        F.lit(0).cast("long").alias("n_rows"), "unique_customers",
    )
    return (
        parts.unionByName(counted)
        .filter(F.col("transaction_date") >= day_floor(as_of, days))
        .groupBy("transaction_date")
        .agg(
            _amount(_is("success")).alias("daily_revenue"),
            _rows().alias("total_transactions"),
            F.sum("unique_customers").alias("unique_customers"),
        )
        .orderBy("transaction_date")
    )


def d5_payment_failure(measures: DataFrame, as_of: dt.date, days: int = 30) -> DataFrame:
    return (
        measures.filter(F.col("transaction_date") >= day_floor(as_of, days))
        .groupBy("payment_method")
        .agg(
            _rows().alias("total_orders"),
            _rows(_is("failed")).alias("failed_orders"),
            F.round(_amount(), 2).alias("total_revenue"),
            F.round(_average(), 2).alias("avg_order_value"),
        )
        .select(
            "payment_method",
            "total_orders",
            "failed_orders",
            rate_pct(F.col("failed_orders"), F.col("total_orders")).alias("failure_rate_pct"),
            "total_revenue",
            "avg_order_value",
        )
        .orderBy(F.desc("failure_rate_pct"))
    )
