"""The business and dashboard queries over the marts.

Each takes mart DataFrames and an explicit ``as_of`` date (the reference
uses the current date). "N-day" windows are ``transaction_date >= as_of - N``
with no upper bound. Top-k queries add a unique tie-break so the k rows are
deterministic; Spark plans ``orderBy().limit()`` as ``TakeOrderedAndProject``
(per-partition top-k, then a merge of k rows per partition), never a full
sort.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions.columns import avg_money, day_floor, rate_pct, ratio_money


def _success():
    return F.col("status") == "success"


def _failed():
    return F.col("status") == "failed"


def q1_revenue_today(fct: DataFrame, as_of: dt.date) -> DataFrame:
    """Successful revenue of ``as_of`` (no row on an empty day)."""
    return (
        fct.filter(_success() & (F.col("transaction_date") == F.lit(as_of)))
        .groupBy(F.to_date("event_timestamp").alias("date"))
        .agg(
            F.sum("amount").alias("total_revenue"),
            F.count(F.lit(1)).alias("transaction_count"),
            avg_money(F.col("amount")).alias("avg_transaction_value"),
        )
    )


def q2_category_7d(fct: DataFrame, as_of: dt.date, days: int = 7) -> DataFrame:
    return (
        fct.filter(F.col("transaction_date") >= day_floor(as_of, days))
        .groupBy("product_category")
        .agg(
            F.sum("amount").alias("total_revenue"),
            F.count(F.lit(1)).alias("transaction_count"),
            avg_money(F.col("amount")).alias("avg_order_value"),
            F.count_if(_failed()).alias("failed_transactions"),
        )
        .orderBy(F.desc("total_revenue"))
    )


def q3_top_customers(dim: DataFrame, k: int = 10) -> DataFrame:
    return (
        dim.select(
            "customer_id",
            "customer_name",
            "customer_country",
            "customer_segment",
            "total_spend",
            "total_transactions",
            "avg_transaction_value",
        )
        .orderBy(F.desc("total_spend"), F.asc("customer_id"))
        .limit(k)
    )


def q4_hourly_today(fct: DataFrame, as_of: dt.date) -> DataFrame:
    return (
        fct.filter(F.col("transaction_date") == F.lit(as_of))
        .groupBy("transaction_hour")
        .agg(
            F.count(F.lit(1)).alias("transactions"),
            F.sum("amount").alias("revenue"),
            F.count_if(_success()).alias("successful"),
            F.count_if(_failed()).alias("failed"),
        )
        .orderBy("transaction_hour")
    )


def q5_failure_by_payment_30d(fct: DataFrame, as_of: dt.date, days: int = 30) -> DataFrame:
    """Plain division (the group count is never zero)."""
    return (
        fct.filter(F.col("transaction_date") >= day_floor(as_of, days))
        .groupBy("payment_method")
        .agg(F.count(F.lit(1)).alias("total"), F.count_if(_failed()).alias("failed"))
        .withColumn("failure_rate_pct", F.round(F.col("failed") / F.col("total") * 100, 2))
        .orderBy(F.desc("failure_rate_pct"))
    )


def q6_flagged(fct: DataFrame, k: int = 50) -> DataFrame:
    """Fraud candidates: high value or potential fraud, largest first. Every flagged
    row is high in amount or failed, which is known before the dimension is joined:
    that filter goes below the join, so only candidates meet the dimension."""
    return (
        fct.filter(F.col("is_high_value") | _failed())
        .filter(F.col("is_high_value") | F.col("is_potential_fraud"))
        .select(
            "transaction_id",
            "customer_id",
            "customer_name",
            "amount",
            "product_category",
            "device_type",
            "ip_address",
            "event_timestamp",
        )
        .orderBy(F.desc("amount"), F.asc("transaction_id"))
        .limit(k)
    )


def q7_segments(dim: DataFrame) -> DataFrame:
    return (
        dim.groupBy("customer_segment")
        .agg(
            F.count(F.lit(1)).alias("customer_count"),
            F.sum("total_spend").alias("segment_revenue"),
            avg_money(F.col("total_spend")).alias("avg_spend_per_customer"),
        )
        .orderBy(F.desc("segment_revenue"))
    )


def q8_daily_trend_30d(fct: DataFrame, as_of: dt.date, days: int = 30) -> DataFrame:
    """One exact distinct count: Spark shuffles on (date, customer) after a
    map-side de-duplication, so a hot day is spread over its customers."""
    return (
        fct.filter(F.col("transaction_date") >= day_floor(as_of, days))
        .groupBy("transaction_date")
        .agg(
            F.sum(F.when(_success(), F.col("amount")).otherwise(F.lit(0))).alias("daily_revenue"),
            F.count(F.lit(1)).alias("total_transactions"),
            F.count_distinct("customer_id").alias("unique_customers"),
        )
        .orderBy("transaction_date")
    )


def d1_kpis_today(daily: DataFrame, as_of: dt.date) -> DataFrame:
    """Global aggregate: always exactly one row (zeros on an empty day).
    The average order value and failure rate are *unweighted* means of the
    per-category values."""
    return daily.filter(F.col("transaction_date") == F.lit(as_of)).agg(
        F.coalesce(F.sum("total_revenue"), F.lit(0)).alias("revenue_today"),
        F.coalesce(F.sum("order_count"), F.lit(0)).alias("orders_today"),
        F.coalesce(F.round(avg_money(F.col("avg_order_value")), 2), F.lit(0)).alias("avg_order_value"),
        F.coalesce(F.round(F.avg("failure_rate_pct"), 2), F.lit(0)).alias("avg_failure_rate"),
    )


def d2_revenue_trend(daily: DataFrame, as_of: dt.date, days: int = 30) -> DataFrame:
    return (
        daily.filter(F.col("transaction_date") >= day_floor(as_of, days))
        .groupBy("transaction_date", "product_category")
        .agg(F.sum("total_revenue").alias("daily_revenue"), F.sum("order_count").alias("daily_orders"))
        .orderBy("transaction_date")
    )


def d2b_daily_total(trend: DataFrame) -> DataFrame:
    """The dashboard's per-date regroup of :func:`d2_revenue_trend`."""
    return trend.groupBy("transaction_date").agg(F.sum("daily_revenue").alias("daily_revenue"))


def d3_category_breakdown(daily: DataFrame, as_of: dt.date, days: int = 30) -> DataFrame:
    """Weighted rates: ratios of sums (unlike d1's mean of ratios)."""
    return (
        daily.filter(F.col("transaction_date") >= day_floor(as_of, days))
        .groupBy("product_category")
        .agg(
            F.sum("total_revenue").alias("revenue"),
            F.sum("order_count").alias("orders"),
            F.sum("failed_orders").alias("_failed"),
        )
        .select(
            "product_category",
            "revenue",
            "orders",
            rate_pct(F.col("_failed"), F.col("orders")).alias("failure_rate_pct"),
            F.round(ratio_money(F.col("revenue"), F.col("orders")), 2).alias("avg_order_value"),
        )
        .orderBy(F.desc("revenue"))
    )


def d4_top_customers(dim: DataFrame, k: int = 20) -> DataFrame:
    return (
        dim.select(
            "customer_id",
            "customer_name",
            "customer_country",
            "customer_segment",
            F.round("total_spend", 2).alias("total_spend"),
            "total_transactions",
            F.round("avg_transaction_value", 2).alias("avg_transaction_value"),
            "failure_rate_pct",
            "active_days",
        )
        .orderBy(F.desc("total_spend"), F.asc("customer_id"))
        .limit(k)
    )


def d5_payment_failure(fct: DataFrame, as_of: dt.date, days: int = 30) -> DataFrame:
    return (
        fct.filter(F.col("transaction_date") >= day_floor(as_of, days))
        .groupBy("payment_method")
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            F.count_if(_failed()).alias("failed_orders"),
            F.round(F.sum("amount"), 2).alias("total_revenue"),
            F.round(avg_money(F.col("amount")), 2).alias("avg_order_value"),
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


def d6_segments(dim: DataFrame) -> DataFrame:
    return (
        dim.groupBy("customer_segment")
        .agg(
            F.count(F.lit(1)).alias("customer_count"),
            F.round(F.sum("total_spend"), 2).alias("segment_revenue"),
            F.round(avg_money(F.col("total_spend")), 2).alias("avg_spend"),
        )
        .orderBy(F.desc("segment_revenue"))
    )
