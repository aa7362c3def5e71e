"""Marts: customer dimension, enriched transaction fact, daily rollup.

Money stays exact decimal end to end; rates are doubles. ``now`` (the load
time stamped on each row) is a parameter, never ``current_timestamp()``, so
a recomputed task or a replayed run writes identical rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions.columns import avg_money, is_true, latest_non_null, rate_pct, ratio_money, segment
from quayside.schema import FRAUD_FAILURE_RATE_PCT, HIGH_VALUE_AMOUNT, REGULAR_SPEND, VIP_SPEND

def dim_customers(
    stg: DataFrame,
    now: dt.datetime,
    vip: float = VIP_SPEND,
    regular: float = REGULAR_SPEND,
) -> DataFrame:
    """One row per customer: latest known name/email/country, counts, spend,
    activity span, failure rate and a spend segment.

    Planned as aggregates that each combine map-side, so a customer holding
    a third of all rows never reaches one task as raw rows:

    1. a hash pre-aggregate per (customer, date, category) of every
       decomposable measure (sums, counts, min/max): fixed-width buffers,
       so Spark uses ``HashAggregate`` and the shuffle carries one row per
       group and map task;
    2. per customer over those groups: sums of sums, and the distinct
       day and category counts, whose ``Expand`` now multiplies the reduced
       groups instead of every transaction;
    3. the exact distinct transaction count, keyed on (customer, id) in its
       first shuffle;
    4. the latest non-null name, email and country over the narrow
       (customer, time, id, strings) projection: string buffers force a
       sort-based aggregate, so it is kept away from the wide steps.

    The parts are left-joined on ``customer_id``: a query that reads no column of
    a part drops that part and its scan (every part has one row per customer, so left
    and inner joins agree). Each part is hash-partitioned on it
    by its final aggregate, so the joins add no exchange of their own.
    """
    stg = stg.filter(F.col("customer_id").isNotNull())
    success = F.col("status") == "success"
    amount = F.col("amount")
    per_group = [
        F.sum(F.when(success, amount).otherwise(F.lit(0))).alias("spend"),
        F.sum(F.when(success, amount)).alias("success_amount"),
        F.count(F.when(success, amount)).alias("success_n"),
        F.min("event_timestamp").alias("first_seen_at"),
        F.max("event_timestamp").alias("last_seen_at"),
        F.count_if(F.col("status") == "failed").alias("failed_transactions"),
        F.count(F.lit(1)).alias("n_rows"),
    ]
    groups = stg.groupBy("customer_id", "transaction_date", "product_category").agg(*per_group)
    totals = [
        F.sum("spend").alias("spend"),
        F.sum("success_amount").alias("success_amount"),
        F.sum("success_n").alias("success_n"),
        F.min("first_seen_at").alias("first_seen_at"),
        F.max("last_seen_at").alias("last_seen_at"),
        F.sum("failed_transactions").alias("failed_transactions"),
        F.sum("n_rows").alias("n_rows"),
        F.count_distinct("transaction_date").alias("active_days"),
        F.count_distinct("product_category").alias("categories_purchased"),
    ]
    ids = stg.groupBy("customer_id").agg(F.count_distinct("transaction_id").alias("total_transactions"))
    metrics = groups.groupBy("customer_id").agg(*totals).join(ids, "customer_id", "left")
    order = ("event_timestamp", "transaction_id")
    names = stg.groupBy("customer_id").agg(
        latest_non_null("customer_name", *order).alias("customer_name"),
        latest_non_null("customer_email", *order).alias("customer_email"),
        latest_non_null("customer_country", *order).alias("customer_country"),
    )
    return _dim_output(metrics.join(names, "customer_id", "left"), now, vip, regular)


def _dim_output(m: DataFrame, now: dt.datetime, vip: float, regular: float) -> DataFrame:
    return m.select(
        "customer_id",
        "customer_name",
        "customer_email",
        "customer_country",
        "total_transactions",
        F.round("spend", 2).alias("total_spend"),
        F.round(ratio_money(F.col("success_amount"), F.col("success_n")), 2).alias("avg_transaction_value"),
        "active_days",
        "first_seen_at",
        "last_seen_at",
        "categories_purchased",
        "failed_transactions",
        rate_pct(F.col("failed_transactions"), F.col("n_rows")).alias("failure_rate_pct"),
        # The segment uses the unrounded spend.
        segment(F.col("spend"), vip, regular).alias("customer_segment"),
        F.lit(now).cast("timestamp").alias("loaded_at"),
    )


NAME_COLUMNS = ("customer_name", "customer_email", "customer_country")


def customer_day_groups(stg: DataFrame) -> DataFrame:
    """State rows of the incremental dimension: one per (customer, date,
    category) with every decomposable measure, the transaction count, and
    for each name column the latest non-null value with its (time, id) key.

    Every column combines associatively across groups, so the groups of one
    day can be recomputed from that day's rows alone and the dimension
    rebuilt from all groups (:func:`dim_from_groups`) equals
    :func:`dim_customers` over all rows. Transaction ids must be unique
    (the staging gate), as the count is not distinct.
    """
    success = F.col("status") == "success"
    amount = F.col("amount")
    order = F.struct(F.col("event_timestamp"), F.col("transaction_id"))
    latest = []
    for c in NAME_COLUMNS:
        key = F.when(F.col(c).isNotNull(), order)
        latest += [F.max(key).alias(f"{c}_key"), F.max_by(F.col(c), key).alias(c)]
    return stg.groupBy("customer_id", "transaction_date", "product_category").agg(
        F.sum(F.when(success, amount).otherwise(F.lit(0))).alias("spend"),
        F.sum(F.when(success, amount)).alias("success_amount"),
        F.count(F.when(success, amount)).alias("success_n"),
        F.min("event_timestamp").alias("first_seen_at"),
        F.max("event_timestamp").alias("last_seen_at"),
        F.count_if(F.col("status") == "failed").alias("failed_transactions"),
        F.count(F.lit(1)).alias("n_rows"),
        F.count("transaction_id").alias("n_ids"),
        *latest,
    )


def dim_from_groups(
    groups: DataFrame, now: dt.datetime, vip: float = VIP_SPEND, regular: float = REGULAR_SPEND
) -> DataFrame:
    """The customer dimension from :func:`customer_day_groups` rows: sums
    and extremes of the groups, distinct days and categories over them,
    and the value with the greatest key per name column (a narrow separate
    aggregate, since string buffers sort)."""
    groups = groups.filter(F.col("customer_id").isNotNull())
    metrics = groups.groupBy("customer_id").agg(
        F.sum("spend").alias("spend"),
        F.sum("success_amount").alias("success_amount"),
        F.sum("success_n").alias("success_n"),
        F.min("first_seen_at").alias("first_seen_at"),
        F.max("last_seen_at").alias("last_seen_at"),
        F.sum("failed_transactions").alias("failed_transactions"),
        F.sum("n_rows").alias("n_rows"),
        F.count_distinct("transaction_date").alias("active_days"),
        F.count_distinct("product_category").alias("categories_purchased"),
        F.sum("n_ids").alias("total_transactions"),
    )
    names = groups.groupBy("customer_id").agg(
        *[F.max_by(F.col(c), F.col(f"{c}_key")).alias(c) for c in NAME_COLUMNS]
    )
    return _dim_output(metrics.join(names, "customer_id", "left"), now, vip, regular)


def fct_transactions(
    stg: DataFrame,
    dim: DataFrame,
    now: dt.datetime,
    high_value: float = HIGH_VALUE_AMOUNT,
    fraud_rate_pct: float = FRAUD_FAILURE_RATE_PCT,
) -> DataFrame:
    """Staging rows left-joined to the dimension on ``customer_id``; name,
    email, country and segment come from the dimension.

    No broadcast hint: the dimension grows with the customer count. Spark
    broadcasts it only when its size is measured under the threshold (AQE
    re-checks at run time); otherwise a sort-merge join, where AQE splits
    the partition of a customer holding a large share of the fact rows.
    AQE splits skewed partitions only between two shuffle stages, so the
    batch pipeline passes the *written* dimension (a table scan); a
    dimension computed in the same plan arrives already partitioned on the
    key and is joined without an exchange, but without the skew split.
    """
    d = dim.select(
        "customer_id", "customer_name", "customer_email", "customer_country", "customer_segment", "failure_rate_pct"
    )
    t = stg.drop("customer_name", "customer_email", "customer_country")
    j = t.join(d, "customer_id", "left")
    return j.select(
        "transaction_id",
        "customer_id",
        "customer_name",
        "customer_email",
        "customer_country",
        "customer_segment",
        "amount",
        "currency",
        "status",
        "product_category",
        "product_name",
        "quantity",
        F.round(F.col("amount") * F.col("quantity"), 2).alias("total_line_value"),
        "device_type",
        "payment_method",
        "ip_address",
        "transaction_date",
        "transaction_hour",
        "event_timestamp",
        is_true(F.col("amount") > high_value).alias("is_high_value"),
        is_true((F.col("status") == "failed") & (F.col("failure_rate_pct") > fraud_rate_pct)).alias(
            "is_potential_fraud"
        ),
        F.lit(now).cast("timestamp").alias("loaded_at"),
    )


def with_amount_flag(stg: DataFrame, high_value: float = HIGH_VALUE_AMOUNT) -> DataFrame:
    """Staging rows with the one flag that needs no customer: all that the daily
    rollup and the windowed queries read of the fact, without its join."""
    return stg.withColumn("is_high_value", is_true(F.col("amount") > high_value))


def fct_daily_revenue(fct: DataFrame, now: dt.datetime) -> DataFrame:
    """One row per (transaction_date, product_category).

    ``total_revenue`` counts every status; ``successful_revenue`` only
    successes. The group count is days x categories, so the partial
    aggregate leaves a few rows per map task and the shuffle is tiny.
    """
    status = F.col("status")
    amount = F.col("amount")
    return fct.groupBy("transaction_date", "product_category").agg(
        F.count(F.lit(1)).alias("order_count"),
        F.count_if(status == "success").alias("successful_orders"),
        F.count_if(status == "failed").alias("failed_orders"),
        F.count_if(status == "refunded").alias("refunded_orders"),
        F.count_if(status == "pending").alias("pending_orders"),
        F.count_if(F.col("is_high_value")).alias("high_value_orders"),
        F.round(F.sum(amount), 2).alias("total_revenue"),
        F.round(F.sum(F.when(status == "success", amount).otherwise(F.lit(0))), 2).alias("successful_revenue"),
        F.round(avg_money(amount), 2).alias("avg_order_value"),
        F.sum("quantity").alias("total_quantity_sold"),
        rate_pct(F.count_if(status == "failed"), F.count(F.lit(1))).alias("failure_rate_pct"),
        F.lit(now).cast("timestamp").alias("loaded_at"),
    )
