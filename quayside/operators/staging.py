"""Staging: the cleaned, typed view every mart reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.schema import MONEY, STAGING_MAX_AMOUNT, STATUSES


def stg_transactions(raw: DataFrame, statuses: list[str] = STATUSES, max_amount: float = STAGING_MAX_AMOUNT) -> DataFrame:
    """Filter then normalise raw warehouse rows.

    The row filter sees the *source* columns: the amount range is tested on
    the raw double (a NaN amount fails it; the decimal cast would have
    turned it into null) and the status list on the raw, untrimmed text, so
    ``" Success "`` is dropped rather than repaired. Nothing is de-duplicated
    here. The event time is re-parsed from the wire text.

    A filter followed by a projection: no shuffle, and the predicates reach
    the Parquet scan when ``raw`` is a lake read.
    """
    ts = F.try_to_timestamp(F.col("timestamp"))
    return raw.filter(
        F.col("transaction_id").isNotNull()
        & F.col("customer_id").isNotNull()
        & (F.col("amount") > 0)
        & (F.col("amount") < max_amount)
        & F.col("status").isin(*statuses)
    ).select(
        "transaction_id",
        "customer_id",
        F.lower(F.trim("customer_name")).alias("customer_name"),
        F.lower(F.trim("customer_email")).alias("customer_email"),
        F.upper(F.trim("customer_country")).alias("customer_country"),
        F.col("amount").try_cast(MONEY).alias("amount"),
        F.upper(F.trim("currency")).alias("currency"),
        F.lower(F.trim("status")).alias("status"),
        F.lower(F.trim("product_category")).alias("product_category"),
        F.trim("product_name").alias("product_name"),
        F.col("quantity").try_cast("int").alias("quantity"),
        ts.alias("event_timestamp"),
        "ip_address",
        F.lower(F.trim("device_type")).alias("device_type"),
        F.lower(F.trim("payment_method")).alias("payment_method"),
        F.to_date(ts).alias("transaction_date"),
        F.hour(ts).alias("transaction_hour"),
    )
