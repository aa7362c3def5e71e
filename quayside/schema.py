"""The transaction event contract and the column lists of every layer."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

# --- fixed values that must equal the reference's for right results ---
# The 15 event fields in wire order. The nullable flags document the
# contract; ``from_json`` treats every parsed field as nullable anyway.
EVENT_SCHEMA = StructType(
    [
        StructField("transaction_id", StringType(), False),
        StructField("customer_id", StringType(), False),
        StructField("customer_name", StringType(), True),
        StructField("customer_email", StringType(), True),
        StructField("customer_country", StringType(), True),
        StructField("amount", DoubleType(), False),
        StructField("currency", StringType(), True),
        StructField("status", StringType(), False),
        StructField("product_category", StringType(), True),
        StructField("product_name", StringType(), True),
        StructField("quantity", IntegerType(), True),
        StructField("timestamp", StringType(), False),
        StructField("ip_address", StringType(), True),
        StructField("device_type", StringType(), True),
        StructField("payment_method", StringType(), True),
    ]
)

# --- end of fixed values ---

EVENT_FIELDS = [f.name for f in EVENT_SCHEMA.fields]

# Columns the stream derives from the event time.
TIME_PARTS = ["event_timestamp", "year", "month", "day", "hour"]

# Lake directory partition columns (date for pruning, batch key for replay).
LAKE_PARTITIONS = ["year", "month", "day", "batch_key"]

# --- fixed values that must equal the reference's for right results ---
# Transaction statuses accepted by staging and by the data tests.
STATUSES = ["success", "failed", "pending", "refunded"]
# Customer segments and the spend thresholds that define them.
SEGMENTS = ["VIP", "Regular", "Casual"]
VIP_SPEND = 10000
REGULAR_SPEND = 1000
# Transaction flags: high value above this amount; potential fraud when a
# failed transaction belongs to a customer above this failure rate (percent).
HIGH_VALUE_AMOUNT = 10000
FRAUD_FAILURE_RATE_PCT = 20
# Staging keeps amounts strictly between 0 and this bound.
STAGING_MAX_AMOUNT = 1000000
# Dead-letter reasons.
REASON_MISSING_ID = "missing_transaction_id"
REASON_INVALID_AMOUNT = "invalid_amount"
# Event contract (documented JSON Schema of the producer).
CONTRACT_TRANSACTION_ID_PATTERN = "^txn_[0-9a-f]{12}$"
CONTRACT_CUSTOMER_ID_PATTERN = "^cust_[0-9]{5}$"
CONTRACT_COUNTRY_PATTERN = "^[A-Z]{2}$"
CONTRACT_AMOUNT_EXCLUSIVE_MIN = 0
CONTRACT_AMOUNT_MAX = 50000
CONTRACT_CURRENCY = "USD"
CONTRACT_CATEGORIES = [
    "electronics",
    "clothing",
    "food",
    "books",
    "sports",
    "home",
    "beauty",
    "toys",
    "automotive",
    "jewelry",
]
CONTRACT_QUANTITY_MIN = 1
CONTRACT_QUANTITY_MAX = 10
CONTRACT_DEVICES = ["mobile", "desktop", "tablet"]
CONTRACT_PAYMENT_METHODS = ["credit_card", "debit_card", "paypal", "bank_transfer"]
# --- end of fixed values ---

# Our own spellings of the three JSON Schema "format" checks (the contract
# names the formats; these regular expressions are one reading of them).
EMAIL_PATTERN = "^[^@\\s]+@[^@\\s]+\\.[^@\\s]+$"
IPV4_PATTERN = (
    "^((25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])\\.){3}"
    "(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])$"
)
DATETIME_PATTERN = (
    "^[0-9]{4}-[0-9]{2}-[0-9]{2}[Tt ][0-9]{2}:[0-9]{2}:[0-9]{2}"
    "(\\.[0-9]+)?([Zz]|[+-][0-9]{2}:[0-9]{2})$"
)

# Money is exact decimal from staging on (the warehouse NUMERIC type has
# scale 9); 18 digits hold every amount below the staging bound.
MONEY = "decimal(18,9)"
