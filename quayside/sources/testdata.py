"""Transactions derived from the driver's test tables.

The reference consumes purchase events from a message bus. Here the event
stream is derived, row for row, from the ``events`` table joined to
``customer``, ``nation`` and ``part``; every registered query reads these
tables whole, so its work grows with them.

Mapping (same expressions in the DuckDB oracle):

* transaction_id = ``txn_`` + event_id zero-padded to 12 digits
* customer_id = ``cust_`` + user_id zero-padded to 5 digits
* name = c_name + `` v`` + event_id % 3 (differs from event to event); country = n_name;
  email = c_name + ``@example.com``
* amount = round(decimal(value) x factor, 2), factor by user_id % 4:
  0.10, 1, 10, 100 (spreads customers over every spend segment)
* status by event_type: view, click, purchase -> success; error -> failed;
  signup -> refunded when event_id % 3 = 0, else pending
* category / product = p_type / p_name of part ``event_id % (number of part rows)``
* quantity = event_id % 10 + 1; currency USD
* timestamp = ts as ISO-8601 text with microseconds and ``+00:00``
* device = event_id % 3 -> mobile, desktop, tablet
* payment = user_id % 4 + event_id % 2 -> credit_card, debit_card, paypal,
  else bank_transfer
* ip = ``10.0.<user_id % 256>.<event_id % 256>``
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.schema import EVENT_FIELDS


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def zero_pad(n: Column, width: int) -> Column:
    """``n`` as text, left-padded with zeros to ``width`` digits; longer
    numbers are kept whole (``format_string('%0Nd')`` semantics for
    non-negative ids, without the per-row cost of Java's formatter)."""
    text = n.cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def _amount(value: Column, user_id: Column) -> Column:
    factor = (
        F.when(user_id % 4 == 0, F.lit(Decimal("0.10")))
        .when(user_id % 4 == 1, F.lit(Decimal("1.00")))
        .when(user_id % 4 == 2, F.lit(Decimal("10.00")))
        .otherwise(F.lit(Decimal("100.00")))
        .cast("decimal(5,2)")
    )
    return F.round(value.cast("decimal(18,2)") * factor, 2).cast("double")


def _status(event_type: Column, event_id: Column) -> Column:
    return (
        F.when(event_type.isin("view", "click", "purchase"), F.lit("success"))
        .when(event_type == "error", F.lit("failed"))
        .when((event_type == "signup") & (event_id % 3 == 0), F.lit("refunded"))
        .when(event_type == "signup", F.lit("pending"))
    )


def _payment(user_id: Column, event_id: Column) -> Column:
    k = user_id % 4 + event_id % 2
    return (
        F.when(k == 0, F.lit("credit_card"))
        .when(k == 1, F.lit("debit_card"))
        .when(k == 2, F.lit("paypal"))
        .otherwise(F.lit("bank_transfer"))
    )


def transactions(spark: SparkSession, sf_dir: str, with_event_id: bool = False) -> DataFrame:
    """The 15-field transaction events, one per row of ``events``.

    Every event references one row of the whole ``part`` table, so products and
    categories grow with it. No join hints: Spark broadcasts a side
    whose measured size allows it and shuffles otherwise (AQE splits a hot user).
    """
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    parts = part.agg(F.nullif(F.count("*"), F.lit(0))).scalar()
    eid, uid = F.col("event_id"), F.col("user_id")
    joined = (
        ev.withColumn("part_ref", eid % parts)
        .join(cust, ev.user_id == cust.c_custkey, "inner")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "inner")
        .join(part, F.col("part_ref") == F.col("p_partkey"), "left")
    )
    cols = [
        F.concat(F.lit("txn_"), zero_pad(eid, 12)).alias("transaction_id"),
        F.concat(F.lit("cust_"), zero_pad(uid, 5)).alias("customer_id"),
        F.concat(F.col("c_name"), F.lit(" v"), (eid % 3).cast("string")).alias("customer_name"),
        F.concat(F.col("c_name"), F.lit("@example.com")).alias("customer_email"),
        F.col("n_name").alias("customer_country"),
        _amount(F.col("value"), uid).alias("amount"),
        F.lit("USD").alias("currency"),
        _status(F.col("event_type"), eid).alias("status"),
        F.col("p_type").alias("product_category"),
        F.col("p_name").alias("product_name"),
        (eid % 10 + 1).cast("int").alias("quantity"),
        F.date_format(F.col("ts"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias("timestamp"),
        F.concat(F.lit("10.0."), (uid % 256).cast("string"), F.lit("."), (eid % 256).cast("string")).alias(
            "ip_address"
        ),
        F.when(eid % 3 == 0, F.lit("mobile"))
        .when(eid % 3 == 1, F.lit("desktop"))
        .otherwise(F.lit("tablet"))
        .alias("device_type"),
        _payment(uid, eid).alias("payment_method"),
    ]
    if with_event_id:
        cols = [eid.alias("event_id"), F.col("ts").alias("sent_at")] + cols
    return joined.select(*cols)


# --- defect injection (test fixture; FIXTURES.md section 4) ---
# First matching rule wins; every other event is sent clean.
DEFECTS = [
    ("null_id", 97, 1),
    ("unparsable", 83, 3),
    ("negated_amount", 89, 2),
    ("garbage_timestamp", 71, 6),
    ("amount_too_large", 79, 4),
    ("padded_status", 73, 5),
]
# Messages the bus delivers a second time, in a later load.
REDELIVERY = (50, 7)
TOO_LARGE_AMOUNT = 2000000.0


def defect_of(event_id: Column) -> Column:
    out = F.lit("clean")
    for name, mod, rem in reversed(DEFECTS):
        out = F.when(event_id % mod == rem, F.lit(name)).otherwise(out)
    return out


def wire_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bus messages ``(event_id, sent_at, defect, key, value)`` with defects
    applied (``sent_at`` = the event's own time).

    ``value`` is the producer's JSON (nulls written out, as a JSON encoder
    does) or, for the unparsable defect, plain text.
    """
    tx = transactions(spark, sf_dir, with_event_id=True).withColumn("defect", defect_of(F.col("event_id")))
    d = F.col("defect")
    fields = {name: F.col(name) for name in EVENT_FIELDS}
    fields["transaction_id"] = F.when(d == "null_id", F.lit(None).cast("string")).otherwise(F.col("transaction_id"))
    fields["amount"] = (
        F.when(d == "negated_amount", -F.col("amount"))
        .when(d == "amount_too_large", F.lit(TOO_LARGE_AMOUNT))
        .otherwise(F.col("amount"))
    )
    fields["timestamp"] = F.when(d == "garbage_timestamp", F.lit("garbage")).otherwise(F.col("timestamp"))
    fields["status"] = F.when(d == "padded_status", F.lit(" Success ")).otherwise(F.col("status"))
    payload = F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]), {"ignoreNullFields": "false"})
    value = F.when(d == "unparsable", F.concat(F.lit("not json: "), F.col("transaction_id"))).otherwise(payload)
    return tx.select("event_id", "sent_at", "defect", F.col("customer_id").alias("key"), value.alias("value"))


def dealt(messages: DataFrame) -> DataFrame:
    """Messages over the partitions of a bus, as its readers find them: one task for each
    partition, whatever files the messages were derived from. Dealt by the whole message, so no
    customer fills a partition."""
    return messages.repartition("key", "value")


def redelivered(messages: DataFrame) -> DataFrame:
    """The second delivery of some messages (an at-least-once bus)."""
    mod, rem = REDELIVERY
    return messages.filter(F.col("event_id") % mod == rem)
