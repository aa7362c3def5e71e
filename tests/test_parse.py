"""Stream operators on events of the given tables, and the parser edge
matrix (malformed input, wrong types, special numbers, odd keys)."""

from __future__ import annotations

import datetime as dt
import json
import math

import pyarrow.parquet as pq
import pytest
from conftest import SF_SMALL, carrying
from pyspark.sql import functions as F

from quayside.operators.parse import (
    build_dlq_payload,
    encode_events,
    parse_transactions,
    read_dlq_payload,
    split_valid_invalid,
)
from quayside.schema import CONTRACT_CATEGORIES
from quayside.sources import testdata

NOW = dt.datetime(2026, 1, 2, 3, 4, 5)


def _some_event() -> dict:
    """One clean event with the values of the first rows of the given tables."""
    customer, part = (pq.read_table(f"{SF_SMALL}/{t}.parquet").slice(0, 1).to_pylist()[0] for t in ("customer", "part"))
    text = {"transaction_id": "txn_0000000000aa", "customer_id": "cust_00007", "customer_name": customer["c_name"]}
    text |= {"customer_email": "a@b.example", "customer_country": "DE", "currency": "USD", "status": "pending"}
    text |= {"product_category": CONTRACT_CATEGORIES[0], "product_name": part["p_name"], "timestamp": "2024-01-05T23:59:58.250000+00:00"}
    text |= {"ip_address": "10.0.7.9", "device_type": "tablet", "payment_method": "paypal"}
    return text | {"amount": 12.25, "quantity": 3}


EVENT = _some_event()


def parse_one(spark, payload):
    return parse_transactions(carrying(spark, payload)).collect()[0]


def test_every_given_event_survives_the_wire(spark):
    """All 15 fields of all events come back as sent, with the time parts of their own time and no reason
    unless the amount is not positive."""
    sent = testdata.transactions(spark, SF_SMALL)
    wire = encode_events(sent)
    back = parse_transactions(wire)
    assert back.select(*sent.columns).exceptAll(sent).count() == 0 and back.count() == sent.count()
    time = F.to_timestamp("timestamp")
    parts = F.struct(F.year(time), F.month(time), F.dayofmonth(time), F.hour(time))
    wrong = back.filter(
        (F.struct("year", "month", "day", "hour") != parts)
        | (F.col("event_timestamp") != time)
        | (F.col("dlq_reason").isNotNull() != (F.col("amount") <= 0))
    )
    assert wrong.count() == 0
    raw = {json.loads(r.raw_value)["transaction_id"] for r in back.select("raw_value").collect()}
    assert len(raw) == sent.count()


def test_each_defect_gets_its_reason(spark):
    """The injected defects of the given events, by kind."""
    back = parse_transactions(testdata.wire_messages(spark, SF_SMALL), keep=["event_id"])
    seen = {
        (r.defect, r.dlq_reason)
        for r in back.withColumn("defect", testdata.defect_of(F.col("event_id"))).select("defect", "dlq_reason").distinct().collect()
    }
    expected = {"null_id": "missing_transaction_id", "unparsable": "missing_transaction_id", "negated_amount": "invalid_amount"}
    for defect, reason in expected.items():
        # a zero amount stays zero when negated: invalid all the same
        assert {r for d, r in seen if d == defect} == {reason}
    assert ("garbage_timestamp", None) in seen and ("amount_too_large", None) in seen


def test_both_broken_reports_the_id(spark):
    assert parse_one(spark, {**EVENT, "transaction_id": None, "amount": None})["dlq_reason"] == "missing_transaction_id"


@pytest.mark.parametrize(
    "payload",
    ["{not valid json", '{"transaction_id": "txn_1', "", "null", "{}", "[]", json.dumps([EVENT])],
)
def test_unusable_payloads_are_missing_id(spark, payload):
    row = parse_one(spark, payload)
    assert row["transaction_id"] is None
    assert row["dlq_reason"] == "missing_transaction_id"


@pytest.mark.parametrize("amount", ["12.5", "x", True])
def test_amount_of_wrong_type_is_invalid(spark, amount):
    assert parse_one(spark, {**EVENT, "amount": amount})["dlq_reason"] == "invalid_amount"


def test_special_numbers_stay_valid(spark):
    """NaN and overflow parse to NaN / infinity; neither is <= 0."""
    row = parse_one(spark, '{"transaction_id": "t1", "amount": NaN}')
    assert math.isnan(row["amount"]) and row["dlq_reason"] is None
    row = parse_one(spark, '{"transaction_id": "t1", "amount": 1e400}')
    assert math.isinf(row["amount"]) and row["dlq_reason"] is None


@pytest.mark.parametrize("quantity", [1.5, "3", 2**40])
def test_bad_quantity_is_null_but_row_kept(spark, quantity):
    row = parse_one(spark, {**EVENT, "quantity": quantity})
    assert row["quantity"] is None and row["dlq_reason"] is None


def test_key_edge_cases(spark):
    assert parse_one(spark, {**EVENT, "transaction_id": 123})["transaction_id"] == "123"
    assert parse_one(spark, {**EVENT, "transaction_id": ""})["dlq_reason"] is None
    wrong_case = {k: v for k, v in EVENT.items() if k != "transaction_id"} | {"Transaction_ID": "x"}
    assert parse_one(spark, wrong_case)["dlq_reason"] == "missing_transaction_id"
    dup = '{"transaction_id": "a", "transaction_id": "b", "amount": 5}'
    assert parse_one(spark, dup)["transaction_id"] == "b"
    extra = parse_transactions(carrying(spark, {**EVENT, "extra": 1}))
    assert "extra" not in extra.columns


def test_unparsable_time_is_valid_with_null_parts(spark):
    row = parse_one(spark, {**EVENT, "timestamp": "garbage"})
    assert row["dlq_reason"] is None
    assert row["event_timestamp"] is None and row["year"] is None


def test_split_loses_and_doubles_nothing(spark):
    parsed = parse_transactions(testdata.wire_messages(spark, SF_SMALL), keep=["event_id"])
    valid, invalid = split_valid_invalid(parsed)
    assert valid.select("event_id").union(invalid.select("event_id")).distinct().count() == parsed.count()
    assert valid.count() + invalid.count() == parsed.count() and invalid.filter("dlq_reason is null").count() == 0
    assert not {"raw_value", "dlq_reason"} & set(valid.columns) and "raw_value" in invalid.columns


def test_dead_letters_carry_the_message_as_sent(spark):
    wire = testdata.wire_messages(spark, SF_SMALL)
    _, invalid = split_valid_invalid(parse_transactions(wire))
    back = read_dlq_payload(build_dlq_payload(invalid, NOW))
    assert back.select("raw_value").exceptAll(wire.select(F.col("value").cast("string"))).count() == 0
    assert back.select("error_timestamp").distinct().collect()[0][0] == NOW
    assert back.groupBy("error_reason").count().exceptAll(invalid.groupBy("dlq_reason").count()).count() == 0


def test_encode_in_key_order(spark):
    tx = testdata.transactions(spark, SF_SMALL)
    enc = encode_events(tx, order_by="timestamp")
    assert enc.count() == tx.count()
    per_task = enc.withColumn("task", F.spark_partition_id()).withColumn(
        "ts", F.get_json_object("value", "$.timestamp")
    )
    # every key lives in one task, and its messages are in time order there
    assert per_task.groupBy("key").agg(F.countDistinct("task").alias("n")).filter("n > 1").count() == 0
    rows = per_task.collect()
    last: dict = {}
    for r in rows:
        assert r["ts"] >= last.get(r["key"], "")
        last[r["key"]] = r["ts"]
