"""Event-contract checks."""

from __future__ import annotations

from conftest import carrying
from test_parse import EVENT

from quayside.operators.contract import contract_violation_rows, contract_violations
from quayside.operators.parse import parse_transactions


def test_good_event_breaks_nothing(spark):
    rows = contract_violation_rows(parse_transactions(carrying(spark, EVENT))).collect()
    assert rows == []


def test_each_rule_fires(spark):
    bad = {
        **EVENT,
        "transaction_id": "txn_XYZ",
        "customer_country": "usa",
        "amount": 60000.0,
        "currency": "EUR",
        "status": "done",
        "quantity": 11,
        "ip_address": "300.1.1.1",
        "customer_email": "nobody",
        "timestamp": "yesterday",
        "extra": 1,
    }
    got = {(r["field"], r["rule"]) for r in contract_violation_rows(parse_transactions(carrying(spark, bad))).collect()}
    assert got == {
        ("transaction_id", "pattern"),
        ("customer_country", "pattern"),
        ("amount", "maximum"),
        ("currency", "const"),
        ("status", "enum"),
        ("quantity", "maximum"),
        ("ip_address", "format_ipv4"),
        ("customer_email", "format_email"),
        ("timestamp", "format_date_time"),
        ("$", "additional_properties"),
    }


def test_summary_lists_every_rule(spark):
    out = contract_violations(parse_transactions(carrying(spark, EVENT, "oops"))).collect()
    counts = {(r["field"], r["rule"]): r["violations"] for r in out}
    assert len(counts) == 34
    assert counts[("$", "type_object")] == 1
    assert counts[("transaction_id", "required")] == 1
    assert counts[("status", "enum")] == 0
