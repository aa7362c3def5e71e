"""De-duplication and the insert-only merge."""

from __future__ import annotations

import datetime as dt

from quayside.operators.merge import dedupe_by_key, insert_if_absent, load_guard

SCHEMA = "transaction_id string, event_timestamp timestamp, amount double"
T0 = dt.datetime(2024, 1, 1, 10, 0)
T1 = dt.datetime(2024, 1, 1, 11, 0)


def test_dedupe_keeps_first_by_order_then_smallest_rest(spark):
    df = spark.createDataFrame(
        [("a", T1, 1.0), ("a", T0, 3.0), ("a", T0, 2.0), ("b", T1, 5.0), (None, T0, 7.0), (None, T0, 7.0)], SCHEMA
    )
    out = {(r[0], r[2]) for r in dedupe_by_key(df, "transaction_id", ["event_timestamp"]).collect()}
    rows = dedupe_by_key(df, "transaction_id", ["event_timestamp"]).collect()
    assert len(rows) == 4  # a, b and both null-key rows
    assert ("a", 2.0) in out and ("b", 5.0) in out
    assert sum(1 for r in rows if r[0] is None) == 2
    assert dedupe_by_key(df, "transaction_id", ["event_timestamp"]).columns == df.columns


def test_dedupe_hot_key_is_one_row(spark):
    """A single key holding most rows still comes out once (map-side min)."""
    hot = spark.range(20000).selectExpr(
        "'hot' AS transaction_id", "timestamp'2024-01-01 00:00:00' + make_interval(0,0,0,0,0,0,id) AS event_timestamp",
        "CAST(id AS double) AS amount",
    )
    out = dedupe_by_key(hot, "transaction_id", ["event_timestamp"]).collect()
    assert len(out) == 1 and out[0]["amount"] == 0.0


def test_insert_if_absent(spark):
    target = spark.createDataFrame([("a", T0, 1.0), ("b", T0, 2.0)], SCHEMA)
    source = spark.createDataFrame([("b", T1, 9.0), ("c", T1, 3.0), ("c", T1, 3.0), (None, T1, 4.0)], SCHEMA)
    new = insert_if_absent(target, source, "transaction_id").collect()
    # matched "b" untouched; in-source duplicates and null keys survive (MERGE semantics)
    assert sorted((r[0] or "", r[2]) for r in new) == [("", 4.0), ("c", 3.0), ("c", 3.0)]
    assert insert_if_absent(None, source, "transaction_id").count() == 4


def test_reload_inserts_nothing(spark):
    target = spark.createDataFrame([("a", T0, 1.0), ("b", T0, 2.0)], SCHEMA)
    assert insert_if_absent(target, target, "transaction_id").count() == 0


def test_load_guard(spark):
    assert not load_guard(spark.createDataFrame([], SCHEMA))
    assert load_guard(spark.createDataFrame([("a", T0, 1.0)], SCHEMA))


def test_dedupe_prefers_a_copy_with_a_time(spark):
    rows = [("a", None, 1.0), ("a", T1, 2.0), ("b", None, 3.0)]
    out = {r[0]: r[2] for r in dedupe_by_key(spark.createDataFrame(rows, SCHEMA), "transaction_id", ["event_timestamp"]).collect()}
    assert out == {"a": 2.0, "b": 3.0}


def test_merge_matches_on_the_id_alone(spark):
    target = spark.createDataFrame([("a", T0, 1.0)], SCHEMA)
    load = spark.createDataFrame([("a", T1, 9.0), ("b", None, 2.0)], SCHEMA)
    assert [r[0] for r in insert_if_absent(target, load, "transaction_id").collect()] == ["b"]
