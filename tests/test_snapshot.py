"""Type-2 snapshot: the three-run scenario on the test tables and the
absent-key and idempotence rules on small frames."""

from __future__ import annotations

import datetime as dt

from conftest import SF_CHECK
from pyspark.sql import functions as F

from quayside.operators import marts, snapshot, staging
from quayside.sources import testdata

CHECK = ["customer_segment", "total_spend", "total_transactions", "failure_rate_pct"]
R1, R2, R3 = dt.datetime(2024, 2, 1), dt.datetime(2024, 2, 2), dt.datetime(2024, 2, 3)


def _dim(stg, users, until, now):
    uid = F.substring("customer_id", 6, 5).cast("int")
    return marts.dim_customers(stg.filter(users(uid) & (F.col("event_timestamp") < F.lit(until))), now)


def test_three_runs_on_test_tables(spark):
    """Run 1: users 0-119 up to 01-10. Run 2: users 5-149; multiples of 3
    see events up to 01-20, the others up to 01-10. Run 3 = run 2 again."""
    stg = staging.stg_transactions(testdata.transactions(spark, SF_CHECK)).cache()
    d1 = _dim(stg, lambda u: u <= 119, dt.datetime(2024, 1, 10), R1)
    early = _dim(stg, lambda u: (u >= 5) & (u % 3 != 0), dt.datetime(2024, 1, 10), R2)
    late = _dim(stg, lambda u: (u >= 5) & (u % 3 == 0), dt.datetime(2024, 1, 20), R2)
    d2 = early.unionByName(late)

    h1 = snapshot.snapshot_scd2(None, d1, "customer_id", CHECK, R1).cache()
    assert h1.count() == 120 and h1.filter("valid_to IS NULL").count() == 120

    changes = dict(
        snapshot.snapshot_changes(h1, d2, "customer_id", CHECK).groupBy("change_type").count().collect()
    )
    assert changes == {"insert": 30, "change": 38, "same": 77, "absent": 5}

    h2 = snapshot.snapshot_scd2(h1, d2, "customer_id", CHECK, R2).cache()
    assert h2.count() == 120 + 30 + 38
    assert h2.filter("valid_to IS NULL").count() == 150  # 145 in run 2 + 5 absent still open
    assert h2.filter(F.col("valid_to") == F.lit(R2)).count() == 38

    d3 = d2.withColumn("loaded_at", F.lit(R3))
    h3 = snapshot.snapshot_scd2(h2, d3, "customer_id", CHECK, R3)
    assert h3.count() == h2.count()
    assert h3.filter(F.col("valid_from") == F.lit(R3)).count() == 0
    assert h3.select("scd_id").distinct().count() == h3.count()
    stg.unpersist()


def test_absent_key_stays_open_and_null_equals_null(spark):
    schema = "customer_id string, customer_segment string, total_spend double, loaded_at timestamp"
    src1 = spark.createDataFrame([("a", "VIP", None, R1), ("b", "Casual", 5.0, R1)], schema)
    h1 = snapshot.snapshot_scd2(None, src1, "customer_id", ["customer_segment", "total_spend"], R1)
    src2 = spark.createDataFrame([("a", "VIP", None, R2)], schema)
    h2 = snapshot.snapshot_scd2(h1, src2, "customer_id", ["customer_segment", "total_spend"], R2).collect()
    assert len(h2) == 2
    assert all(r["valid_to"] is None for r in h2)
    assert {r["valid_from"] for r in h2} == {R1}


def test_log_writes_changes_only_and_gives_the_same_history(spark):
    """One customer in a hundred changes, one is new, one goes and comes back, one has a null key."""
    schema = "customer_id string, customer_segment string, total_spend double, loaded_at timestamp"
    check = ["customer_segment", "total_spend"]

    def run(now, changed, leave_out=(), more=()):
        ids = [f"c{i}" for i in range(200) if i not in leave_out] + list(more)
        return spark.createDataFrame([(c, "VIP", 7.0 if c in changed else None, now) for c in ids], schema)

    runs = [
        (R1, run(R1, set())),
        (R2, run(R2, {"c3", "c9"}, leave_out=(5,), more=("new",))),
        (R3, run(R3, {"c3", "c5"}, more=("new", None))),
    ]
    log, full, sizes = None, None, []
    for now, source in runs:
        opened = snapshot.opened_versions(log, source, "customer_id", check, now).cache()
        sizes.append(opened.count())
        log = opened if log is None else log.unionByName(opened)
        full = snapshot.snapshot_scd2(full, source, "customer_id", check, now).cache()
    # run 2: c3, c9, new; run 3: c9 back to null, c5 on its return, the null key
    assert sizes == [200, 3, 3]
    got = snapshot.history_of(log, "customer_id")
    assert got.columns == full.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, full.collect()))
    # a run repeated over the same rows appends nothing but the null key, which matches nothing
    assert snapshot.opened_versions(log, runs[-1][1], "customer_id", check, dt.datetime(2024, 2, 4)).count() == 1
