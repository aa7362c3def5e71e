"""The batch pipeline end to end: lake -> warehouse -> marts -> snapshot,
a re-run that inserts nothing, and a failing gate that stops the run."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from quayside.operators import quality
from quayside.operators.parse import encode_events, parse_transactions, split_valid_invalid
from quayside.plans import batch, registry
from quayside.sources import testdata
from quayside.sources.lake import write_lake_batch

NOW1 = dt.datetime(2024, 1, 31)
NOW2 = dt.datetime(2024, 2, 1)


def _lake_from(spark, messages, lake):
    valid, _ = split_valid_invalid(parse_transactions(messages))
    write_lake_batch(valid, lake, "t-0")


def test_end_to_end_and_rerun(spark, scratch):
    paths = batch.Paths(lake=os.path.join(scratch, "lake"), warehouse=os.path.join(scratch, "wh"))
    assert not batch.run_batch(spark, paths, NOW1).loaded  # empty lake is a no-op

    _lake_from(spark, encode_events(testdata.transactions(spark, SF_SMALL)), paths.lake)
    r1 = batch.run_batch(spark, paths, NOW1)
    assert r1.loaded and r1.inserted == 1000 and "mart tests passed" in r1.stages

    built = batch.marts_from_warehouse(spark, paths)
    expect = registry.layers(registry.stg(spark, SF_SMALL), NOW1)
    for name in ("dim_customers", "fct_daily_revenue"):
        assert built[name].count() == expect[name].count()
    a = built["fct_daily_revenue"].agg(F.sum("total_revenue")).collect()[0][0]
    b = expect["fct_daily_revenue"].agg(F.sum("total_revenue")).collect()[0][0]
    assert a == b
    assert os.path.isdir(os.path.join(paths.staged, "event_day=2024-01-30"))
    fct = built["fct_transactions"]
    assert fct.count() == expect["fct_transactions"].count()
    assert sorted(fct.columns) == sorted(expect["fct_transactions"].columns)
    cols = ["transaction_id", "customer_segment", "is_potential_fraud", "total_line_value"]
    assert fct.select(*cols).exceptAll(expect["fct_transactions"].select(*cols)).count() == 0
    window = batch.fact_view(spark, paths, since=dt.date(2024, 1, 28))
    explained = spark._jvm.PythonSQLUtils.explainString(window._jdf.queryExecution(), "formatted")
    staged_scans = [b for b in explained.split("\n\n") if "Scan parquet" in b and "stg_transactions" in b]
    assert staged_scans and all("PartitionFilters: [(event_day" in b and "2024-01-28" in b for b in staged_scans)
    assert window.count() == expect["fct_transactions"].filter("transaction_date >= '2024-01-28'").count()

    r2 = batch.run_batch(spark, paths, NOW2)
    assert not r2.loaded and r2.inserted == 0  # no new lake batch: nothing read

    # A new batch redelivering part of the first one: read alone, inserts only new ids.
    again = encode_events(testdata.transactions(spark, SF_SMALL)).limit(10)
    valid, _ = split_valid_invalid(parse_transactions(again))
    write_lake_batch(valid, paths.lake, "t-1")
    r2 = batch.run_batch(spark, paths, NOW2)
    assert r2.loaded and r2.inserted == 0
    hist, version = batch.snapshot_history(spark, paths)
    n_dim = built["dim_customers"].count()
    # run 2 saw the same data: nothing closed, nothing opened
    assert version == batch.run_id(NOW2) and hist.count() == n_dim
    assert hist.filter("valid_to IS NULL").count() == n_dim
    # the first run's mart version is still readable after the refresh
    assert built["dim_customers"].count() == expect["dim_customers"].count()


def test_failing_gate_stops_before_marts(spark, scratch):
    paths = batch.Paths(lake=os.path.join(scratch, "lake"), warehouse=os.path.join(scratch, "wh"))
    _lake_from(spark, testdata.wire_messages(spark, SF_SMALL), paths.lake)  # has unparsable times
    with pytest.raises(quality.DataQualityError) as err:
        batch.run_batch(spark, paths, NOW1, bad_rows="refuse")
    assert any(f[2] == "transaction_date" for f in err.value.failures)
    assert not os.path.exists(paths.mart("dim_customers"))


def test_snapshot_across_runs(spark, scratch):
    """Run 1 sees events before 01-15, run 2 all of them: changed customers
    get one closed and one open version; the history is closed deltas of
    every run plus the newest open set."""
    from quayside.operators import snapshot

    paths = batch.Paths(lake=os.path.join(scratch, "lake"), warehouse=os.path.join(scratch, "wh"))
    cut = dt.datetime(2024, 1, 15, 12)  # day 01-15 is split between the two loads
    events = testdata.transactions(spark, SF_SMALL, with_event_id=True)
    early = events.filter(F.col("sent_at") < F.lit(cut)).drop("event_id", "sent_at")
    late = events.filter(F.col("sent_at") >= F.lit(cut)).drop("event_id", "sent_at")
    _lake_batch(spark, encode_events(early), paths.lake, "t-0")
    batch.run_batch(spark, paths, NOW1)
    dim1 = batch.read_mart(spark, paths, "dim_customers")
    n1 = dim1.count()
    _lake_batch(spark, encode_events(late), paths.lake, "t-1")
    batch.run_batch(spark, paths, NOW2)
    dim2 = batch.read_mart(spark, paths, "dim_customers")

    # incremental dimension (day groups of touched days only) == full recompute
    from quayside.operators import marts

    full = marts.dim_customers(batch.read_staged(spark, paths), NOW2)
    cols = [c for c in full.columns if c != "loaded_at"]
    assert dim2.select(*cols).exceptAll(full.select(*cols)).count() == 0
    assert full.select(*cols).exceptAll(dim2.select(*cols)).count() == 0
    # incremental daily rollup (touched days re-aggregated) == full recompute
    daily = batch.read_mart(spark, paths, "fct_daily_revenue")
    full_daily = marts.fct_daily_revenue(marts.fct_transactions(batch.read_staged(spark, paths), dim2, NOW2), NOW2)
    assert daily.exceptAll(full_daily.select(*daily.columns)).count() == 0
    assert full_daily.select(*daily.columns).exceptAll(daily).count() == 0

    changes = dict(
        snapshot.snapshot_changes(
            snapshot.open_versions(dim1, "customer_id", NOW1), dim2, "customer_id", batch.SNAPSHOT_CHECK_COLS
        )
        .groupBy("change_type")
        .count()
        .collect()
    )
    hist, _ = batch.snapshot_history(spark, paths)
    n_closed = hist.filter("valid_to IS NOT NULL").count()
    assert n_closed == changes.get("change", 0) > 0
    assert hist.filter("valid_to IS NULL").count() == dim2.count()
    assert hist.count() == n1 + changes.get("insert", 0) + changes.get("change", 0)
    assert hist.select("scd_id").distinct().count() == hist.count()


def _lake_batch(spark, messages, lake, key):
    valid, _ = split_valid_invalid(parse_transactions(messages))
    write_lake_batch(valid, lake, key)


def test_jobs_cli_batch(spark, scratch, capsys):
    from quayside import jobs

    lake, wh = os.path.join(scratch, "lake"), os.path.join(scratch, "wh")
    _lake_batch(spark, encode_events(testdata.transactions(spark, SF_SMALL)), lake, "t-0")
    jobs.main(["batch", "--lake", lake, "--warehouse", wh, "--now", "2024-01-31T00:00:00"])
    out = capsys.readouterr().out.strip().splitlines()[-1]
    assert '"inserted": 1000' in out and "mart tests passed" in out


def test_run_after_crash_before_marts_publishes_them(spark, scratch):
    """The load committed (manifest written) but the run died before the
    marts: the next run has no new batch, yet publishes the marts."""
    paths = batch.Paths(lake=os.path.join(scratch, "lake"), warehouse=os.path.join(scratch, "wh"))
    _lake_batch(spark, encode_events(testdata.transactions(spark, SF_SMALL)), paths.lake, "t-0")
    assert batch.load_raw(spark, paths, batch.run_id(NOW1)) == (True, 1000)
    assert batch.marts_stale(spark, paths)
    r = batch.run_batch(spark, paths, NOW2)
    assert not r.loaded and "mart tests passed" in r.stages
    assert not batch.marts_stale(spark, paths)
    assert batch.read_mart(spark, paths, "dim_customers").count() > 0


def test_redelivery_and_an_id_that_returns_on_another_day(spark, scratch):
    """The id alone decides: nothing is inserted twice, and later batches still load."""
    paths = batch.Paths(lake=os.path.join(scratch, "lake"), warehouse=os.path.join(scratch, "wh"))
    tx = testdata.transactions(spark, SF_SMALL)
    _lake_batch(spark, encode_events(tx), paths.lake, "t-0")
    assert batch.run_batch(spark, paths, NOW1).inserted == 1000
    moved = tx.limit(20).withColumn("timestamp", F.lit("2024-02-01T00:00:00.000000+00:00"))
    fresh = tx.limit(5).withColumn("transaction_id", F.concat(F.lit("new_"), "transaction_id"))
    _lake_batch(spark, encode_events(tx), paths.lake, "t-1")  # everything again
    _lake_batch(spark, encode_events(moved), paths.lake, "t-2")
    _lake_batch(spark, encode_events(fresh), paths.lake, "t-3")
    r = batch.run_batch(spark, paths, NOW2)
    assert r.loaded and r.inserted == 5
    raw = spark.read.parquet(paths.raw)
    assert raw.count() == raw.select("transaction_id").distinct().count() == 1005
    assert batch.read_staged(spark, paths).count() == registry.stg(spark, SF_SMALL).count() + registry.stg(spark, SF_SMALL).join(
        tx.limit(5).select("transaction_id"), "transaction_id"
    ).count()


def test_only_days_that_gain_rows_are_recomputed(spark, scratch):
    """Every earlier message comes again beside one new day: that day alone is recomputed, and the marts are those of all rows."""
    paths = batch.Paths(lake=os.path.join(scratch, "lake"), warehouse=os.path.join(scratch, "wh"))
    events = testdata.transactions(spark, SF_SMALL)
    late = F.col("timestamp") >= "2024-01-30"
    _lake_batch(spark, encode_events(events.filter(~late)), paths.lake, "t-0")
    batch.run_batch(spark, paths, NOW1)
    _lake_batch(spark, encode_events(events), paths.lake, "t-1")
    r = batch.run_batch(spark, paths, NOW2)
    assert r.inserted == events.filter(late).count() > 0
    for what in ("day groups", "day states", "daily rollup"):
        assert f"{what} recomputed for 1 days" in r.stages
    assert spark.read.parquet(paths.raw).count() == events.count()
    expect = registry.layers(registry.stg(spark, SF_SMALL), NOW2)
    for name in ("dim_customers", "fct_daily_revenue"):
        got, want = batch.read_mart(spark, paths, name), expect[name]
        assert got.count() == want.count() and got.select(*want.columns).exceptAll(want).count() == 0


def test_half_published_batch_is_loaded_once_it_is_whole(spark, scratch):
    """A crash between two leaf folders leaves no marker: the batch waits, the replay completes it, no row is lost."""
    from quayside.sources import lake

    paths = batch.Paths(lake=os.path.join(scratch, "lake"), warehouse=os.path.join(scratch, "wh"))
    valid, _ = split_valid_invalid(parse_transactions(encode_events(testdata.transactions(spark, SF_SMALL))))
    first_day = valid.filter(F.to_date("event_timestamp") == F.lit("2024-01-01"))
    lake._write_leaves(first_day.withColumn("batch_key", F.lit("s-0")), paths.lake, "parquet")
    assert not batch.run_batch(spark, paths, NOW1).loaded
    write_lake_batch(valid, paths.lake, "s-0")  # the replay
    assert batch.run_batch(spark, paths, NOW2).inserted == 1000
    assert spark.read.parquet(paths.raw).count() == 1000


def test_refused_load_leaves_tables_as_they_were(spark, scratch):
    paths = batch.Paths(lake=os.path.join(scratch, "lake"), warehouse=os.path.join(scratch, "wh"))
    tx = encode_events(testdata.transactions(spark, SF_SMALL))
    _lake_batch(spark, tx, paths.lake, "t-0")
    batch.run_batch(spark, paths, NOW1)
    _lake_batch(spark, testdata.wire_messages(spark, SF_SMALL).withColumn("value", F.replace("value", F.lit('"txn_'), F.lit('"bad_'))), paths.lake, "t-1")
    with pytest.raises(quality.DataQualityError):
        batch.run_batch(spark, paths, NOW2, bad_rows="refuse")
    assert spark.read.parquet(paths.raw).count() == 1000


def test_bad_rows_are_set_aside_and_later_batches_load(spark, scratch):
    """One unparsable time keeps its own row out, nothing else; a corrected message of the id is taken."""
    paths = batch.Paths(lake=os.path.join(scratch, "lake"), warehouse=os.path.join(scratch, "wh"))
    tx = testdata.transactions(spark, SF_SMALL)
    bad = tx.limit(3).withColumn("timestamp", F.lit("garbage"))
    _lake_batch(spark, encode_events(tx.join(bad.select("transaction_id"), "transaction_id", "left_anti").unionByName(bad)), paths.lake, "t-0")
    r = batch.run_batch(spark, paths, NOW1)
    assert r.inserted == 1000 and "quarantined 3 rows" in r.stages
    n = registry.stg(spark, SF_SMALL).count()
    held = batch.quarantined(spark, paths)
    assert [r.reasons for r in held.collect()] == [["not_null:transaction_date"]] * 3
    ids = {r.transaction_id for r in held.collect()}
    assert batch.read_staged(spark, paths).count() == n - 3
    # the bad rows again, a clean batch, and the corrected rows
    _lake_batch(spark, encode_events(bad), paths.lake, "t-1")
    fresh = tx.filter("status = 'success'").limit(5).withColumn("transaction_id", F.concat(F.lit("new_"), "transaction_id"))
    _lake_batch(spark, encode_events(fresh.unionByName(tx.filter(F.col("transaction_id").isin(ids)))), paths.lake, "t-2")
    r = batch.run_batch(spark, paths, NOW2)
    assert r.inserted == 5 and "mart tests passed" in r.stages and not any("quarantined" in x for x in r.stages)
    assert batch.quarantined(spark, paths).count() == 3
    assert batch.read_staged(spark, paths).count() == n + 5
    full = registry.marts.dim_customers(batch.read_staged(spark, paths), NOW2).drop("loaded_at")
    assert batch.read_mart(spark, paths, "dim_customers").select(full.columns).exceptAll(full).count() == 0


def test_a_marked_batch_without_its_leaves_is_refused_and_the_others_load(spark, scratch):
    import shutil

    from quayside.sources.lake import IncompleteBatch

    paths = batch.Paths(lake=os.path.join(scratch, "lake"), warehouse=os.path.join(scratch, "wh"))
    tx = testdata.transactions(spark, SF_SMALL)
    _lake_batch(spark, encode_events(tx.filter("transaction_id < 'txn_000000000500'")), paths.lake, "t-0")
    whole = encode_events(tx.filter("transaction_id >= 'txn_000000000500'"))
    _lake_batch(spark, whole, paths.lake, "t-1")
    leaf = next(d for d, _, _ in os.walk(paths.lake) if d.endswith("batch_key=t-1") and "_complete" not in d)
    shutil.move(leaf, os.path.join(scratch, "elsewhere"))
    for _ in range(2):
        with pytest.raises(IncompleteBatch, match="t-1"):
            batch.run_batch(spark, paths, NOW1)
        assert spark.read.parquet(paths.raw).count() == 500
    _lake_batch(spark, whole, paths.lake, "t-1")  # published anew
    assert batch.run_batch(spark, paths, NOW2).loaded
    assert spark.read.parquet(paths.raw).count() == 1000


def test_only_new_markers_of_very_many_are_taken(spark, scratch):
    """Ten thousand markers, then three more: the second call gets the three, without a look at the lake's folders."""
    from quayside.sources import lake

    path, checkpoint = os.path.join(scratch, "lake"), os.path.join(scratch, "discovery")
    first = spark.range(10_000).selectExpr("array('year=2024/month=1/day=1') as leaves", "1L as n_rows", "concat('s-', id) as batch_key")
    # one file, as far as the stream is concerned a marker is a row
    for part in range(10):
        first.filter(f"pmod(hash(batch_key), 10) = {part}").coalesce(1).write.mode("append").parquet(lake.markers_path(path))
    calls = []

    def load(keys, folders):
        calls.append((keys, folders))

    real, lake.existing = lake.existing, lambda spark, paths: paths
    try:
        lake.each_new_batch(spark, path, checkpoint, load)
        assert sum(len(k) for k, _ in calls) == 10_000
        calls.clear()
        lake.each_new_batch(spark, path, checkpoint, load)
        assert calls == []
        first.limit(3).withColumn("batch_key", F.concat(F.lit("new-"), "batch_key")).coalesce(1).write.mode("append").parquet(lake.markers_path(path))
        lake.each_new_batch(spark, path, checkpoint, load)
        assert [len(k) for k, _ in calls] == [3]
    finally:
        lake.existing = real


def test_earlier_now_is_refused_before_any_write(spark, scratch):
    paths = batch.Paths(lake=os.path.join(scratch, "lake"), warehouse=os.path.join(scratch, "wh"))
    tx = testdata.transactions(spark, SF_SMALL)
    _lake_batch(spark, encode_events(tx), paths.lake, "t-0")
    batch.run_batch(spark, paths, NOW1)
    _lake_batch(spark, encode_events(tx.limit(1).withColumn("transaction_id", F.lit("late"))), paths.lake, "t-1")
    with pytest.raises(ValueError, match="earlier"):
        batch.run_batch(spark, paths, dt.datetime(2024, 1, 20))
    assert spark.read.parquet(paths.raw).count() == 1000
    assert batch.run_batch(spark, paths, NOW2).inserted == 1


def test_warehouse_queries_equal_registry_queries(spark, scratch):
    """The named queries answered from the maintained warehouse (marts and
    the day states) equal the same queries over freshly built
    layers."""
    from oracle_compare import _key, _norm

    from quayside.plans import queries as Q

    paths = batch.Paths(lake=os.path.join(scratch, "lake"), warehouse=os.path.join(scratch, "wh"))
    _lake_batch(spark, encode_events(testdata.transactions(spark, SF_SMALL)), paths.lake, "t-0")
    batch.run_batch(spark, paths, NOW1)
    layers = registry.layers(registry.stg(spark, SF_SMALL), NOW1)
    inputs = {"fct": layers["fct_transactions"], "dim": layers["dim_customers"], "daily": layers["fct_daily_revenue"]}
    as_of = registry.AS_OF

    def rows(df):
        df = registry.present(df)
        cols = sorted(df.columns)
        return sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=_key)

    inputs |= {"state": inputs["fct"], "candidates": inputs["fct"]}
    for name, (source, dated, settable) in batch._QUERY_INPUTS.items():
        data = inputs[source]
        for given in ({}, *({p: 7} for p in settable)):
            if name == "d2b_daily_total":
                expected = Q.d2b_daily_total(Q.d2_revenue_trend(data, as_of, **given))
            else:
                fn = getattr(Q, name)
                expected = fn(data, as_of, **given) if dated else fn(data, **given)
            served = batch.warehouse_query(spark, paths, name, as_of, **given)
            assert rows(served) == rows(expected), (name, given)
            if source in ("state", "daily"):
                plan = spark._jvm.PythonSQLUtils.explainString(served._jdf.queryExecution(), "simple")
                assert "Join" not in plan and "stg_transactions" not in plan, (name, plan)
    with pytest.raises(ValueError):
        batch.warehouse_query(spark, paths, "q1_revenue_today", as_of, days=3)
