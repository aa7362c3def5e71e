"""Stream ingest on a file source: availableNow run, lake + dead letters,
and replay of a batch leaving the lake unchanged."""

from __future__ import annotations

import os

from conftest import SF_SMALL
from pyspark.sql import functions as F

from quayside.operators.parse import parse_transactions, split_valid_invalid
from quayside.sources import testdata
from quayside.sources.lake import read_lake
from quayside.streaming.ingest import ingest_batch, message_stream, run_ingest


def _write_messages(df, path):
    df.select("value").coalesce(1).write.text(path)


def test_ingest_two_files_then_replay(spark, scratch):
    msgs = testdata.wire_messages(spark, SF_SMALL).cache()
    src = os.path.join(scratch, "bus")
    _write_messages(msgs, os.path.join(src, "part1"))
    _write_messages(testdata.redelivered(msgs), os.path.join(src, "part2"))
    lake, dlq, ckpt = (os.path.join(scratch, d) for d in ("lake", "dlq", "ckpt"))

    stream = message_stream(spark, "text", os.path.join(src, "*"), max_files_per_trigger=1)
    q = run_ingest(spark, stream, lake, ckpt, "s1", dlq_path=dlq, trigger={"availableNow": True})
    q.awaitTermination(300)
    assert q.exception() is None

    valid, invalid = split_valid_invalid(parse_transactions(msgs))
    re_valid, re_invalid = split_valid_invalid(parse_transactions(testdata.redelivered(msgs)))
    lake_df = read_lake(spark, lake)
    assert lake_df.count() == valid.count() + re_valid.count()
    assert "year" not in lake_df.columns and "hour" in lake_df.columns
    n_dlq = spark.read.parquet(dlq).count()
    assert n_dlq == invalid.count() + re_invalid.count()
    batches = {r[0] for r in spark.read.parquet(lake).select("batch_key").distinct().collect()}
    assert batches == {"s1-0", "s1-1"}

    # Replay batch 0 (as after a crash before the commit): nothing doubles.
    before = lake_df.count()
    ingest_batch(parse_transactions(msgs), 0, lake, "s1", dlq_path=dlq)
    assert read_lake(spark, lake).count() == before
    assert spark.read.parquet(dlq).count() == n_dlq

    # Date partitions prune: one day's rows are read from that day's folders.
    day = spark.read.parquet(lake).filter((F.col("year") == 2024) & (F.col("month") == 1) & (F.col("day") == 5))
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan
    msgs.unpersist()


def test_restart_from_checkpoint_reads_only_new_files(spark, scratch):
    msgs = testdata.wire_messages(spark, SF_SMALL).cache()
    src = os.path.join(scratch, "bus")
    lake, ckpt = os.path.join(scratch, "lake"), os.path.join(scratch, "ckpt")
    early = msgs.filter(F.col("sent_at") < F.lit("2024-01-15"))
    late = msgs.filter(F.col("sent_at") >= F.lit("2024-01-15"))
    _write_messages(early, os.path.join(src, "a"))

    def run():
        stream = message_stream(spark, "text", os.path.join(src, "*"))
        q = run_ingest(spark, stream, lake, ckpt, "s9", dlq_path=os.path.join(scratch, "dlq"), trigger={"availableNow": True})
        q.awaitTermination(300)
        assert q.exception() is None

    run()
    n_early = read_lake(spark, lake).count()
    assert n_early == split_valid_invalid(parse_transactions(early))[0].count()
    run()  # nothing new: no new batch
    assert read_lake(spark, lake).count() == n_early
    _write_messages(late, os.path.join(src, "b"))
    run()  # the restarted query picks up only the new file
    assert read_lake(spark, lake).count() == split_valid_invalid(parse_transactions(msgs))[0].count()
    keys = {r[0] for r in spark.read.parquet(lake).select("batch_key").distinct().collect()}
    assert keys == {"s9-0", "s9-1"}
    msgs.unpersist()


def test_new_checkpoint_with_new_sink_id_keeps_old_batches(spark, scratch):
    """Batch ids restart at 0 with a new checkpoint; the sink id scopes the
    lake leaves, so the second query does not overwrite the first one's."""
    msgs = testdata.wire_messages(spark, SF_SMALL)
    src_a, src_b = os.path.join(scratch, "a"), os.path.join(scratch, "b")
    _write_messages(msgs.filter(F.col("sent_at") < F.lit("2024-01-15")), src_a)
    _write_messages(msgs.filter(F.col("sent_at") >= F.lit("2024-01-15")), src_b)
    lake = os.path.join(scratch, "lake")
    for src, sink in ((src_a, "first"), (src_b, "second")):
        q = run_ingest(
            spark,
            message_stream(spark, "text", src),
            lake,
            os.path.join(scratch, f"ckpt-{sink}"),
            sink,
            dlq_path=os.path.join(scratch, "dlq"),
            trigger={"availableNow": True},
        )
        q.awaitTermination(300)
    keys = {r[0] for r in spark.read.parquet(lake).select("batch_key").distinct().collect()}
    assert keys == {"first-0", "second-0"}
    assert read_lake(spark, lake).count() == split_valid_invalid(parse_transactions(msgs))[0].count()


def test_jobs_cli_ingest(spark, scratch):
    from quayside import jobs

    msgs = testdata.wire_messages(spark, SF_SMALL)
    src = os.path.join(scratch, "bus")
    _write_messages(msgs, src)
    lake, dlq = os.path.join(scratch, "lake"), os.path.join(scratch, "dlq")
    jobs.main(
        ["ingest", "--format", "text", "--path", src, "--lake", lake, "--dlq", dlq,
         "--checkpoint", os.path.join(scratch, "ckpt"), "--sink-id", "cli", "--trigger", "available-now"]
    )
    valid, invalid = split_valid_invalid(parse_transactions(msgs))
    assert read_lake(spark, lake).count() == valid.count()
    assert spark.read.parquet(dlq).count() == invalid.count()


def test_the_input_of_a_batch_is_evaluated_once(spark, scratch):
    """Lake write, marker and dead letters together read each message once."""
    values = [r.value for r in testdata.wire_messages(spark, SF_SMALL).select("value").collect()]
    read = spark.sparkContext.accumulator(0)

    def count(row):
        read.add(1)
        return row

    rows = spark.sparkContext.parallelize([(v,) for v in values], 3).map(count)
    batch = parse_transactions(spark.createDataFrame(rows, "value string"))
    done = ingest_batch(batch, 0, os.path.join(scratch, "lake"), "s", dlq_path=os.path.join(scratch, "dlq"))
    assert read.value == len(values)
    assert done["has_invalid"] == 1 and spark.read.parquet(os.path.join(scratch, "dlq")).count() > 0
    marker = spark.read.parquet(os.path.join(scratch, "lake", "_complete")).first()
    lake = read_lake(spark, os.path.join(scratch, "lake"))
    assert marker.n_rows == lake.count() and len(marker.leaves) == done["leaves"]
    days = lake.select(F.to_date("event_timestamp")).distinct().count()
    assert len(marker.leaves) == days  # rows without a time are one leaf more where there are any


def test_a_batch_without_valid_or_invalid_rows(spark, scratch):
    clean = parse_transactions(spark.createDataFrame([('{"transaction_id": "t", "customer_id": "c", "amount": 1.0}',)], "value string"))
    assert ingest_batch(clean, 0, os.path.join(scratch, "lake"), "s", dlq_path=os.path.join(scratch, "dlq")) == {"batch_id": 0, "has_invalid": 0, "leaves": 1}
    assert not os.path.exists(os.path.join(scratch, "dlq"))
    broken = parse_transactions(spark.createDataFrame([("{",), (None,)], "value string"))
    done = ingest_batch(broken, 1, os.path.join(scratch, "lake"), "s", dlq_path=os.path.join(scratch, "dlq"))
    assert done == {"batch_id": 1, "has_invalid": 1, "leaves": 0} and spark.read.parquet(os.path.join(scratch, "dlq")).count() == 2
    empty = ingest_batch(broken.limit(0), 2, os.path.join(scratch, "lake"), "s", dlq_path=os.path.join(scratch, "dlq"))
    assert empty == {"batch_id": 2, "has_invalid": 0, "leaves": 0}
