"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator or query, each reading the test tables whole.

Results are presented with decimals as doubles (money is exact decimal
inside; the cast happens last, on exact values).
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from quayside.operators import contract, marts, merge, parse, quality, snapshot, staging, states
from quayside.plans import batch, served
from quayside.plans import queries as Q
from quayside.schema import EVENT_FIELDS
from quayside.session import materialize, scratch_path
from quayside.sources import lake, testdata
from quayside.streaming import ingest

# Fixed run parameters of the checks: the last event date, the load time
# stamped on mart rows, a day without data, and four snapshot runs.
AS_OF = dt.date(2024, 1, 30)
NOW = dt.datetime(2024, 1, 31, 0, 0, 0)
EMPTY_DAY = dt.date(2024, 2, 29)
SNAPSHOT_RUNS = [dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 20), dt.datetime(2024, 1, 31), dt.datetime(2024, 2, 1)]
# What the runs see (FIXTURES.md section 5): later countries join in run 2, one leaves,
# and the feed of some countries stands still; run 3 sees what run 2 saw, and the last run all events.
_SEEN_FIRST = "customer_country < 'NATION_3' AND event_timestamp < TIMESTAMP '2024-01-10 00:00:00'"
_SEEN_LATER = (
    "customer_country >= 'NATION_1' AND event_timestamp < CASE WHEN customer_country < 'NATION_2' "
    "THEN TIMESTAMP '2024-01-10 00:00:00' ELSE TIMESTAMP '2024-01-20 00:00:00' END"
)
SNAPSHOT_INPUTS = [_SEEN_FIRST, _SEEN_LATER, _SEEN_LATER, "true"]
SNAPSHOT_CHECK_COLS = ["customer_segment", "total_spend", "total_transactions", "failure_rate_pct"]
# Second load of the two-load merge scenario: messages sent from this time.
SECOND_LOAD_FROM = dt.datetime(2024, 1, 16)


def present(df: DataFrame) -> DataFrame:
    """Cast decimal columns to double for comparison with the oracle."""
    return df.select(
        *[F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType) else F.col(f.name) for f in df.schema.fields]
    )


# --- layer builders -------------------------------------------------------


def raw(spark: SparkSession, sf: str) -> DataFrame:
    return testdata.transactions(spark, sf)


def stg(spark: SparkSession, sf: str) -> DataFrame:
    return staging.stg_transactions(raw(spark, sf))


def layers(stg_df: DataFrame, now: dt.datetime = NOW, written: bool = False) -> dict[str, DataFrame]:
    """The four layers over one staging frame. ``written=True`` writes each
    layer once (as the batch pipeline does) so that checks reading every
    layer several times do not recompute the chain below it."""
    keep = (lambda df, name: materialize(df, name)) if written else (lambda df, name: df)
    stg_df = keep(stg_df, "stg")
    dim = keep(marts.dim_customers(stg_df, now), "dim")
    fct = keep(marts.fct_transactions(stg_df, dim, now), "fct")
    daily = keep(marts.fct_daily_revenue(fct, now), "daily")
    return {"stg_transactions": stg_df, "dim_customers": dim, "fct_transactions": fct, "fct_daily_revenue": daily}


def register_views(built: dict[str, DataFrame]) -> None:
    """Expose the layers as temporary views of the same names, for SQL."""
    for name, df in built.items():
        df.createOrReplaceTempView(name)


def dim(spark: SparkSession, sf: str) -> DataFrame:
    return marts.dim_customers(stg(spark, sf), NOW)


def fct(spark: SparkSession, sf: str) -> DataFrame:
    """The enriched fact. The dimension is written first, as the batch pipeline does: both sides of the
    join are then plain shuffles, and a customer with a large share of the rows is split over tasks."""
    rows = stg(spark, sf)
    return marts.fct_transactions(rows, materialize(marts.dim_customers(rows, NOW), "dim"), NOW)


def flagged(spark: SparkSession, sf: str) -> DataFrame:
    """The fact's rows for queries that read no column of the customer: no dimension, no join."""
    return marts.with_amount_flag(stg(spark, sf))


def daily(spark: SparkSession, sf: str) -> DataFrame:
    return marts.fct_daily_revenue(flagged(spark, sf), NOW)


def measures(spark: SparkSession, sf: str) -> DataFrame:
    """The day measures of all events, written as the batch job keeps them."""
    return materialize(states.day_measures(stg(spark, sf)), "measures")


def _q6_served(spark: SparkSession, sf: str) -> DataFrame:
    candidates = materialize(states.day_candidates(stg(spark, sf)), "candidates")
    return served.q6_flagged(candidates, dim(spark, sf), lambda: fct(spark, sf))


def _q8_served(spark: SparkSession, sf: str) -> DataFrame:
    customers = states.day_customers(marts.customer_day_groups(stg(spark, sf)))
    return served.q8_daily_trend_30d(measures(spark, sf), customers, AS_OF)


def parsed(spark: SparkSession, sf: str) -> DataFrame:
    return parse.parse_transactions(testdata.dealt(testdata.wire_messages(spark, sf)))


def stream_valid(spark: SparkSession, sf: str) -> DataFrame:
    return parse.split_valid_invalid(parsed(spark, sf))[0]


def _dlq(spark: SparkSession, sf: str) -> DataFrame:
    _, invalid = parse.split_valid_invalid(parsed(spark, sf))
    env = parse.read_dlq_payload(parse.build_dlq_payload(invalid, NOW))
    return env.select(
        "error_reason",
        "error_timestamp",
        F.get_json_object("raw_value", "$.transaction_id").alias("raw_transaction_id"),
    )


def _encode_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    out = parse.parse_transactions(testdata.dealt(parse.encode_events(raw(spark, sf))))
    return out.drop("raw_value", "year", "month", "day", "hour")


def _delivered(spark: SparkSession, sf: str) -> DataFrame:
    """Every message parsed once (with its id and send time), written."""
    msgs = testdata.dealt(testdata.wire_messages(spark, sf))
    return materialize(parse.parse_transactions(msgs, keep=["event_id", "sent_at"]), "delivered")


def _valid(parsed_msgs: DataFrame) -> DataFrame:
    return parse.split_valid_invalid(parsed_msgs)[0].drop("event_id", "sent_at")


def _folder(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, "registered", f"{name}-{uuid.uuid4().hex}")


def _lake_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """The stream's valid rows as two micro-batches, one of them written again, read back through the lake's root."""
    path = _folder(spark, "lake")
    valid = materialize(stream_valid(spark, sf), "valid")
    early = F.coalesce(F.col("event_timestamp") < F.lit(SECOND_LOAD_FROM), F.lit(False))
    for key, rows in (("s-0", valid.filter(early)), ("s-1", valid.filter(~early)), ("s-0", valid.filter(early))):
        lake.write_lake_batch(rows, path, key)
    return lake.read_lake(spark, path).select(*EVENT_FIELDS, "event_timestamp", "hour")


def _dlq_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = _folder(spark, "dlq")
    _, invalid = parse.split_valid_invalid(parsed(spark, sf))
    lake.write_dlq_batch(parse.build_dlq_payload(invalid, NOW), "s-0", path)
    back = parse.read_dlq_payload(spark.read.parquet(path))
    return back.select("error_reason", "error_timestamp", F.get_json_object("raw_value", "$.transaction_id").alias("raw_transaction_id"))


def _batch_loads(spark: SparkSession, sf: str) -> batch.Paths:
    """Two lake batches, the second with redelivered copies, each loaded by a batch run."""
    folder = _folder(spark, "batch")
    paths = batch.Paths(lake=f"{folder}/lake", warehouse=f"{folder}/warehouse")
    events = testdata.transactions(spark, sf, with_event_id=True)
    first = events.filter(F.col("sent_at") < F.lit(SECOND_LOAD_FROM))
    second = events.filter(F.col("sent_at") >= F.lit(SECOND_LOAD_FROM)).unionByName(testdata.redelivered(events))
    for key, rows, now in (("s-0", first, SECOND_LOAD_FROM), ("s-1", second, NOW)):
        messages = testdata.dealt(parse.encode_events(rows.drop("event_id", "sent_at")))
        lake.write_lake_batch(parse.split_valid_invalid(parse.parse_transactions(messages))[0], paths.lake, key)
        batch.run_batch(spark, paths, now)
    return paths


def _batch_two_loads(spark: SparkSession, sf: str) -> DataFrame:
    """The raw table after both runs."""
    return spark.read.parquet(_batch_loads(spark, sf).raw).select(*EVENT_FIELDS, "event_timestamp", "hour")


def _batch_history(spark: SparkSession, sf: str) -> DataFrame:
    """The customers' history after both runs: the end of the chain from lake over staging, day groups and dimension to snapshot."""
    return batch.snapshot_history(spark, _batch_loads(spark, sf))[0]


def _ingest_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The messages as files, read by the ingest stream until none is left: the lake it wrote."""
    folder = _folder(spark, "ingest")
    testdata.dealt(testdata.wire_messages(spark, sf)).select("key", "value").write.parquet(f"{folder}/bus")
    messages = ingest.message_stream(spark, "parquet", f"{folder}/bus")
    query = ingest.run_ingest(
        spark, messages, f"{folder}/lake", f"{folder}/checkpoint", "registered", dlq_path=f"{folder}/dlq", trigger={"availableNow": True}
    )
    query.awaitTermination()
    return lake.read_lake(spark, f"{folder}/lake").select(*EVENT_FIELDS, "event_timestamp", "hour")


def _contract_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The row-level report, counted by rule."""
    rows = contract.contract_violation_rows(parsed(spark, sf))
    return rows.groupBy("field", "rule").agg(F.count(F.lit(1)).alias("violations"))


def _dedupe(spark: SparkSession, sf: str) -> DataFrame:
    """One load holding every message plus the redelivered copies."""
    msgs = _delivered(spark, sf)
    both = msgs.unionByName(testdata.redelivered(msgs))
    return merge.dedupe_by_key(_valid(both), "transaction_id", ["event_timestamp"])


def _insert_if_absent(spark: SparkSession, sf: str) -> DataFrame:
    """Load 1: messages sent before the cut. Load 2: the rest plus the
    redelivered copies (some of which load 1 already holds)."""
    msgs = _delivered(spark, sf)
    first = msgs.filter(F.col("sent_at") < F.lit(SECOND_LOAD_FROM))
    second = msgs.filter(F.col("sent_at") >= F.lit(SECOND_LOAD_FROM)).unionByName(testdata.redelivered(msgs))
    target = _valid(first)
    load = merge.dedupe_by_key(_valid(second), "transaction_id", ["event_timestamp"])
    return target.unionByName(merge.insert_if_absent(target, load, "transaction_id"))


def _snapshot_dims(spark: SparkSession, sf: str) -> list[tuple[dt.datetime, DataFrame]]:
    s = materialize(stg(spark, sf), "stg")
    runs = zip(SNAPSHOT_RUNS, SNAPSHOT_INPUTS, strict=True)
    return [(now, materialize(marts.dim_customers(s.filter(seen), now), "snapshot-input")) for now, seen in runs]


def _scd2_history(spark: SparkSession, sf: str) -> DataFrame:
    history = None
    for now, current in _snapshot_dims(spark, sf):
        history = snapshot.snapshot_scd2(history, current, "customer_id", SNAPSHOT_CHECK_COLS, now)
    return history


def _scd2_log(spark: SparkSession, sf: str) -> DataFrame:
    """The same history kept as a log: each run writes the versions it opens, and no other row."""
    log = None
    for now, current in _snapshot_dims(spark, sf):
        opened = materialize(snapshot.opened_versions(log, current, "customer_id", SNAPSHOT_CHECK_COLS, now), "opened")
        log = opened if log is None else log.unionByName(opened)
    return snapshot.history_of(log, "customer_id")


def _scd2_changes(spark: SparkSession, sf: str) -> DataFrame:
    """The change types of the second run, which sees other customers, and of the last one, which sees all events."""
    history, changes = None, []
    for run, (now, current) in enumerate(_snapshot_dims(spark, sf), 1):
        if run in (2, len(SNAPSHOT_RUNS)):
            found = snapshot.snapshot_changes(history, current, "customer_id", SNAPSHOT_CHECK_COLS)
            changes.append(found.withColumn("run", F.lit(run)))
        history = materialize(snapshot.snapshot_scd2(history, current, "customer_id", SNAPSHOT_CHECK_COLS, now), "history")
    return changes[0].unionByName(changes[1])


def _dq_stream(spark: SparkSession, sf: str) -> DataFrame:
    return quality.dq_report(layers(staging.stg_transactions(stream_valid(spark, sf)), written=True))


def _dq_broken(spark: SparkSession, sf: str) -> DataFrame:
    """Layers with known defects: failed rows twice, a status and a segment outside the accepted values, and
    customers without a spend."""
    s = stg(spark, sf)
    s = s.withColumn("status", F.when(F.col("status") == "pending", F.lit("held")).otherwise(F.col("status")))
    built = layers(s.unionByName(s.filter("status = 'failed'")), written=True)
    d = built["dim_customers"]
    gold = F.when(F.col("customer_segment") == "VIP", F.lit("Gold")).otherwise(F.col("customer_segment"))
    spend = F.when(F.col("customer_segment") != "Casual", F.col("total_spend"))
    built["dim_customers"] = d.withColumns({"customer_segment": gold, "total_spend": spend})
    return quality.dq_report(built)


Query = Callable[[SparkSession, str], DataFrame]


def _prepared(fn: Query) -> Query:
    """Apply the session settings the library's plans rely on, then build."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        prepare(spark)
        return fn(spark, sf)

    run.__name__ = getattr(fn, "__name__", "query")
    return run


def prepare(spark: SparkSession) -> None:
    """The session setting every plan here needs: dates and hours of event times are defined in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


_QUERIES: dict[str, Query] = {
    # marts
    "stg_transactions": lambda s, sf: present(stg(s, sf)),
    "dim_customers": lambda s, sf: present(dim(s, sf)),
    "dim_customers_from_day_groups": lambda s, sf: present(
        marts.dim_from_groups(materialize(marts.customer_day_groups(stg(s, sf)), "groups"), NOW)
    ),
    "fct_transactions": lambda s, sf: present(fct(s, sf)),
    "fct_daily_revenue": lambda s, sf: present(daily(s, sf)),
    # analytics queries
    "q1_revenue_today": lambda s, sf: present(Q.q1_revenue_today(flagged(s, sf), AS_OF)),
    "q2_category_7d": lambda s, sf: present(Q.q2_category_7d(flagged(s, sf), AS_OF)),
    "q3_top_customers": lambda s, sf: present(Q.q3_top_customers(dim(s, sf))),
    "q4_hourly_today": lambda s, sf: present(Q.q4_hourly_today(flagged(s, sf), AS_OF)),
    "q5_failure_by_payment_30d": lambda s, sf: present(Q.q5_failure_by_payment_30d(flagged(s, sf), AS_OF)),
    "q6_flagged": lambda s, sf: present(Q.q6_flagged(fct(s, sf))),
    "q7_segments": lambda s, sf: present(Q.q7_segments(dim(s, sf))),
    "q8_daily_trend_30d": lambda s, sf: present(Q.q8_daily_trend_30d(flagged(s, sf), AS_OF)),
    # dashboard queries
    "d1_kpis_today": lambda s, sf: present(Q.d1_kpis_today(daily(s, sf), AS_OF)),
    "d1_kpis_empty_day": lambda s, sf: present(Q.d1_kpis_today(daily(s, sf), EMPTY_DAY)),
    "d2_revenue_trend": lambda s, sf: present(Q.d2_revenue_trend(daily(s, sf), AS_OF, 30)),
    "d2b_daily_total": lambda s, sf: present(Q.d2b_daily_total(Q.d2_revenue_trend(daily(s, sf), AS_OF, 30))),
    "d3_category_breakdown": lambda s, sf: present(Q.d3_category_breakdown(daily(s, sf), AS_OF, 30)),
    "d4_top_customers": lambda s, sf: present(Q.d4_top_customers(dim(s, sf))),
    "d5_payment_failure": lambda s, sf: present(Q.d5_payment_failure(flagged(s, sf), AS_OF)),
    "d6_segments": lambda s, sf: present(Q.d6_segments(dim(s, sf))),
    # the windowed queries from day states
    "q1_revenue_today_served": lambda s, sf: present(served.q1_revenue_today(measures(s, sf), AS_OF)),
    "q2_category_7d_served": lambda s, sf: present(served.q2_category_7d(measures(s, sf), AS_OF)),
    "q4_hourly_today_served": lambda s, sf: present(served.q4_hourly_today(measures(s, sf), AS_OF)),
    "q5_failure_by_payment_30d_served": lambda s, sf: present(served.q5_failure_by_payment_30d(measures(s, sf), AS_OF)),
    "q6_flagged_served": lambda s, sf: present(_q6_served(s, sf)),
    "q8_daily_trend_30d_served": lambda s, sf: present(_q8_served(s, sf)),
    "d5_payment_failure_served": lambda s, sf: present(served.d5_payment_failure(measures(s, sf), AS_OF)),
    # stream operators
    "encode_roundtrip": _encode_roundtrip,
    "parse_transactions": lambda s, sf: parsed(s, sf).drop("raw_value"),
    "split_valid": stream_valid,
    "split_invalid": lambda s, sf: parse.split_valid_invalid(parsed(s, sf))[1].drop("raw_value"),
    "dlq_payload": _dlq,
    "contract_violation_rows": _contract_rows,
    "lake_roundtrip": _lake_roundtrip,
    "dlq_roundtrip": _dlq_roundtrip,
    "batch_two_loads": _batch_two_loads,
    "batch_history": lambda s, sf: present(_batch_history(s, sf)),
    "ingest_stream": _ingest_stream,
    "contract_violations": lambda s, sf: contract.contract_violations(parse.parse_transactions(testdata.wire_messages(s, sf))),
    "stg_from_stream": lambda s, sf: present(staging.stg_transactions(stream_valid(s, sf))),
    # warehouse load
    "dedupe_by_key": _dedupe,
    "insert_if_absent": _insert_if_absent,
    # history and data tests
    "scd2_history": lambda s, sf: present(_scd2_history(s, sf)),
    "scd2_history_from_log": lambda s, sf: present(_scd2_log(s, sf)),
    "scd2_changes": _scd2_changes,
    "dq_report": lambda s, sf: quality.dq_report(layers(stg(s, sf), written=True)),
    "dq_report_stream": _dq_stream,
    "dq_report_broken": _dq_broken,
}

REGISTRY: dict[str, Query] = {name: _prepared(fn) for name, fn in _QUERIES.items()}
