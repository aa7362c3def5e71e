"""The hourly batch as one Spark application with gates.

new lake batches -> de-duplicate -> insert-only merge into the raw table ->
staging rows, tested, merged into the staged table -> day groups of the
touched days -> customer dimension -> daily rollup -> mart tests -> type-2
snapshot. A failing test raises and stops every later stage, like a failed
task in the reference's DAG.

Raw and staged transactions are append-only tables fed incrementally; the
dimension and the daily rollup are rebuilt by aggregation and written as
new versions (readers take the newest complete one, so a refresh never
breaks a reader and a crashed run leaves the previous version in
service); the enriched fact is the staged rows joined to the current
dimension at read time, so no run rewrites the fact. Snapshot runs store
only what they close plus the open set.
"""

from __future__ import annotations

import datetime as dt
import inspect
import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.operators import marts, merge, quality, snapshot, staging, states
from quayside.session import materialize
from quayside.sources.lake import (
    complete_versions,
    each_new_batch,
    read_lake_batches,
    read_latest,
    read_table_or_none,
    version_path,
    write_mart,
)

SNAPSHOT_CHECK_COLS = ["customer_segment", "total_spend", "total_transactions", "failure_rate_pct"]
# Storage partition of the raw table: the event's day; events whose time
# did not parse go to one fixed day, so the column is never null.
RAW_PARTITION = "event_day"
UNKNOWN_DAY = "1900-01-01"


def event_day() -> F.Column:
    return F.coalesce(F.to_date("event_timestamp"), F.to_date(F.lit(UNKNOWN_DAY))).alias(RAW_PARTITION)


@dataclass
class Paths:
    lake: str
    warehouse: str

    @property
    def raw(self) -> str:
        return os.path.join(self.warehouse, "raw_transactions")

    def mart(self, name: str) -> str:
        """Root of a mart; each refresh is a version folder below it."""
        return os.path.join(self.warehouse, "marts", name)

    @property
    def staged(self) -> str:
        """Staged transactions: the cleaned rows, append-only, stored once.
        The enriched fact is these rows joined to the current dimension."""
        return os.path.join(self.warehouse, "stg_transactions")

    @property
    def day_groups(self) -> str:
        """State of the incremental dimension, partitioned by event day."""
        return os.path.join(self.warehouse, "state", "customer_day_category")

    def day_state(self, name: str) -> str:
        """A state of :mod:`quayside.operators.states`, partitioned by event day."""
        return os.path.join(self.warehouse, "state", name)

    @property
    def pending_days(self) -> str:
        """(event_day, run): days a run's load touched."""
        return os.path.join(self.warehouse, "state", "_pending_days")

    def done(self, consumer: str) -> str:
        """Runs whose touched days ``consumer`` already reflects."""
        return os.path.join(self.warehouse, "state", f"_done_{consumer}")

    @property
    def loaded_batches(self) -> str:
        """Manifest of lake batches already merged into the raw table."""
        return os.path.join(self.warehouse, "_loaded_lake_batches")

    @property
    def discovery(self) -> str:
        """Checkpoint of the stream that finds new lake batches."""
        return os.path.join(self.warehouse, "_discovery")

    @property
    def quarantine(self) -> str:
        """Staging rows that fail a row-level test, by run."""
        return os.path.join(self.warehouse, "quarantine", "stg_transactions")

    @property
    def snapshot(self) -> str:
        return os.path.join(self.warehouse, "snapshots", "snap_customer_segments")


@dataclass
class BatchResult:
    loaded: bool
    inserted: int = 0
    stages: list[str] = field(default_factory=list)


def run_id(now: dt.datetime) -> str:
    """Version id of a run: its load time, sortable. Re-running the same
    ``now`` rewrites that run's own (unpublished or superseded) folders."""
    return now.strftime("%Y%m%dT%H%M%S%f")


def load_raw(spark: SparkSession, paths: Paths, version: str, bad_rows: str = "quarantine") -> tuple[bool, int]:
    """Lake -> raw table -> staged table (insert-only, idempotent,
    incremental): (whether anything was loaded, rows inserted into the raw table).

    Only lake batches marked complete since the last load are read (the
    reference reloads the whole lake every run; at scale that is a full lake scan and
    de-duplication per hour). A batch that is still being published has no marker
    and waits for a later run; see :func:`~quayside.sources.lake.each_new_batch`. Late
    events arrive in new batches, so they are never skipped.
    """
    if bad_rows not in ("quarantine", "refuse"):
        raise ValueError(f"bad_rows is quarantine or refuse, not {bad_rows}")
    done: list[int] = []

    def load(keys: list[str], folders: list[str]) -> None:
        if folders:
            done.append(load_batches(spark, paths, version, read_lake_batches(spark, paths.lake, folders), bad_rows))
        spark.createDataFrame([(k, version) for k in keys], "batch_key string, run string").write.mode("append").parquet(paths.loaded_batches)

    each_new_batch(spark, paths.lake, paths.discovery, load)
    return bool(done), sum(done)


def load_batches(spark: SparkSession, paths: Paths, version: str, lake: DataFrame, bad_rows: str) -> int:
    """Merge the rows of new lake batches into the raw and the staged table; the rows inserted into the raw one.

    The load is de-duplicated on ``transaction_id`` (the reference's merge would insert in-load
    duplicates), then merged insert-only, on that id alone, into the raw table, and its
    staging rows into the staged table; each merge is against its own
    target, so re-running a load after a crash at any point adds to each
    table exactly what it is missing.

    Staging rows that fail a row-level test (an id with a time that does not parse, say) go to the quarantine
    table with the tests they fail, and the rest of the load goes on; one bad row would otherwise stop this load and, as
    its batch is read again, every later one. A quarantined id is not staged, so a corrected message of that id is taken
    when it comes. With ``bad_rows="refuse"`` a failing test stops the run before anything is appended.
    """
    if not merge.load_guard(lake):
        return 0
    # The de-duplicated load (the new batches only) feeds the steps below: written once.
    load = merge.dedupe_by_key(lake, "transaction_id", ["event_timestamp"]).withColumn(RAW_PARTITION, event_day())
    load = materialize(load, "load")
    staged_rows = staging.stg_transactions(load).withColumn(RAW_PARTITION, event_day())
    staged = read_table_or_none(spark, paths.staged)
    absent = merge.insert_if_absent(staged, staged_rows, "transaction_id")
    judged = materialize(quality.with_reasons(absent, "stg_transactions"), "staged-increment")
    good = F.size("reasons") == 0
    add = judged.filter(good).drop("reasons") if bad_rows == "quarantine" else judged.drop("reasons")
    # Staging tests gate the increment before it is appended, so the staged
    # table only ever holds rows that passed: the table-wide result is the
    # increment's (see quality.increment_report). The fact's declared tests
    # are on staged columns of the same rows, so they are checked here too.
    held = staged.drop(RAW_PARTITION) if staged is not None else None
    report = quality.increment_report(add.drop(RAW_PARTITION), held, "stg_transactions")
    quality.raise_on_failures(quality.with_implied(report, "stg_transactions", "fct_transactions"))
    # Days this load adds staged rows to, recorded before anything is appended: after a
    # crash anywhere below, the re-run records what is still missing, and what
    # this run recorded stays pending. A day that only gets messages again is not touched.
    add.select(RAW_PARTITION).distinct().withColumn("run", F.lit(version)).write.mode("append").parquet(paths.pending_days)
    if bad_rows == "quarantine":
        known = read_table_or_none(spark, paths.quarantine)
        bad = materialize(merge.insert_if_absent(known, judged.filter(~good).drop(RAW_PARTITION), "transaction_id"), "quarantine-increment")
        if not bad.isEmpty():
            bad.withColumn("run", F.lit(version)).write.mode("append").partitionBy("run").parquet(paths.quarantine)
    # The load is written already; only the ids that are there (few) are written besides, not the rows again.
    raw = read_table_or_none(spark, paths.raw)
    new = load
    if raw is not None:
        there = materialize(merge.existing_keys(raw, load, "transaction_id"), "raw-existing")
        new = load.join(there, "transaction_id", "left_anti").select(*load.columns)
    inserted = new.count()
    _append(new, paths.raw, "transaction_id")
    # Sorted by the fact's cluster columns within each file: min/max
    # statistics then skip row groups for category / status predicates.
    _append(add, paths.staged, "product_category", "status", "transaction_id")
    return inserted


def quarantined(spark: SparkSession, paths: Paths, version: str | None = None) -> DataFrame | None:
    """Staging rows that were kept out, with ``reasons`` and the ``run`` that met them; of one run if given."""
    held = read_table_or_none(spark, paths.quarantine)
    return held if held is None or version is None else held.filter(F.col("run") == version)


def _append(rows: DataFrame, path: str, *cluster_by: str) -> None:
    """Ranged by day and the cluster columns, so a task writes few day folders and a hot day
    is dealt over several tasks."""
    order = [RAW_PARTITION, *cluster_by]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt.write.mode("append").partitionBy(RAW_PARTITION).parquet(path)


def pending_days(spark: SparkSession, paths: Paths, consumer: str) -> tuple[list, list[str]]:
    """(days, runs) touched by loads that ``consumer`` has not reflected.
    One row per (day, run): metadata-sized."""
    pending = read_table_or_none(spark, paths.pending_days)
    if pending is None:
        return [], []
    done = read_table_or_none(spark, paths.done(consumer))
    if done is not None:
        pending = pending.join(done, "run", "left_anti")
    rows = pending.select(RAW_PARTITION, "run").distinct().collect()
    return sorted({r[0] for r in rows}), sorted({r[1] for r in rows})


def mark_done(spark: SparkSession, paths: Paths, consumer: str, runs: list[str]) -> None:
    if runs:
        spark.createDataFrame([(r,) for r in runs], "run string").write.mode("append").parquet(paths.done(consumer))


def staged_days(spark: SparkSession, paths: Paths, days: list) -> DataFrame:
    """Staged rows of the given event days (partition-pruned read)."""
    return spark.read.parquet(paths.staged).filter(F.col(RAW_PARTITION).isin(days)).drop(RAW_PARTITION)


def update_day_groups(spark: SparkSession, paths: Paths) -> int:
    """Recompute the day groups of every day touched by a run not yet
    reflected, from that day's staged rows, and replace those day
    partitions. Recomputing whole days is idempotent, so a crash at any
    point is repaired by the next run. Returns the number of days."""
    days, runs = pending_days(spark, paths, "day_groups")
    if not days:
        return 0
    groups = marts.customer_day_groups(staged_days(spark, paths, days)).withColumn(RAW_PARTITION, event_day_of_group())
    groups.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(RAW_PARTITION).parquet(
        paths.day_groups
    )
    mark_done(spark, paths, "day_groups", runs)
    return len(days)


def update_day_states(spark: SparkSession, paths: Paths) -> int:
    """The states that windowed queries are answered from, recomputed for the days touched by runs they do not reflect
    yet. Call after :func:`update_day_groups`, whose groups give a day's customers. Returns the number of days."""
    days, runs = pending_days(spark, paths, "day_states")
    if not days:
        return 0
    rows = staged_days(spark, paths, days)
    groups = spark.read.parquet(paths.day_groups).filter(F.col(RAW_PARTITION).isin(days)).drop(RAW_PARTITION)
    fresh = {
        "day_measures": states.day_measures(rows),
        "day_customers": states.day_customers(groups),
        "day_candidates": states.day_candidates(rows),
    }
    for name, state in fresh.items():
        keyed = state.withColumn(RAW_PARTITION, event_day_of_group()).repartition(RAW_PARTITION)
        keyed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(RAW_PARTITION).parquet(paths.day_state(name))
    mark_done(spark, paths, "day_states", runs)
    return len(days)


def daily_rollup(spark: SparkSession, paths: Paths, now: dt.datetime) -> tuple[DataFrame, list[str], int]:
    """The daily rollup as a full refresh would compute it, recomputing only
    the days touched since the last published rollup: other days are
    carried over from the previous version (re-stamped with ``now``; their
    rows cannot have changed, since the rollup reads no dimension column).
    Returns (rollup, runs to mark done, days recomputed)."""
    days, runs = pending_days(spark, paths, "daily")
    previous, _ = read_latest(spark, paths.mart("fct_daily_revenue"))
    if previous is None:
        fresh = marts.fct_daily_revenue(marts.with_amount_flag(read_staged(spark, paths)), now)
        return fresh, runs, -1
    fresh = marts.fct_daily_revenue(marts.with_amount_flag(staged_days(spark, paths, days)), now)
    dates = [d for d in days if str(d) != UNKNOWN_DAY]
    unknown = len(dates) < len(days)
    touched = F.col("transaction_date").isin(dates) | (F.col("transaction_date").isNull() if unknown else F.lit(False))
    kept = previous.filter(~touched | F.col("transaction_date").isNull() & F.lit(not unknown))
    kept = kept.withColumn("loaded_at", F.lit(now).cast("timestamp")).select(*fresh.columns)
    return kept.unionByName(fresh), runs, len(days)


def event_day_of_group() -> F.Column:
    return F.coalesce(F.col("transaction_date"), F.to_date(F.lit(UNKNOWN_DAY))).alias(RAW_PARTITION)


def read_staged(spark: SparkSession, paths: Paths) -> DataFrame:
    return spark.read.parquet(paths.staged).drop(RAW_PARTITION)


def marts_stale(spark: SparkSession, paths: Paths) -> bool:
    """True when a run loaded data but did not finish publishing its marts
    or its snapshot (the last steps of a run)."""
    manifest = read_table_or_none(spark, paths.loaded_batches)
    if manifest is None:
        return False
    last_load = manifest.agg(F.max("run")).collect()[0][0]
    for root in (paths.mart("fct_daily_revenue"), paths.snapshot):
        versions = complete_versions(spark, root)
        if not versions or versions[-1] < last_load:
            return True
    return False


def read_mart(spark: SparkSession, paths: Paths, name: str) -> DataFrame | None:
    return read_latest(spark, paths.mart(name))[0]


def snapshot_log(spark: SparkSession, paths: Paths, before: str | None = None) -> tuple[DataFrame | None, str | None]:
    """The versions opened by every complete snapshot run (strictly before ``before``) and the newest such run."""
    versions = [v for v in complete_versions(spark, paths.snapshot) if before is None or v < before]
    if not versions:
        return None, None
    return spark.read.parquet(*[version_path(paths.snapshot, v) for v in versions]), versions[-1]


def snapshot_history(spark: SparkSession, paths: Paths) -> tuple[DataFrame | None, str | None]:
    """Full type-2 history: the log's versions, each closed where its customer's next one opens."""
    log, version = snapshot_log(spark, paths)
    return (None if log is None else snapshot.history_of(log, "customer_id")), version


def write_snapshot_run(rows: DataFrame, paths: Paths, version: str) -> None:
    """Only the versions this run opened are written; no earlier row is written again, so a
    run's output is the size of the change."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(version_path(paths.snapshot, version))


def newest_version(spark: SparkSession, paths: Paths) -> str:
    """The latest version any mart, the snapshot or the manifest holds ("" before the first run)."""
    manifest = read_table_or_none(spark, paths.loaded_batches)
    found = [manifest.agg(F.max("run")).first()[0] if manifest is not None else None]
    for root in (paths.mart("dim_customers"), paths.mart("fct_daily_revenue"), paths.snapshot):
        found += complete_versions(spark, root)[-1:]
    return max((v for v in found if v), default="")


def run_batch(spark: SparkSession, paths: Paths, now: dt.datetime, bad_rows: str = "quarantine") -> BatchResult:
    """One batch run. Per run, storage grows by the new rows only: the raw
    and staged tables are appended to, the dimension and daily rollup are
    rebuilt by aggregation into new versions, and the enriched fact is not
    rewritten at all (see :func:`fact_view`).

    Versions and history are ordered by ``now``. A run with an earlier ``now`` than one that
    was published (clock skew, a retried old date) would publish where no reader looks, so it is refused
    before anything is written; its batches load with the next run."""
    version = run_id(now)
    newest = newest_version(spark, paths)
    if version < newest:
        raise ValueError(f"now = {now.isoformat()} is earlier than the newest run {newest}: nothing was written")
    loaded, inserted = load_raw(spark, paths, version, bad_rows)
    result = BatchResult(loaded=loaded, inserted=inserted)
    if not loaded and not marts_stale(spark, paths):
        result.stages.append("skipped: no new lake batch")
        return result
    # The staging (and fact) tests ran on the increment inside load_raw.
    result.stages.append("staging tests passed")
    held = quarantined(spark, paths, version)
    if held is not None and (n := held.count()):
        result.stages.append(f"quarantined {n} rows")

    def publish(name: str, df: DataFrame, **layout) -> DataFrame:
        path = version_path(paths.mart(name), version)
        write_mart(df, path, **layout)
        return spark.read.parquet(path)

    # Uniqueness of transaction_id is proven by the gate above. The
    # dimension is rebuilt from the day groups (a fraction of the rows),
    # after recomputing only the days this and any unfinished run touched.
    n_days = update_day_groups(spark, paths)
    result.stages.append(f"day groups recomputed for {n_days} days")
    result.stages.append(f"day states recomputed for {update_day_states(spark, paths)} days")
    dim = publish("dim_customers", marts.dim_from_groups(spark.read.parquet(paths.day_groups), now))
    # The rollup reads no dimension column, so it is built from the staged rows;
    # only the touched days are re-aggregated.
    rollup, daily_runs, n_daily = daily_rollup(spark, paths, now)
    daily = publish("fct_daily_revenue", rollup, partition_by="transaction_date", cluster_by=["product_category"])
    mark_done(spark, paths, "daily", daily_runs)
    result.stages.append(f"daily rollup recomputed for {n_daily if n_daily >= 0 else 'all'} days")
    quality.gate({"dim_customers": dim, "fct_daily_revenue": daily})
    result.stages.append("mart tests passed")

    log, _ = snapshot_log(spark, paths, before=version)
    rows = snapshot.opened_versions(log, dim, "customer_id", SNAPSHOT_CHECK_COLS, now)
    write_snapshot_run(rows, paths, version)
    result.stages.append(f"snapshot {version}")
    return result


def fact_view(spark: SparkSession, paths: Paths, since: dt.date | None = None) -> DataFrame | None:
    """The enriched transaction fact: staged rows left-joined to the newest
    dimension version, stamped with that version's load time.

    The same rows a full refresh would write, without rewriting the whole
    fact on every run (its customer columns change whenever a customer's
    dimension row does, which touches every date partition). ``since``
    keeps transactions dated on or after that day and prunes the staged
    table's ``event_day`` partitions before the scan (rows whose time did
    not parse have no date, so no date window holds them either).
    """
    dim, version = read_latest(spark, paths.mart("dim_customers"))
    if dim is None:
        return None
    now = dt.datetime.strptime(version, "%Y%m%dT%H%M%S%f")
    return marts.fct_transactions(staged_since(spark, paths, since), dim, now)


def marts_from_warehouse(spark: SparkSession, paths: Paths) -> dict[str, DataFrame]:
    return {
        "dim_customers": read_mart(spark, paths, "dim_customers"),
        "fct_transactions": fact_view(spark, paths),
        "fct_daily_revenue": read_mart(spark, paths, "fct_daily_revenue"),
    }


def staged_since(spark: SparkSession, paths: Paths, since: dt.date | None) -> DataFrame:
    """Staged rows dated on or after ``since``, by pruned day partitions."""
    staged = spark.read.parquet(paths.staged)
    if since is not None:
        staged = staged.filter((F.col(RAW_PARTITION) >= F.lit(since)) & (F.col("transaction_date") >= F.lit(since)))
    return staged.drop(RAW_PARTITION)


# Query name -> (input, whether it takes the as-of date, which of ``days`` / ``k`` a caller may set). "state": a
# query over whole days, answered from the day states.
_QUERY_INPUTS = {
    "q1_revenue_today": ("state", True, ()),
    "q2_category_7d": ("state", True, ("days",)),
    "q3_top_customers": ("dim", False, ("k",)),
    "q4_hourly_today": ("state", True, ()),
    "q5_failure_by_payment_30d": ("state", True, ("days",)),
    "q6_flagged": ("candidates", False, ("k",)),
    "q7_segments": ("dim", False, ()),
    "q8_daily_trend_30d": ("state", True, ("days",)),
    "d1_kpis_today": ("daily", True, ()),
    "d2_revenue_trend": ("daily", True, ("days",)),
    "d2b_daily_total": ("daily", True, ("days",)),
    "d3_category_breakdown": ("daily", True, ("days",)),
    "d4_top_customers": ("dim", False, ("k",)),
    "d5_payment_failure": ("state", True, ("days",)),
    "d6_segments": ("dim", False, ()),
}


def day_state(spark: SparkSession, paths: Paths, name: str, since: dt.date | None = None) -> DataFrame:
    """A day state, of the days from ``since`` on (pruned partitions)."""
    state = spark.read.parquet(paths.day_state(name))
    if since is not None:
        state = state.filter(F.col(RAW_PARTITION) >= F.lit(since))
    return state.drop(RAW_PARTITION)


def warehouse_query(
    spark: SparkSession, paths: Paths, name: str, as_of: dt.date, days: int | None = None, k: int | None = None
) -> DataFrame:
    """Answer a named analytics / dashboard query from the warehouse this
    job maintains: the newest mart versions, and for queries over the transactions the day states of the days
    their window can reach. ``days`` and ``k`` set the window and the number of rows of the queries that have them.
    Only ``q6_flagged`` may need the transactions: where there are fewer than ``k`` high-value rows."""
    from quayside.plans import queries as Q
    from quayside.plans import served

    source, dated, settable = _QUERY_INPUTS[name]
    given = {n: v for n, v in (("days", days), ("k", k)) if v is not None}
    if not set(given) <= set(settable):
        raise ValueError(f"{name} takes {settable or 'no parameter'}, not {sorted(given)}")
    if source == "state":
        fn = getattr(served, name)
        reach = given.get("days", inspect.signature(fn).parameters["days"].default if settable else 0)
        since = as_of - dt.timedelta(days=reach)
        parts = [day_state(spark, paths, "day_measures", since)]
        if name == "q8_daily_trend_30d":
            parts.append(day_state(spark, paths, "day_customers", since))
        return fn(*parts, as_of, **given)
    if source == "candidates":
        # no such folder: no day had a high-value row
        found = read_table_or_none(spark, paths.day_state("day_candidates"))
        return served.q6_flagged(found, read_mart(spark, paths, "dim_customers"), lambda: fact_view(spark, paths), **given)
    data = read_mart(spark, paths, "dim_customers" if source == "dim" else "fct_daily_revenue")
    if name == "d2b_daily_total":
        return Q.d2b_daily_total(Q.d2_revenue_trend(data, as_of, **given))
    fn = getattr(Q, name)
    return fn(data, as_of, **given) if dated else fn(data, **given)
