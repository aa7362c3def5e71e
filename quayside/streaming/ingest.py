"""Stream ingest: read messages, parse, split, write lake and dead letters.

One Structured Streaming query. Each micro-batch is parsed once, persisted,
split into valid and invalid rows, and written with replay-safe sinks; the
checkpoint (offsets + commit log) makes a restarted query re-run exactly
the uncommitted batch, which then overwrites its own partitions.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quayside.operators.parse import build_dlq_payload, parse_transactions, split_valid_invalid
from quayside.sources.lake import observed, write_dlq_batch, write_lake_batch

DEFAULT_TRIGGER = "300 seconds"


def message_stream(
    spark: SparkSession,
    fmt: str,
    path: str | None = None,
    options: dict[str, str] | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """A streaming frame with a ``value`` column.

    * ``kafka``: subscribe with ``options`` (bootstrap servers, topic);
      defaults start at the latest offsets and tolerate lost data, as the
      reference does.
    * ``text``: a directory of files, one message per line.
    * ``parquet`` / ``json``: files with ``key`` and ``value`` string columns.
    """
    reader = spark.readStream.format(fmt)
    opts = dict(options or {})
    if fmt == "kafka":
        opts.setdefault("startingOffsets", "latest")
        opts.setdefault("failOnDataLoss", "false")
    elif fmt in ("parquet", "json"):
        reader = reader.schema("key string, value string")
    if max_files_per_trigger and fmt != "kafka":
        opts["maxFilesPerTrigger"] = str(max_files_per_trigger)
    for k, v in opts.items():
        reader = reader.option(k, v)
    return reader.load(path) if path else reader.load()


def ingest_batch(
    batch: DataFrame,
    batch_id: int,
    lake_path: str,
    sink_id: str,
    dlq_path: str | None = None,
    dlq_kafka: dict[str, str] | None = None,
    clock: Callable[[], dt.datetime] | None = None,
    lake_format: str = "parquet",
) -> dict[str, int]:
    """Process one parsed micro-batch (the ``foreachBatch`` body).

    Two writes at most: the lake write observes, on its way, whether any row
    is invalid, and only then the dead letters are written. The batch is
    persisted, so the second write finds it parsed. (That an invalid row
    was seen is a maximum, which a task that runs again cannot change.) The
    error time is taken once per batch on the driver, so every task and
    every task retry stamps the same value.
    """
    key = f"{sink_id}-{batch_id}"
    batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        seen = Observation()
        watched = batch.observe(seen, F.coalesce(F.max(F.col("dlq_reason").isNotNull().cast("int")), F.lit(0)).alias("has_invalid"))
        leaves = write_lake_batch(split_valid_invalid(watched)[0], lake_path, key, lake_format)
        invalid = split_valid_invalid(batch)[1]
        found = observed(seen)
        has_invalid = found["has_invalid"] if found else int(not invalid.isEmpty())
        if has_invalid:
            now = clock() if clock else dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
            write_dlq_batch(build_dlq_payload(invalid, now), key, dlq_path, dlq_kafka)
        return {"batch_id": batch_id, "has_invalid": has_invalid, "leaves": len(leaves)}
    finally:
        batch.unpersist()


def run_ingest(
    spark: SparkSession,
    messages: DataFrame,
    lake_path: str,
    checkpoint: str,
    sink_id: str,
    dlq_path: str | None = None,
    dlq_kafka: dict[str, str] | None = None,
    trigger: dict | None = None,
    lake_format: str = "parquet",
) -> StreamingQuery:
    """Start the ingest query. ``trigger`` defaults to a 300 s processing
    time; tests pass ``{"availableNow": True}``. ``sink_id`` must be stable
    for a given ``checkpoint``: batch ids restart at 0 with a new
    checkpoint, and the id keeps a new run from overwriting old batches.
    """
    parsed = parse_transactions(messages)

    def body(df: DataFrame, batch_id: int) -> None:
        ingest_batch(df, batch_id, lake_path, sink_id, dlq_path, dlq_kafka, lake_format=lake_format)

    writer = parsed.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint)
    writer = writer.trigger(**(trigger or {"processingTime": DEFAULT_TRIGGER}))
    return writer.start()
