"""Command-line entry points for the two long-running jobs.

    spark-submit --py-files quayside.zip quayside/jobs.py ingest --format kafka \
        --option kafka.bootstrap.servers=host:9092 --option subscribe=transactions \
        --lake s3a://bucket/lake --dlq s3a://bucket/dlq \
        --checkpoint s3a://bucket/checkpoints/ingest --sink-id ingest-a

    spark-submit --py-files quayside.zip quayside/jobs.py batch --lake s3a://bucket/lake \
        --warehouse s3a://bucket/warehouse [--now 2024-01-31T00:00:00]

(``quayside.zip`` = the ``quayside`` package zipped; locally,
``python -m quayside.jobs ...`` works the same.) The session (master,
executors, ``spark.checkpoint.dir``) comes from ``spark-submit``; only
the SQL settings the plans rely on are applied.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from pyspark.sql import SparkSession

from quayside.plans import batch
from quayside.plans.registry import prepare
from quayside.session import apply_base_conf
from quayside.streaming.ingest import DEFAULT_TRIGGER, message_stream, run_ingest


def _options(pairs: list[str]) -> dict[str, str]:
    out = {}
    for p in pairs:
        k, _, v = p.partition("=")
        out[k] = v
    return out


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="quayside.jobs")
    sub = ap.add_subparsers(dest="job", required=True)

    ing = sub.add_parser("ingest", help="stream messages into the lake and dead-letter output")
    ing.add_argument("--format", default="kafka", choices=["kafka", "text", "parquet", "json"])
    ing.add_argument("--path", help="source folder for file formats")
    ing.add_argument("--option", action="append", default=[], help="source option key=value")
    ing.add_argument("--lake", required=True)
    ing.add_argument("--dlq", help="dead-letter Parquet folder")
    ing.add_argument("--dlq-kafka", action="append", default=[], help="dead-letter Kafka option key=value")
    ing.add_argument("--checkpoint", required=True)
    ing.add_argument("--sink-id", required=True, help="stable per checkpoint; scopes batch partitions")
    ing.add_argument("--trigger", default=DEFAULT_TRIGGER, help="processing-time interval, or 'available-now'")

    bat = sub.add_parser("batch", help="lake -> warehouse -> marts -> tests -> snapshot")
    bat.add_argument("--lake", required=True)
    bat.add_argument("--warehouse", required=True)
    bat.add_argument("--now", help="load time (ISO); default: now, UTC")

    bat.add_argument("--bad-rows", default="quarantine", choices=["quarantine", "refuse"], help="rows that fail a staging test")

    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName(f"quayside-{args.job}").getOrCreate()
    apply_base_conf(spark)
    prepare(spark)

    if args.job == "ingest":
        stream = message_stream(spark, args.format, args.path, _options(args.option))
        trigger = {"availableNow": True} if args.trigger == "available-now" else {"processingTime": args.trigger}
        q = run_ingest(
            spark,
            stream,
            args.lake,
            args.checkpoint,
            args.sink_id,
            dlq_path=args.dlq,
            dlq_kafka=_options(args.dlq_kafka) or None,
            trigger=trigger,
        )
        q.awaitTermination()
    else:
        now = dt.datetime.fromisoformat(args.now) if args.now else dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        paths = batch.Paths(lake=args.lake, warehouse=args.warehouse)
        result = batch.run_batch(spark, paths, now, args.bad_rows)
        print(json.dumps({"loaded": result.loaded, "inserted": result.inserted, "stages": result.stages}))


if __name__ == "__main__":
    main()
