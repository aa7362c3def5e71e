"""Benchmark: every registered query, plus the end-to-end batch pipeline.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints ONE JSON line: {"metric", "value" (sum of query seconds), "unit",
"queries": {name: seconds}, "sf", ...}. Each query runs to completion
through the ``noop`` sink (the whole plan executes, nothing is collected).
After one untimed warm-up, each query runs once cold, then its best of
``BENCH_REPEATS`` (default 2) warm runs is reported;
"batch_run" times lake -> warehouse -> marts -> tests -> snapshot on a
lake written from the same tables; "serving_from_warehouse" (not part of
"value") times the 14 named queries answered from that warehouse (warm).
"""

from __future__ import annotations

import datetime as dt
import json
import os
import re
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))

    from quayside.operators.parse import encode_events, parse_transactions, split_valid_invalid
    from quayside.plans import batch
    from quayside.plans.registry import REGISTRY
    from quayside.session import checkpoint_dir, local_session
    from quayside.sources import testdata
    from quayside.sources.lake import write_lake_batch

    spark = local_session(cores=cpus, shuffle_partitions=max(2 * cpus, 8), driver_memory="16g")
    scratch = tempfile.mkdtemp(prefix="quayside-bench-")
    checkpoint_dir(spark, fallback=os.path.join(scratch, "ckpt"))

    names = only or list(REGISTRY)
    # Warm-up (JIT, file listing caches): not timed.
    REGISTRY["q3_top_customers"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    def run(name: str) -> float:
        t0 = time.perf_counter()
        REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    times: dict[str, float] = {}
    cold: dict[str, float] = {}
    serving: dict[str, float] = {}
    for name in names:
        cold[name] = round(run(name), 3)
        times[name] = round(min(run(name) for _ in range(repeats)), 3)

    if not only:
        paths = batch.Paths(lake=os.path.join(scratch, "lake"), warehouse=os.path.join(scratch, "wh"))
        valid, _ = split_valid_invalid(parse_transactions(encode_events(testdata.transactions(spark, sf_dir))))
        t0 = time.perf_counter()
        write_lake_batch(valid, paths.lake, "bench-0")
        times["ingest_lake_write"] = round(time.perf_counter() - t0, 3)
        t0 = time.perf_counter()
        batch.run_batch(spark, paths, dt.datetime(2024, 1, 31))
        times["batch_run"] = round(time.perf_counter() - t0, 3)
        # Serving: the named queries answered from the maintained warehouse.
        as_of = dt.date(2024, 1, 30)
        for name in batch._QUERY_INPUTS:
            batch.warehouse_query(spark, paths, name, as_of).write.format("noop").mode("overwrite").save()
            t0 = time.perf_counter()
            batch.warehouse_query(spark, paths, name, as_of).write.format("noop").mode("overwrite").save()
            serving[name] = round(time.perf_counter() - t0, 3)

    sf = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf.group(1)) if sf else sf_dir,
        "cpus": cpus,
        "n_queries": len(times),
        "cold": cold,
        "serving_from_warehouse": serving,
        "serving_total": round(sum(serving.values()), 3),
        "timing": f"queries: best of {repeats} warm runs after one cold run (cold times under 'cold')",
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
