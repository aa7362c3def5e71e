"""Per-query cold/warm seconds, rows read and shuffle bytes, from Spark's
event log (written to a scratch folder; no UI, no server).

    python tools/profile_queries.py /root/testdata/sf0.1 [name ...]

Prints a Markdown table.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time
from collections import defaultdict

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main(argv: list[str]) -> None:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    from quayside.plans.registry import REGISTRY
    from quayside.session import checkpoint_dir, local_session

    logdir = tempfile.mkdtemp(prefix="quayside-eventlog-")
    spark = local_session(
        cores=8,
        shuffle_partitions=16,
        driver_memory="16g",
        extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": logdir, "spark.eventLog.compress": "false"},
    )
    checkpoint_dir(spark, fallback=tempfile.mkdtemp(prefix="quayside-prof-ckpt-"))
    names = argv[2:] or list(REGISTRY)
    sc = spark.sparkContext
    REGISTRY["q3_top_customers"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    secs: dict[str, list[float]] = {}
    for name in names:
        secs[name] = []
        for i in range(3):
            sc.setJobGroup(f"{name}#{i}", name)
            t0 = time.perf_counter()
            REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            secs[name].append(time.perf_counter() - t0)
    sc.setJobGroup("done", "done")
    spark.stop()

    job_group: dict[int, str] = {}
    stage_group: dict[int, str] = {}
    shuffle = defaultdict(int)
    rows_in = defaultdict(int)
    for path in sorted(glob.glob(os.path.join(logdir, "**", "*"), recursive=True)):
        if os.path.isdir(path) or not os.path.basename(path).startswith("events_"):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id", "")
                    job_group[ev["Job ID"]] = group
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    group = stage_group.get(ev.get("Stage ID"), "")
                    if not group.endswith("#1"):  # measure the first warm run
                        continue
                    m = ev.get("Task Metrics") or {}
                    shuffle[group] += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
                    rows_in[group] += (m.get("Input Metrics") or {}).get("Records Read", 0)
    print("| query | cold s | warm s (best of 2) | rows read | shuffle bytes |")
    print("|---|---:|---:|---:|---:|")
    for name in names:
        g = f"{name}#1"
        cold, warm = secs[name][0], min(secs[name][1:])
        print(f"| `{name}` | {cold:.2f} | {warm:.2f} | {rows_in[g]:,} | {shuffle[g]:,} |")


if __name__ == "__main__":
    main(sys.argv)
