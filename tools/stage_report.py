"""Bytes read, shuffled and written by each step, from Spark's event log.

    python tools/stage_report.py [sf_dir] > STAGES.md

Runs the layer jobs once with the event log written to a fresh scratch folder (no UI), tags
each step with a job group, then sums the task metrics of the step's stages: input bytes
(scans), shuffle write / read bytes, output bytes, task time. The text column dominates the
data, so the numbers show which steps read or move it.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time
from collections import defaultdict

sys.path.insert(0, ".")


def _mb(n: float) -> str:
    return f"{n / 1e6:,.1f}"


def main() -> None:
    from pyspark.sql import SparkSession

    from claimlake.operators import quality as q
    from claimlake.plans import fixtures as fx
    from claimlake.plans import medallion as m
    from claimlake.plans.tables import Lake

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    logdir = tempfile.mkdtemp(prefix="claimlake-events-")
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", f"file://{logdir}")
        .config("spark.eventLog.compress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    sc = spark.sparkContext
    lake = Lake.fresh(spark, "stages").create(spark)
    root = f"{lake.root}/landing"
    fx.write_landing_area(spark, fx.documents(spark, sf), root)

    def step(name, fn):
        sc.setJobGroup(name, name)
        t0 = time.perf_counter()
        fn()
        return name, time.perf_counter() - t0

    walls = dict(
        [
            step("source_to_bronze", lambda: m.to_bronze(spark, root, lake, run_ts=fx.RUN_TS)),
            step("bronze_to_silver", lambda: m.to_silver(spark, lake, rules=fx.RULES_THREE, run_ts=fx.RUN_TS)),
            step("publish_gold", lambda: m.to_gold(spark, lake)),
            step("resolve_bulk_export", lambda: m.resolve_gold_to_table(spark, lake, "gold_text")),
            step(
                "resolve_few",
                lambda: m.resolve_gold(spark, lake, ids=["1", "2", "3"]).write.format("noop").mode("overwrite").save(),
            ),
            step("quarantine_summary", lambda: q.quarantine_summary(spark.table(lake.quarantine_name)).collect()),
        ]
    )
    text_bytes = spark.table(lake.store_name).selectExpr("sum(n_bytes)").first()[0]
    spark.stop()

    stage_group: dict[int, str] = {}
    agg: dict[str, dict[str, float]] = defaultdict(lambda: defaultdict(float))
    (path,) = glob.glob(os.path.join(logdir, "*"))
    # Spark 4 writes a rolling log: a folder of ``events_<n>_...`` files.
    files = sorted(glob.glob(os.path.join(path, "events_*")), key=lambda p: int(os.path.basename(p).split("_")[1])) if os.path.isdir(path) else [path]
    for fp in files:
        for line in open(fp):
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerJobStart":
                group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                for sid in ev.get("Stage IDs", []):
                    if group:
                        stage_group[sid] = group
                if group:
                    agg[group]["jobs"] += 1
            elif kind == "SparkListenerTaskEnd":
                group = stage_group.get(ev.get("Stage ID"))
                met = ev.get("Task Metrics") or {}
                if not group or not met:
                    continue
                a = agg[group]
                a["tasks"] += 1
                a["input"] += (met.get("Input Metrics") or {}).get("Bytes Read", 0)
                a["output"] += (met.get("Output Metrics") or {}).get("Bytes Written", 0)
                a["shuffle_write"] += (met.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
                sr = met.get("Shuffle Read Metrics") or {}
                a["shuffle_read"] += sr.get("Remote Bytes Read", 0) + sr.get("Local Bytes Read", 0)
                a["task_ms"] += met.get("Executor Run Time", 0)

    print(f"# Bytes per step ({sf}, local[8])\n")
    print(f"Texts in the store: {_mb(text_bytes)} MB (UTF-8). Input MB comes from Hadoop file-system")
    print("statistics and undercounts Parquet reads on the local file system; shuffle and output")
    print("bytes are exact. Shuffle bytes are compressed.\n")
    print("| step | wall s | jobs | tasks | input MB | shuffle write MB | shuffle read MB | output MB | task s |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    for name, wall in walls.items():
        a = agg[name]
        print(
            f"| {name} | {wall:.2f} | {int(a['jobs'])} | {int(a['tasks'])} | {_mb(a['input'])} | "
            f"{_mb(a['shuffle_write'])} | {_mb(a['shuffle_read'])} | {_mb(a['output'])} | {a['task_ms'] / 1000:.2f} |"
        )


if __name__ == "__main__":
    main()
