"""Measure task balance of the profile step when one station holds a third of
all readings: plain per-key window vs the range-sliced operator.

Usage: python tools/skew_demo.py [sf_dir] [copies]

Readings are ``copies`` copies of the sf readings; every third reading is moved
to one station ("hot"). Both plans compute next_depth / next_temp / position
per location over all time. Task metrics come from Spark's event log, written
to a fresh scratch folder (no UI).
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from thermocline import fixtures as FX  # noqa: E402
from thermocline.operators.ordered import with_successor, with_successor_window  # noqa: E402
from thermocline.operators.qc import profile_order  # noqa: E402


def session(log_dir: str) -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("skew-demo")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", log_dir)
        .config("spark.eventLog.compress", "false")
        .config("spark.eventLog.rolling.enabled", "false")
        .config("spark.sql.shuffle.partitions", "16")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def stage_stats(log_dir: str, group: str) -> list[dict]:
    """Per stage of jobs tagged ``group``: tasks, max/median records, max task ms."""
    files = [p for p in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True) if os.path.isfile(p)]
    jobs_in_group, stage_of_job = set(), {}
    tasks = defaultdict(list)
    for path in files:
        with open(path) as fh:
            for line in fh:
                if not line.startswith("{"):
                    continue
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    props = ev.get("Properties") or {}
                    if props.get("spark.jobGroup.id") == group:
                        jobs_in_group.add(ev["Job ID"])
                        for sid in ev.get("Stage IDs", []):
                            stage_of_job[sid] = ev["Job ID"]
                elif kind == "SparkListenerTaskEnd":
                    info, m = ev["Task Info"], ev.get("Task Metrics") or {}
                    recs = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0) + (
                        m.get("Input Metrics") or {}
                    ).get("Records Read", 0)
                    tasks[ev["Stage ID"]].append((info["Finish Time"] - info["Launch Time"], recs))
    out = []
    for sid in sorted(s for s in tasks if stage_of_job.get(s) in jobs_in_group):
        t = sorted(tasks[sid], key=lambda x: x[1])
        recs = [r for _, r in t]
        out.append(
            {
                "stage": sid,
                "tasks": len(t),
                "max_records": max(recs),
                "median_records": recs[len(recs) // 2],
                "max_task_ms": max(ms for ms, _ in t),
            }
        )
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 10
    log_dir = tempfile.mkdtemp(prefix="run-skew-")
    spark = session(log_dir)
    base = FX.scaled_readings(spark, sf_dir, copies)
    hot = base.withColumn(
        "location", F.when(F.col("event_id") % 3 == 0, F.lit("hot")).otherwise(F.col("location"))
    )
    counts = hot.groupBy((F.col("location") == "hot").alias("is_hot")).count().collect()
    sizes = {("hot" if r["is_hot"] else "others"): r["count"] for r in counts}
    results = {}
    for label, safe in (("window", False), ("sliced", True)):
        spark.sparkContext.setJobGroup(label, label)
        t = time.perf_counter()
        order = profile_order(hot, carry=["depth", "temperature"], keys=["location"])
        size = {"rows_per_slice": 60_000} if safe else {}
        form = with_successor if safe else with_successor_window
        out = form(hot, ["location"], order, ["depth", "temperature"], position_col="pos", **size)
        out.write.format("noop").mode("overwrite").save()
        results[label] = round(time.perf_counter() - t, 2)
    spark.stop()  # flush the event log
    print(json.dumps({"rows": sizes, "seconds": results}))
    for label in ("window", "sliced"):
        print(f"## {label}")
        for s in stage_stats(log_dir, label):
            print(json.dumps(s))


if __name__ == "__main__":
    main()
