"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries": {name: sec}, "sf"}.
Each query is run to completion through the no-op sink (nothing is collected),
three times; the reported time is the fastest (warm) run, and ``cold_value`` sums the
first runs (JVM class loading and code generation included).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from thermocline import fixtures as FX  # noqa: E402
from thermocline.plans.catalog import registry  # noqa: E402
from thermocline.plans.ocean_metrics import ocean_metrics_batch  # noqa: E402
from thermocline.session import local_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))

HEADLINE = [
    "ocean_metrics",
    "gradient_qc",
    "profile_positions",
    "ocean_metrics_location_profiles",
    "hourly_temperature",
    "qc_score_categories",
    "ocean_metrics_stream",
    "ocean_metrics_stream_staged",
    "air_quality_metrics",
    "all_sources_union",
    "ndbc_station_feed",
    "ooi_feed",
    "impact_model",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = local_session(CPUS, max(8, 2 * CPUS), app="thermocline-bench")
    queries = registry()
    extra = {
        # the same flagship over 10 copies of the readings (10x rows, 10x locations)
        "ocean_metrics_x10": lambda s, d: ocean_metrics_batch(FX.scaled_readings(s, d, 10)),
    }
    run(queries["depth_layers"](spark, SF_DIR))  # warm-up (JIT, file listing), not timed
    times, cold = {}, {}
    for name in HEADLINE + list(extra):
        fn = queries.get(name) or extra[name]
        runs = []
        for _ in range(REPEATS):
            t = time.perf_counter()
            run(fn(spark, SF_DIR))
            runs.append(time.perf_counter() - t)
        times[name], cold[name] = round(min(runs), 3), round(runs[0], 3)
    m = re.search(r"sf([0-9.]+)", SF_DIR)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "cold_value": round(sum(cold.values()), 3),
                "sf": float(m.group(1)) if m else SF_DIR,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
