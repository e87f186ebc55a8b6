"""Benchmark the headline queries.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 3). Each query runs to completion through the
``noop`` sink (full plan, nothing collected); the reported time per query
is the best of BENCH_REPEAT runs after one warm-up pass. Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from playback_qos.plans.catalog import QUERIES  # noqa: E402
from playback_qos.session import get_spark  # noqa: E402

HEADLINE = [
    "viewer_qos",
    "content_qos",
    "dq_results",
    "silver_dedupe_first",
    "silver_layer",
    "viewer_qos_end_to_end",
    "telemetry_contract",
    "buffering_intervals",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = get_spark(
        app_name="playback-qos-bench",
        master=f"local[{cpus}]",
        spark_sql_shuffle_partitions=max(cpus, 1),
        conf={"spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    errors = {}
    for name in HEADLINE:  # warm-up (JIT, file listing, Python workers)
        try:
            run(QUERIES[name](spark, sf_dir))
        except Exception as e:  # noqa: BLE001 - report, keep measuring the rest
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
    times = {}
    for name in HEADLINE:
        if name in errors:
            times[name] = None
            continue
        best = float("inf")
        for _ in range(repeat):
            t0 = time.perf_counter()
            run(QUERIES[name](spark, sf_dir))
            best = min(best, time.perf_counter() - t0)
        times[name] = round(best, 4)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "headline_total",
        "value": round(sum(t for t in times.values() if t is not None), 4),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }
    if errors:
        out["errors"] = errors
    spark.stop()
    print(json.dumps(out))


if __name__ == "__main__":
    main()
