"""Benchmark: headline jobs at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query's plan is executed in full through the ``noop`` sink (no driver
collect). Prints one JSON line with per-query seconds and their total.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "pipeline_cloud",        # E2: raw wrapped JSONL -> unified, dedup
    "quality_report_cloud",  # A17 on the E2 output
    "pipeline_local",        # E1: nested documents + sheets
    "pipeline_load",         # E3: validate + insert + reports
    "quality_report",        # A17 on typed observations
    "post_load_report",      # A18
    "dedup_keep_first",      # W1
    "station_temp_stats",    # A13
    "latest_10",             # T1
    "count_total",           # A1
    "validate_split",        # P13
    "station_enrich",        # J1
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from stratus.catalog import QUERIES
    from stratus.session import get_session
    spark = get_session(f"local[{cpus}]", shuffle_partitions=int(cpus))
    # inputs: stand-in files are generated and stored before timing starts
    from stratus.standin import prepare
    from stratus.catalog import stored_obs
    prepare(spark, sf_dir)
    stored_obs(spark, sf_dir)
    # warm-up: JVM, class loading, file listing
    QUERIES["count_total"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_seconds", "value": total, "unit": "sec",
                      "queries": times, "sf": sf, "input_rows": rows,
                      "rows_per_sec_pipeline_cloud": round(rows / times["pipeline_cloud"], 1)}))


if __name__ == "__main__":
    main()
