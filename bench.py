"""Wall time of the headline queries: median of three runs after one warm-up. Prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from funnelbook.registry import QUERIES  # noqa: E402

HEADLINE = (
    "daily_summary", "goal_daily", "changed_days_ads", "reload_ranges", "reload_plan", "changed_days_visits", "new_goal_days",
    "goal_deltas", "goal_batch_merge", "visit_collapse", "visit_enrich", "shape_visits", "goal_flags", "visit_dedup",
    "calls_leads", "vk_normalize", "group_lookup", "active_clients", "stale_clients", "access_upsert", "scan_report_tsv",
    "range_replace",
)
RUNS = 3


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("funnelbook-bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        # wide projections: code too large for the JIT is run as split methods instead
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        # no Python call-site capture per column expression
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    scratch = tempfile.mkdtemp(prefix="funnelbook-bench-")
    builder = builder.config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
    builder = builder.config("spark.checkpoint.dir", scratch)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    took = {}
    for name in names:
        times = []
        for _ in range(1 + RUNS):
            t = time.perf_counter()
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - t)
        took[name] = round(statistics.median(times[1:]), 3)
    print(
        json.dumps(
            {"metric": "total_query_seconds", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(sf.rstrip("/"))}
        )
    )


if __name__ == "__main__":
    main()
