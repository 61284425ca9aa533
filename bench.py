"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the
local cores.  Each query runs once to warm up and then BENCH_RUNS times (default
2); its number is the median.  All columns are computed, nothing is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from tidemark.registry import QUERIES  # noqa: E402

HEADLINE = [
    "latest_per_key", "latest_per_key_ties", "dedup_left_join", "topn_other", "breakdown_365d",
    "weighted_rate", "safe_ratio", "aligned_union", "campaign_marts", "social_posts",
    "cross_channel", "daily_totals", "coverage_ranges", "value_runs",
    "key_duplicates", "mark_duplicates", "duplicate_days", "numeric_profile", "fill_rate",
    "reconcile", "mixed_date_parse", "cell_coercion", "quarantine", "html_links",
    "header_and_types", "upsert_plan", "apply_plan", "duplicate_diff",
    "sink_writes", "ingest_roundtrip", "summary_ingest", "incremental_ingest", "grid_sync", "social_sync",
    "dashboard_sync", "web_sync",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count() or 8)
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    # an ordinary session: the queries bring what they need
    spark = (SparkSession.builder.appName("bench").master(f"local[{cpus}]")
             .config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false")
             .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            run(QUERIES[name](spark, folder))
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:]), 3)
    print(json.dumps({
        "metric": "headline queries, sum of warm medians", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": Path(folder).name.removeprefix("sf"),
        "cpus": int(cpus), "shuffle_partitions": int(cpus), "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
