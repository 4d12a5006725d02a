"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR  folder of the driver tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from subledger.session import build_session  # noqa: E402
from workload.catalog import QUERIES  # noqa: E402
from workload.fixtures import Data  # noqa: E402

HEADLINE = [
    "daily_counters_long", "counters_service", "daily_counters_excluded", "service_rollup", "counters_incremental",
    "subscription_view", "subscription_view_long", "cpc_list", "status_distribution", "top_campaigns", "monthly_activations",
    "dedupe_last", "append_dedupe", "scan_csv_lenient", "completeness_tx", "gap_ranges", "duplicate_counts",
    "user_base_all_levels", "reconcile_user_base", "refund_analysis_long", "revenue_pivot", "cohort_lt_ltv",
    "category_overview", "user_summary", "user_timeline", "timeline_summary", "enrich_users", "extract_act", "extract_refunds",
]
# Timed runs of each query, after one that is not; their median counts.
RUNS = 3
# Input tables of the queries whose row rate is reported.
RATES = {
    "daily_counters_long": ("orders", "lineitem"), "subscription_view_long": ("orders", "lineitem"),
    "dedupe_last": ("orders",), "append_dedupe": ("orders",),
}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    data = Data(spark, folder)
    # One untimed pass over the inputs starts the JVM's workers and the file system cache.
    for table in ("events", "orders", "lineitem", "part"):
        data.table(table).write.format("noop").mode("overwrite").save()
    took = {}
    for name in sys.argv[1:] or HEADLINE:
        times = []
        for _ in range(1 + RUNS):  # the first run compiles, and writes files that a query reads
            start = time.perf_counter()
            QUERIES[name](data).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        took[name] = round(statistics.median(times[1:]), 3)
    rates = {
        name: round(sum(data.table(t).count() for t in tables) / took[name])
        for name, tables in RATES.items() if name in took
    }
    print(json.dumps({
        "metric": "total_query_time", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took,
        "rows_per_sec": rates, "sf": os.path.basename(folder.rstrip("/")), "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
