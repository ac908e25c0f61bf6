"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR, BENCH_CPUS, BENCH_RUNS and BENCH_QUERIES (comma separated) set the input, the
cores, the measured runs after one warm-up, and the selection. Reported is the median;
``value`` is the sum over the queries. Results go to Spark's no-op sink, so every row and
column is computed and nothing is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from eventflow.plans.catalogue import QUERIES
from eventflow.session import build_session

HEADLINE = [
    "batch_summary",
    "summary_by_user_type",
    "lineitem_summary",
    "csv_summary",
    "parse_events",
    "count_changelog",
    "time_to_n",
    "result_digest",
    "table_digest",
    "table_fingerprint",
    "run_metrics",
    "summary_violations",
    "stream_counts",
    "stream_counts_update",
    "count_changelog_stream",
    "pipeline_summary",
    "stream_batch_diff",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]", cpus,
        {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:]), 3)
        print(f"{name}: first {taken[0]:.2f}, then {seconds[name]:.2f}", file=sys.stderr)
    print(json.dumps({
        "metric": "headline queries, warm median", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
