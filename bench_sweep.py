"""Shuffle partitions 200 against the cores, with and without adaptive execution, and the
stream's rows per second, cold and warm. Prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import time

from eventflow import schemas
from eventflow.operators.summary import parse_messages
from eventflow.plans import jobs
from eventflow.plans.catalogue import QUERIES
from eventflow.session import build_session, work_dir
from eventflow.sources.messages import as_messages, stream_table
from eventflow.streaming.counter import run_to_end, start_counter


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    spark = build_session(
        "sweep", f"local[{cpus}]", cpus, {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    result: dict[str, object] = {}
    for name in ("summary_by_user_type", "lineitem_summary"):
        for adaptive in (False, True):
            runs = [
                jobs.compare_partitions(
                    spark, lambda s: QUERIES[name](s, sf_dir), lambda rows: rows, cpus, runs=1, adaptive=adaptive
                )
                for _ in range(4)
            ][1:]
            median = lambda field: statistics.median(run[field] for run in runs)
            result[f"{name}, adaptive {'on' if adaptive else 'off'}"] = {
                "ms_at_200": median("baseline_time_ms"), f"ms_at_{cpus}": median("job_time_ms"),
                "speedup": median("speedup_factor"),
            }
    for label in ("cold", "warm", "warm again"):
        work = work_dir(spark, "sweep")
        events = parse_messages(as_messages(stream_table(spark, f"{sf_dir}/events.parquet", schemas.EVENTS)))
        start = time.perf_counter()
        query = start_counter(events, out=f"{work}/out", checkpoint=f"{work}/checkpoint")
        run_to_end(query, 600)
        seconds = time.perf_counter() - start
        progress = [p for p in query.recentProgress if p["numInputRows"]]
        rows = sum(p["numInputRows"] for p in progress)
        result[f"stream, {label}"] = {
            "rows": rows, "seconds": round(seconds, 2), "rows_per_second": round(rows / seconds),
            "batch_ms": [p["batchDuration"] for p in progress],
        }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
