"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the number of local threads, BENCH_RUNS
how often each query runs after one warm-up; the median counts. Results go to a sink that
computes every row and keeps nothing.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from wattline.plans.catalog import QUERIES
from wattline.session import build_session

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = (
    "readings_with_metrics",
    "readings_with_metrics_in_one_plan",
    "clean_readings",
    "first_per_timestamp",
    "hour_of_day_totals",
    "daily_maxima",
    "daily_peak_flags",
    "daily_peak_hours",
    "column_profile",
    "tail_rows",
    "csv_round_trip",
    "stream_clean_readings",
    "stream_hour_totals",
)


def seconds(spark, name: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    settings = {
        "spark.master": f"local[{CPUS}]",
        "spark.driver.memory": "8g",
        "spark.sql.shuffle.partitions": CPUS,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    spark = build_session("wattline-bench", **settings)
    spark.sparkContext.setLogLevel("OFF")
    rows = spark.read.parquet(f"{FOLDER}/events.parquet").count()
    timings = {}
    for name in HEADLINE:
        seconds(spark, name)
        timings[name] = round(statistics.median(seconds(spark, name) for _ in range(RUNS)), 3)
    spark.stop()
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
        "rows": rows,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
