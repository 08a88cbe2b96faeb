"""Time cleaning, enrichment and the whole job on the events table repeated over later days.

    python bench_scale.py ROWS [even|hot] [FOLDER]

``hot`` gives a third of all rows one and the same timestamp. Prints one JSON line. The
generated input goes to a new folder below the session's shared work folder.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import functions as F

from wattline.operators import add_hour_metrics, clean_readings, daily_peak_hours, hourly_rollup
from wattline.plans import enriched_readings, materialize, run
from wattline.session import build_session, work_folder
from wattline.sources import as_readings, read_events
from wattline.sources.delimited import text_options

ORDER = ["event_id"]
DAYS = 30


def repeated(spark, folder: str, rows: int, hot: bool):
    events = read_events(spark, folder)
    size = events.count()
    copies = max(1, rows // size)
    shift = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy")
    many = events.select("*", shift).repartition(spark.sparkContext.defaultParallelism * 4)
    ts = F.col("ts") + F.make_dt_interval(days=F.col("copy") * DAYS)
    if hot:
        ts = F.when(F.col("event_id") % 3 == 0, F.lit("2024-01-15 12:00:00").cast("timestamp_ntz")).otherwise(ts)
    return many.withColumn("ts", ts).withColumn(
        "event_id", F.col("event_id") + F.col("copy").cast("bigint") * size
    )


def main() -> None:
    rows = int(sys.argv[1]) if len(sys.argv) > 1 else 10_000_000
    hot = len(sys.argv) > 2 and sys.argv[2] == "hot"
    folder = sys.argv[3] if len(sys.argv) > 3 else "/root/testdata/sf0.1"
    cpus = os.environ.get("BENCH_CPUS", "8")
    settings = {
        "spark.master": f"local[{cpus}]",
        "spark.driver.memory": "16g",
        "spark.sql.shuffle.partitions": str(int(cpus) * 4),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if os.environ.get("BENCH_EVENT_LOG"):
        settings |= {"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG"]}
    spark = build_session("wattline-scale", **settings)
    spark.sparkContext.setLogLevel("OFF")

    # Without the fraction of a second the events would give only 43,200 timestamps per copy.
    raw = materialize(as_readings(repeated(spark, folder, rows, hot), to_the_minute=False), "raw")
    timings: dict[str, float] = {}

    def timed(name, action):
        started = time.perf_counter()
        result = action()
        timings[name] = round(time.perf_counter() - started, 2)
        return result

    def compute(df):
        df.write.format("noop").mode("overwrite").save()

    total = raw.count()
    timed("clean", lambda: compute(clean_readings(raw, ORDER)))
    cleaned = timed("clean_to_table", lambda: materialize(clean_readings(raw, ORDER), "cleaned"))
    rollup = timed("rollup", lambda: materialize(hourly_rollup(cleaned), "rollup"))
    timed("enrich", lambda: compute(add_hour_metrics(cleaned, rollup)))
    timed("peak_hours", lambda: compute(daily_peak_hours(cleaned, rollup)))
    timed("clean_and_enrich", lambda: compute(enriched_readings(raw, ORDER)))
    source, target = work_folder(spark, "csv"), work_folder(spark, "out")
    raw.write.options(**text_options(";")).csv(source)
    report = timed("csv_job", lambda: run(spark, source, target))
    timed("csv_job_to_parquet", lambda: run(spark, source, work_folder(spark, "pq"), format="parquet", ordered=False))
    print(
        json.dumps(
            {
                "rows": total,
                "cleaned_rows": cleaned.count(),
                "exported_rows": report.exported_rows,
                "hot": hot,
                "seconds": timings,
                "rows_per_second": {k: round(total / v) for k, v in timings.items()},
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
