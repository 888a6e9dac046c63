"""Times the headline queries and prints one JSON line.

    BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 1),
    BENCH_ALL=1 for every registered query
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from breathline.session import builder  # noqa: E402
from checks.registry import REGISTRY  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "1"))

HEADLINE = [
    "parse_envelope", "quarantine", "classify", "enrich_city", "dedup_replay", "hourly_rollup", "daily_rollup",
    "daily_weighted", "weekly_rollup", "upsert_hourly", "upsert_daily", "measurements_sink", "archive_rows",
    "archive_bundle", "stream_enrich", "stream_hourly", "latest_by_city", "trend_24h", "weekday_pattern",
    "level_share", "region_rollup", "city_rank", "alerts", "weather_corr", "aqi_trend_fit", "aqi_forecast",
    "dedup_intervals", "moments_hourly", "compact_measurements", "stream_alerts",
    "clustered_scan",
]

# Queries that write tables run once, without a warm-up: each run leaves its files behind.
WRITING = [
    "upsert_hourly", "upsert_daily", "measurements_sink", "batch_jobs", "archive_rows", "archive_parquet",
    "archive_replay", "stream_enrich", "stream_archive", "stream_dedup", "stream_hourly", "aqi_forecast",
    "forecast_importance", "dedup_intervals", "held_intervals", "moments_hourly", "compact_measurements", "stream_alerts",
    "clustered_rows", "clustered_scan",
]


def seconds(spark, name: str) -> float:
    began = time.perf_counter()
    REGISTRY[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    spark = (
        builder("bench").master(f"local[{CPUS}]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in REGISTRY if os.environ.get("BENCH_ALL") else HEADLINE:
        if name in WRITING:
            times[name] = seconds(spark, name)
        else:
            seconds(spark, name)
            times[name] = statistics.median(seconds(spark, name) for _ in range(RUNS))
    times = {name: round(value, 3) for name, value in times.items()}
    sf = re.search(r"sf([\d.]+)", SF_DIR)
    print(json.dumps({
        "metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(sf.group(1)) if sf else SF_DIR,
    }))


if __name__ == "__main__":
    main()
