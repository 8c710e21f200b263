"""Time the headline queries at ``$BENCH_SF_DIR`` and print one JSON line.

Each query runs once to warm up and then ``BENCH_REPEATS`` times; the best time counts. Results go to
Spark's noop sink, so every column of every row is computed.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidelines import build_session  # noqa: E402
from tidelines.catalog import QUERIES  # noqa: E402
from tidelines.plans.config import DailyConfig  # noqa: E402
from tidelines.plans.gold_jobs import daily_gold, newest_readings  # noqa: E402
from tidelines.session import staged  # noqa: E402

HEADLINE = [
    "job_daily_gold",
    "job_hourly_gold",
    "job_combined_gold",
    "daily_weather_agg",
    "weather_aq_left_join",
    "lag_hourly",
    "rolling_mean_std",
    "interpolate_linear",
    "chrono_split",
    "zscore_train",
    "dedupe_latest",
    "unnest_bronze",
    "column_profile",
    "quantiles",
    "transboundary_index",
    "forecast_metrics",
]


#: The size of the published daily table: stations and hours of its source, about 5.3 million rows.
STATIONS, HOURS = 79, 67_000
PANEL = f"job_daily_gold_{STATIONS * HOURS}_rows"


def hourly_panel(spark):
    """Hourly weather of all stations, stored once before any time is taken."""
    row = spark.range(STATIONS * HOURS)
    value = lambda k, span: (F.pmod(F.xxhash64("id", F.lit(k)), F.lit(10_000)) * (span / 10_000)).cast("double")
    names = ["temp_c", "humidity_pct", "pressure_hpa", "precipitation_mm", "wind_ms", "wind_dir_deg", "shortwave_radiation_wm2", "cloud_cover_pct"]
    spans = [40, 100, 1100, 5, 20, 360, 1000, 100]
    at = F.timestamp_seconds(F.lit(1_483_228_800) + F.floor(F.col("id") / STATIONS) * 3600)
    return staged(
        row.select(
            F.concat(F.lit("st"), F.col("id") % STATIONS).alias("stationID"),
            F.lit(13.7).alias("lat"),
            F.lit(100.5).alias("lon"),
            at.alias("timestamp_utc"),
            *[value(k, span).alias(name) for k, (name, span) in enumerate(zip(names, spans))],
            F.lit("bench").alias("load_id"),
            at.alias("ingestion_timestamp_utc"),
            F.md5(F.col("id").cast("string")).alias("record_hash"),
        ),
        "bench-panel",
    )


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    names = sys.argv[1:] or [*HEADLINE, PANEL]
    spark = build_session(
        "tidelines-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            # The tables are a few megabytes; the default minimum of 1 MB would leave most cores idle.
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
            "spark.python.sql.dataFrameDebugging.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        times = []
        run = QUERIES.get(name)
        if name == PANEL:
            panel = hourly_panel(spark)
            run = lambda *_: daily_gold(newest_readings(panel), None, DailyConfig())[0]
        for _ in range(1 + repeats):
            start = time.perf_counter()
            run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times[1:] or times), 3)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))


if __name__ == "__main__":
    main()
