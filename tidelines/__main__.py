"""Command line: ``spark-submit -m tidelines <job> ...`` or ``python -m tidelines <job> ...``."""

from __future__ import annotations

import argparse
from datetime import date, timedelta

from pyspark.sql import functions as F

from tidelines.operators.quality import column_profile, split_inspection, station_coverage, temporal_coverage
from tidelines.plans.config import CombinedConfig, HourlyConfig
from tidelines.plans.gold_jobs import run_combined_gold, run_daily_gold, run_hourly_gold
from tidelines.plans.silver_jobs import backfill_plan, done_periods, run_bronze_to_silver, run_weather_to_silver
from tidelines.session import build_session
from tidelines.sources import bronze, inventory, silver


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tidelines")
    parser.add_argument("--master", help="only for local runs, for example local[8]")
    parser.add_argument("--shared", help="folder that the driver and all executors share (spark.checkpoint.dir)")
    jobs = parser.add_subparsers(dest="job", required=True)

    daily = jobs.add_parser("daily-gold", help="Silver weather and air quality to the daily table")
    daily.add_argument("weather")
    daily.add_argument("target")
    daily.add_argument("--air-quality")
    daily.add_argument("--hotspots", help="Parquet table of fires: date, lat, lon, frp, country")
    daily.add_argument("--losses", help="folder for a report of unreadable files; without it they end the job")

    for name in ("hourly-gold", "combined-gold"):
        job = jobs.add_parser(name, help="Silver air quality to the " + name.replace("-gold", " table"))
        job.add_argument("target")
        job.add_argument("source", nargs="+", help="folder per schema generation, path[:ingestion type]")
        job.add_argument("--years", type=int, nargs="+", help="all years unless given")
        job.add_argument("--losses", help="folder for a report of unreadable files; without it they end the job")

    for name in ("bronze-to-silver", "weather-to-silver"):
        load = jobs.add_parser(name, help="raw documents to Silver: air quality or weather")
        load.add_argument("source")
        load.add_argument("target")
        load.add_argument("--stations")
        load.add_argument("--data-source", required=True)
        load.add_argument("--load-id", required=True)
        load.add_argument("--ingested-at", required=True)
        load.add_argument("--losses", help="folder for a report of lost files and documents; without it they end the job")
        load.add_argument("--ledger", help="folder that notes loaded files, so that a repeated job loads new ones only")
    jobs.choices["bronze-to-silver"].add_argument("--checksums")
    jobs.choices["weather-to-silver"].add_argument("--numbers", help="Parquet table (number, stationID) of numbered files")

    plan = jobs.add_parser("backfill-plan", help="station periods without wind components in Bronze")
    plan.add_argument("stations")
    plan.add_argument("bronze")
    plan.add_argument("target", help="folder for the work list")
    plan.add_argument("--start", default="2010-01-01")
    plan.add_argument("--end", help="last day to plan; yesterday unless given")
    plan.add_argument("--numbers", help="Parquet table (number, stationID) of numbered files")
    plan.add_argument("--only", nargs="*", help="station ids")

    inspect = jobs.add_parser("inspect", help="quality report of a Silver or Gold table")
    inspect.add_argument("path")
    inspect.add_argument("--layer", choices=["silver", "gold"], default="silver")

    layers = jobs.add_parser("inventory", help="files and bytes per layer, name=path")
    layers.add_argument("layers", nargs="+")
    return parser


def _generations(sources: list[str]) -> list[silver.Generation]:
    kinds = ("timestamp", "timestamp_ntz", "string")
    out = []
    for source in sources:
        path, _, kind = source.rpartition(":")  # without a kind, every file is looked at
        out.append(silver.Generation(path, kind) if kind in kinds else silver.Generation(source))
    return out


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    shared = {"spark.checkpoint.dir": args.shared} if args.shared else {}
    spark = build_session(master=args.master, **shared)
    years = tuple(args.years) if getattr(args, "years", None) else None
    if args.job == "daily-gold":
        fires = spark.read.parquet(args.hotspots) if args.hotspots else None
        print(run_daily_gold(spark, args.weather, args.air_quality, args.target, hotspots=fires, losses=args.losses))
    elif args.job == "hourly-gold":
        print(run_hourly_gold(spark, _generations(args.source), args.target, HourlyConfig(years=years), args.losses))
    elif args.job == "combined-gold":
        print(run_combined_gold(spark, _generations(args.source), args.target, CombinedConfig(years=years), args.losses))
    elif args.job in ("bronze-to-silver", "weather-to-silver"):
        load = {"data_source": args.data_source, "load_id": args.load_id, "ingested_at": args.ingested_at, "losses": args.losses, "ledger": args.ledger}
        load["stations"] = silver.read_stations(spark, args.stations) if args.stations else None
        if args.job == "bronze-to-silver":
            run_bronze_to_silver(spark, args.source, args.target, **load, checksums=args.checksums)
        else:
            numbers = spark.read.parquet(args.numbers) if args.numbers else None
            run_weather_to_silver(spark, args.source, args.target, **load, numbered=numbers)
    elif args.job == "backfill-plan":
        stations = silver.read_stations(spark, args.stations)
        if args.only:
            stations = stations.filter(F.col("stationID").isin(args.only))
        done = done_periods(spark, args.bronze, spark.read.parquet(args.numbers) if args.numbers else None)
        end = args.end or (date.today() - timedelta(days=1)).isoformat()
        backfill_plan(stations, done, args.start, end).write.mode("overwrite").parquet(args.target)
    elif args.job == "inspect":
        df = spark.read.parquet(args.path)
        if args.layer == "gold":
            reports = [split_inspection(df, "split", "date", "stationID", "pm2_5_mean")]
        else:
            reports = [column_profile(df), temporal_coverage(df), station_coverage(df)]
        for report in reports:
            report.show(len(df.columns) + 10, truncate=False)  # one row per column or split
    else:
        layers = dict(item.split("=", 1) for item in args.layers)
        inventory.layer_inventory(spark, layers).show(len(layers), truncate=False)


if __name__ == "__main__":
    main()
