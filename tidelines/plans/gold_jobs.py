"""The three Gold tables: daily, hourly and combined."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import asdict
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidelines.functions.calendar import add_combined_calendar, add_daily_calendar, add_hourly_calendar
from tidelines.functions.wind import add_wind_vectors
from tidelines.operators.aggregate import daily_air_quality, daily_weather, station_aggregates
from tidelines.operators.clean import (
    add_placeholders,
    clip,
    complete_entities,
    drop_null_rows,
    latest_per_key,
    require,
)
from tidelines.operators.interpolate import interpolate
from tidelines.operators.joins import attach_group_stats, merge_panels
from tidelines.operators.normalise import (
    Stat,
    add_normalised,
    fit,
    normalise_in_place,
    numeric_columns,
    write_stats,
)
from tidelines.operators.spatial import transboundary_index
from tidelines.operators.splits import chronological_split
from tidelines.operators.windows import add_features, differences, lags, leads, percent_change, rolling
from tidelines.panel import Panel
from tidelines.plans.config import CombinedConfig, DailyConfig, HourlyConfig
from tidelines.schemas import LONG_POLLUTANTS
from tidelines.session import staged
from tidelines.sources import gold, silver

# Daily columns that are interpolated, and inputs that have no source yet.
DAILY_INTERPOLATED = [
    "temp_2m_mean",
    "temp_2m_min",
    "temp_2m_max",
    "rh_2m_mean",
    "pressure_mean",
    "precip_sum",
    "wind_speed_mean",
    "wind_u10_mean",
    "wind_v10_mean",
    "radiation_mean",
    "cloud_cover_mean",
]
MISSING_AIR_QUALITY = ["pm2_5_mean", "pm10_mean", "no2_mean", "o3_mean"]
HOTSPOT_COLUMNS = [
    "hotspot_count_th",
    "hotspot_count_mm",
    "hotspot_count_la",
    "hotspot_frp_sum",
    "transboundary_index",
]
# Columns of the hourly table that are never normalised, besides the target.
HOURLY_METADATA = [
    "stationID",
    "timestamp_utc",
    "timestamp_unix_ms",
    "data_source",
    "ingestion_timestamp_utc",
    "load_id",
    "pipeline_version",
    "record_hash",
    "lat",
    "lon",
]


def newest_readings(df: DataFrame) -> DataFrame:
    """One row per station and time: the last one ingested."""
    newest = [F.col(c).desc() for c in ("ingestion_timestamp_utc", "record_hash") if c in df.columns]
    # Older hashes name only station and time: readings of one ingestion that differ are told apart by all values.
    return latest_per_key(df, ["stationID", "timestamp_utc"], [*newest, F.xxhash64(*df.columns)])


def newest_counted(df: DataFrame) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """Newest readings, and a function that tells the rows read and dropped once the job has run.

    The counts are observed while the data passes, without a pass of their own.
    """
    read, kept = Observation(), Observation()
    rows = F.count(F.lit(1)).alias("rows")
    out = newest_readings(df.observe(read, rows)).observe(kept, rows)
    return out, lambda: {"rows_read": read.get["rows"], "rows_dropped": read.get["rows"] - kept.get["rows"]}


def add_hotspots(days: DataFrame, hotspots: DataFrame | None) -> DataFrame:
    """Fire counts and the transport index of each station day; nulls without a hotspot table.

    With one, a day out of reach of any fire has zeros. ``hotspots``: date, lat, lon, frp, country.
    """
    if hotspots is None:
        return add_placeholders(days, HOTSPOT_COLUMNS)
    places = days.select("stationID", "date", "lat", "lon", "wind_direction_mean")
    index = transboundary_index(hotspots, places)
    joined = days.join(index, ["stationID", "date"], "left")
    return joined.select(*days.columns, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in HOTSPOT_COLUMNS])


def daily_features(
    weather: DataFrame,
    air_quality: DataFrame | None,
    config: DailyConfig = DailyConfig(),
    hotspots: DataFrame | None = None,
) -> DataFrame:
    """Daily table up to, but without, the split.

    Lags and rolling statistics are taken before gaps are filled, so they carry the raw nulls. After the
    daily aggregate an entity has at most one row per day, so its windows are small whatever the share of
    raw rows it holds.
    """
    days = add_wind_vectors(
        daily_weather(
            weather,
            ties=config.ties,
            shift_hours=config.shift_hours,
            wind_mean=config.wind_mean,
        )
    )
    if air_quality is not None:
        merged = merge_panels(days, daily_air_quality(air_quality, ties=config.ties, shift_hours=config.shift_hours))
    else:
        merged = add_placeholders(days, MISSING_AIR_QUALITY)
    panel = Panel("stationID", "date")
    series = ["pm2_5_mean", "temp_2m_mean"]
    featured = add_features(
        merged,
        panel,
        lags(series, config.lag_days, "{c}_lag{k}"),
        rolling(series, config.rolling_windows, ("mean", "std"), "{c}_rolling_{stat}_{n}d"),
    )
    featured = add_hotspots(add_daily_calendar(featured), hotspots)
    if config.max_interpolation_gap_days > 0:
        gap = config.max_interpolation_gap_days if config.enforce_gap else None
        featured = interpolate(featured, panel, DAILY_INTERPOLATED, max_gap=gap)
    return clip(featured) if config.clip_outliers else featured


def daily_gold(
    weather: DataFrame,
    air_quality: DataFrame | None,
    config: DailyConfig = DailyConfig(),
    hotspots: DataFrame | None = None,
) -> tuple[DataFrame, list[Stat]]:
    """Daily table with split and normalised copies, and the fitted statistics.

    The features are staged once; cuts, statistics and the final table all read the staged files.
    """
    features = staged(daily_features(weather, air_quality, config, hotspots), "daily-features")
    table = chronological_split(
        features,
        ["date", "stationID"],
        config.train_ratio,
        config.val_ratio,
        config.test_ratio,
        config.whole_dates,
    )
    cols = numeric_columns(features, exclude=["lat", "lon", "latitude", "longitude", "elevation"])
    stats = fit(table.filter(F.col("split") == "train"), cols)
    return add_normalised(table, stats), stats


def hourly_features(air_quality: DataFrame, config: HourlyConfig = HourlyConfig(), panel: Panel | None = None) -> DataFrame:
    """Hourly table up to, but without, the split: complete rows only."""
    if panel is None:
        panel = Panel("stationID", "timestamp_utc", config.ties).fit(air_quality)
    target = config.target
    rows = air_quality
    if config.max_missing_ratio is not None:  # before rows without a target go: they are what is missing
        rows = complete_entities(rows, "stationID", target, config.max_missing_ratio)
    rows = require(rows, [target])
    if config.interpolate:
        rows = interpolate(rows, panel, LONG_POLLUTANTS, config.interpolation_method)
    dated = add_hourly_calendar(rows, weekend_from=config.weekend_from)
    featured = add_features(
        dated,
        panel,
        lags([target], config.lag_hours),
        rolling([target], config.rolling_windows),
        differences(target),
        percent_change(target, zero_div="ieee"),  # a change from zero is no missing value
        leads([target], [config.horizon]),
    )
    return drop_null_rows(featured)


def hourly_gold(
    air_quality: DataFrame, config: HourlyConfig = HourlyConfig(), panel: Panel | None = None
) -> tuple[DataFrame, list[Stat]]:
    """Hourly table with its split, normalised in place, and the fitted statistics."""
    features = staged(hourly_features(air_quality, config, panel), "hourly-features")
    keys = ["timestamp_utc", "stationID", *config.ties]
    table = chronological_split(features, keys, config.train_ratio, config.val_ratio, config.test_ratio)
    if not config.normalise:
        return table, []
    kept = {*HOURLY_METADATA, *config.ties, f"target_{config.target}_{config.horizon}h"}
    stats = fit(
        table.filter(F.col("split") == "train"), [c for c in features.columns if c not in kept], config.method
    )
    return normalise_in_place(table, stats), stats


def combined_gold(
    air_quality: DataFrame, config: CombinedConfig = CombinedConfig(), panel: Panel | None = None
) -> DataFrame:
    """Combined hourly table: calendar, lags, rolling statistics and long-run station levels.

    Rows without a target are removed last, so they still occupy a position in the windows.
    """
    if panel is None:
        panel = Panel("stationID", "timestamp_utc", config.ties).fit(air_quality)
    target = config.target
    featured = add_features(
        add_combined_calendar(air_quality, weekend_from=config.weekend_from),
        panel,
        lags([target], config.lag_hours),
        rolling([target], config.rolling_windows, ("mean", "std", "max", "min")),
    )
    leveled = attach_group_stats(featured, station_aggregates(air_quality), "stationID")
    return require(leveled.select(*featured.columns, "station_pm25_mean", "station_pm25_std", "station_pm10_mean"), [target])


def _now() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def run_daily_gold(
    spark: SparkSession,
    weather_path: str,
    air_quality_path: str | None,
    target: str,
    config: DailyConfig = DailyConfig(),
    hotspots: DataFrame | None = None,
    losses: str | None = None,
) -> dict[str, str]:
    """Silver folders, and fires if given, to Gold splits, statistics and manifest below ``target``."""
    weather = silver.read_weather(spark, weather_path)
    air = silver.read_optional_air_quality(spark, air_quality_path, losses) if air_quality_path else None
    counts = []
    if config.dedupe:
        weather, count = newest_counted(weather)
        counts.append(("weather", count))
        if air is not None:
            air, count = newest_counted(air)
            counts.append(("air_quality", count))
    short = silver.to_short_names(air) if air is not None else None
    table, stats = daily_gold(weather, short, config, hotspots)
    counted = {f"{name}_{k}" if name != "weather" else k: v for name, count in counts for k, v in count().items()}
    return _write_gold(spark, table, stats, target, "date", {**asdict(config), **counted}, config.version)


def run_hourly_gold(
    spark: SparkSession,
    generations: list[silver.Generation],
    target: str,
    config: HourlyConfig = HourlyConfig(),
    losses: str | None = None,
) -> dict[str, str]:
    air = silver.read_air_quality(spark, generations, config.years, losses)
    # Row counts per station before deduplication bound those after it.
    panel = Panel("stationID", "timestamp_utc", config.ties).fit(air)
    counts = dict  # nothing counted
    if config.dedupe:
        air, counts = newest_counted(air)
    table, stats = hourly_gold(air, config, panel)
    return _write_gold(spark, table, stats, target, "timestamp_utc", {**asdict(config), **counts()}, config.version)


def run_combined_gold(
    spark: SparkSession,
    generations: list[silver.Generation],
    target: str,
    config: CombinedConfig = CombinedConfig(),
    losses: str | None = None,
) -> dict[str, str]:
    air = silver.read_air_quality(spark, generations, config.years, losses)
    panel = Panel("stationID", "timestamp_utc", config.ties).fit(air)
    if config.dedupe:
        # Features and station levels both read it; staged, the source is scanned and deduplicated once.
        air = staged(newest_readings(air), "combined-readings")
    path = f"{target}/airquality_combined"
    gold.write_table(combined_gold(air, config, panel), path)
    return {"table": path}


def _write_gold(
    spark: SparkSession, table: DataFrame, stats: list[Stat], target: str, time: str, config: dict, version: str
) -> dict[str, str]:
    paths = {
        "splits": f"{target}/splits",
        "stats": f"{target}/normalization_stats",
        "manifest": f"{target}/manifest",
    }
    gold.write_splits(table, paths["splits"])
    write_stats(spark, stats, paths["stats"])
    # The manifest describes what was written, so it reads the written files (two columns of them).
    written = spark.read.parquet(paths["splits"]).select(*table.columns)
    gold.write_manifest(gold.manifest(written, time, config, version, _now()), paths["manifest"])
    return paths
