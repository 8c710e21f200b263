"""Jobs from written files to written files, all columns of their tables, and the stored side products."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelines.catalog.derived import DAILY_AQ, DAILY_WEATHER, OBS, W, bronze_docs, events, obs, silver_obs
from tidelines.catalog.feature_queries import TARGET
from tidelines.catalog.registry import day, query, r6
from tidelines.functions.geo import bearing_deg, haversine_km
from tidelines.functions.records import any_time
from tidelines.operators.clean import DAILY_BOUNDS, add_missing_columns
from tidelines.operators.normalise import read_stats, stats_frame
from tidelines.operators.quality import schema_diff, training_span
from tidelines.plans.config import CombinedConfig, DailyConfig
from tidelines.plans.gold_jobs import DAILY_INTERPOLATED, run_combined_gold, run_daily_gold
from tidelines.plans.silver_jobs import run_weather_to_silver
from tidelines.schemas import AIR_QUALITY_SILVER, WEATHER_SILVER
from tidelines.session import scratch_dir
from tidelines.sources import bronze, silver

# On some station days a sensor is silent, so that the daily job has gaps to fill.
_SILENT = {"temp_c": 3, "humidity_pct": 4, "wind_ms": 5}


def _weather_files(spark, sf_dir, path):
    """Silver weather files of the readings, with silent days."""
    number = F.dayofmonth("timestamp_utc") + F.substring("stationID", 3, 20).cast("int")
    o = obs(spark, sf_dir)
    quiet = o.withColumns({c: F.when(number % k != 0, F.col(c)) for c, k in _SILENT.items()})
    rows = quiet.withColumns(
        {
            "timestamp_unix_ms": F.unix_millis("timestamp_utc"),
            "data_source": F.lit("events"),
            "ingestion_timestamp_utc": F.lit("2024-02-01T00:00:00").cast("timestamp"),
            "pipeline_version": F.lit("1.0.1"),
            "record_hash": F.lpad(F.col("event_id").cast("string"), 20, "0"),
        }
    )
    # Doubles, which the reader takes as they are; floats would differ from SQL in the seventh digit.
    wide = [T.StructField(f.name, T.DoubleType() if isinstance(f.dataType, T.FloatType) else f.dataType) for f in WEATHER_SILVER]
    silver.write_silver(add_missing_columns(rows, T.StructType(wide)), path)


_QUIET = "quiet AS (SELECT * REPLACE (" + ", ".join(f"CASE WHEN (day(timestamp_utc) + user_id) % {k} <> 0 THEN {c} END AS {c}" for c, k in _SILENT.items()) + ") FROM obs)"
_LAGS = [(c, k) for c in ("pm2_5_mean", "temp_2m_mean") for k in (1, 2, 3)]
_ROLLING = [(c, n, s) for c in ("pm2_5_mean", "temp_2m_mean") for n in (3, 7, 14) for s in ("mean", "std")]
_AIR = ["pm2_5_mean", "pm10_mean", "no2_mean", "o3_mean", "so2_mean", "co_mean"]
_CYCLES = {"day_of_year": "dayofyear(date) * 2 * pi() / 365.25::DOUBLE", "month": "month(date) * 2 * pi() / 12"}


def _daily_sql() -> tuple[str, list[str]]:
    """The whole daily table: join, wind, lags, rolling statistics, calendar, filled gaps, bounds, split, scaled copies."""
    features = [f"lag({c}, {k}) OVER w AS {c}_lag{k}" for c, k in _LAGS]
    functions = {"mean": "avg", "std": "stddev_samp"}
    for c, n, s in _ROLLING:
        features.append(f"CASE WHEN count({c}) OVER w{n} = {n} THEN {functions[s]}({c}) OVER w{n} END AS {c}_rolling_{s}_{n}d")
    features += [f"{f}({angle}) AS {name}_{f}" for name, angle in _CYCLES.items() for f in ("sin", "cos")]
    windows = ", ".join(f"w{n} AS (PARTITION BY stationID ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)" for n in (3, 7, 14))
    ends = []
    for c in DAILY_INTERPOLATED:
        for side, frame in (("0", "b"), ("1", "a")):
            pick = "last_value" if side == "0" else "first_value"
            ends.append(f"{pick}({c} IGNORE NULLS) OVER {frame} AS {c}_x{side}, {pick}(CASE WHEN {c} IS NOT NULL THEN rn END IGNORE NULLS) OVER {frame} AS {c}_r{side}")
    filled = [f"coalesce({c}, {c}_x0 + ({c}_x1 - {c}_x0) * (rn - {c}_r0) / ({c}_r1 - {c}_r0)) AS {c}" for c in DAILY_INTERPOLATED]
    bounded = [f"least(greatest({c}, {lo}), {hi}) AS {c}" for c, (lo, hi) in DAILY_BOUNDS.items()]
    bounded = [f"CASE WHEN {c} IS NOT NULL THEN {b.rsplit(' AS ', 1)[0]} END AS {c}" for b, c in zip(bounded, DAILY_BOUNDS)]
    scaled = [
        *("temp_2m_mean temp_2m_min temp_2m_max rh_2m_mean pressure_mean precip_sum wind_speed_mean wind_direction_mean".split()),
        *("radiation_mean cloud_cover_mean wind_u10_mean wind_v10_mean".split()),
        *_AIR,
        *[f"{c}_lag{k}" for c, k in _LAGS],
        *[f"{c}_rolling_{s}_{n}d" for c, n, s in _ROLLING],
        *[f"{name}_{f}" for name in _CYCLES for f in ("sin", "cos")],
    ]
    stats = ", ".join(f"avg({c}) AS {c}_m, stddev_samp({c}) AS {c}_s" for c in scaled)
    out = [f"round({c}, 6) AS {c}" for c in scaled] + [f"CASE WHEN {c}_s > 1e-8 THEN round(({c} - {c}_m) / {c}_s, 5) END AS {c}_norm" for c in scaled]
    weather = DAILY_WEATHER.replace("FROM obs", "FROM quiet")
    sql = f"""WITH {OBS}, {_QUIET}, {weather}, {DAILY_AQ}, m AS (
  SELECT d.*, -wind_speed_mean * sin(radians(wind_direction_mean)) AS wind_u10_mean,
    -wind_speed_mean * cos(radians(wind_direction_mean)) AS wind_v10_mean, {", ".join("a." + c for c in _AIR)}
  FROM daily d LEFT JOIN daily_aq a USING (date, stationID)),
f AS (SELECT *, {", ".join(features)}, row_number() OVER w AS rn FROM m WINDOW w AS (PARTITION BY stationID ORDER BY date), {windows}),
e AS (SELECT *, {", ".join(ends)} FROM f WINDOW
  b AS (PARTITION BY stationID ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  a AS (PARTITION BY stationID ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
i AS (SELECT * REPLACE ({", ".join(filled)}) FROM e), c AS (SELECT * REPLACE ({", ".join(bounded)}) FROM i),
r AS (SELECT *, row_number() OVER (ORDER BY date, stationID) AS rk, count(*) OVER () AS n FROM c),
s AS (SELECT *, CASE WHEN rk <= floor(n * 0.7::DOUBLE) THEN 'train' WHEN rk <= floor(n * (0.7::DOUBLE + 0.15::DOUBLE)) THEN 'val'
  ELSE 'test' END AS split FROM r), t AS (SELECT {stats} FROM s WHERE split = 'train')"""
    return sql, out


_DAILY, _DAILY_OUT = _daily_sql()
_DAILY_NAMES = [c.rsplit(" AS ", 1)[1] for c in _DAILY_OUT]


def _daily_files(spark, sf_dir, purpose):
    root = scratch_dir(spark, purpose)
    _weather_files(spark, sf_dir, f"{root}/weather")
    silver.write_silver(silver_obs(spark, sf_dir), f"{root}/air")
    return run_daily_gold(spark, f"{root}/weather", f"{root}/air", f"{root}/gold", DailyConfig(dedupe=False))


@query(
    "daily_gold_files",
    f"{_DAILY} SELECT strftime(date, '%Y-%m-%d') AS date, stationID, split, round(lat, 6) AS lat, round(lon, 6) AS lon, load_id, {', '.join(_DAILY_OUT)} FROM s, t",
)
def daily_gold_files(spark, sf_dir):
    """The daily job from Silver files to Gold files, read back with all their columns but the hotspot placeholders."""
    back = spark.read.parquet(_daily_files(spark, sf_dir, "daily-job")["splits"])
    flat = [F.round(c, 5).alias(c) if c.endswith("_norm") else r6(c) for c in _DAILY_NAMES if c in back.columns]
    absent = [F.lit(None).cast("double").alias(c) for c in _DAILY_NAMES if c not in back.columns]  # no spread in the training rows
    return back.select(day(), "stationID", "split", r6("lat"), r6("lon"), "load_id", *flat, *absent)


@query(
    "daily_gold_statistics",
    f"{_DAILY}, u AS (UNPIVOT (SELECT COLUMNS('.*_(m|s)$') FROM t) ON * INTO NAME k VALUE v) "
    "SELECT m.k[:-3] AS feature, 'standard' AS method, round(m.v, 6) AS p1, round(s.v, 6) AS p2 FROM u m JOIN u s ON s.k = m.k[:-3] || '_s' WHERE m.k LIKE '%\\_m' ESCAPE '\\' AND s.v > 1e-8",
)
def daily_gold_statistics(spark, sf_dir):
    """The statistics file of the daily job, read back: the features that vary."""
    stats = read_stats(spark, _daily_files(spark, sf_dir, "daily-statistics")["stats"])
    return stats_frame(spark, stats).filter("p2 > 1e-8").select("feature", "method", r6("p1"), r6("p2"))


_COMBINED_STATS = {"mean": "avg", "std": "stddev_samp", "max": "max", "min": "min"}
_COMBINED = [(s, n) for n in (3, 6, 12, 24) for s in _COMBINED_STATS]


def _combined_sql() -> str:
    rolled = [f"CASE WHEN count({TARGET}) OVER r{n} = {n} THEN round({_COMBINED_STATS[s]}({TARGET}) OVER r{n}, 6) END AS {TARGET}_rolling_{s}_{n}h" for s, n in _COMBINED]
    lagged = [f"lag({TARGET}, {k}) OVER w AS {TARGET}_lag_{k}h" for k in (1, 3, 6, 12, 24)]
    turns = [f"round({f}({part}(timestamp_utc) * 2 * 3.14159::DOUBLE / {n}), 6) AS {part}_{f}" for part, n in (("hour", 24), ("month", 12)) for f in ("sin", "cos")]
    windows = ", ".join(f"r{n} AS ({W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)" for n in (3, 6, 12, 24))
    return f"""WITH {OBS}, s AS (SELECT stationID, avg({TARGET}) AS m, stddev_samp({TARGET}) AS d, avg(pm10_ugm3) AS p FROM obs GROUP BY 1),
f AS (SELECT stationID, event_id, {TARGET}, {", ".join(lagged + rolled + turns)}, CAST(year(timestamp_utc) AS INTEGER) AS year,
    CAST(month(timestamp_utc) AS INTEGER) AS month, CAST(day(timestamp_utc) AS INTEGER) AS day, CAST(hour(timestamp_utc) AS INTEGER) AS hour,
    CAST(isodow(timestamp_utc) AS INTEGER) AS weekday, CAST(dayofyear(timestamp_utc) AS INTEGER) AS day_of_year,
    hour(timestamp_utc) BETWEEN 6 AND 18 AS is_daytime, isodow(timestamp_utc) < 5 AS is_weekday
  FROM obs WINDOW w AS ({W}), {windows})
SELECT f.* EXCLUDE (event_id), lpad(event_id::VARCHAR, 20, '0') AS record_hash, round(m, 6) AS station_pm25_mean, round(d, 6) AS station_pm25_std,
  round(p, 6) AS station_pm10_mean FROM f JOIN s USING (stationID) WHERE {TARGET} IS NOT NULL"""


@query("combined_gold_files", _combined_sql())
def combined_gold_files(spark, sf_dir):
    """The combined job from files to its file, read back: the stored readings and all 36 derived columns."""
    root = scratch_dir(spark, "combined-job")
    silver.write_silver(silver_obs(spark, sf_dir), f"{root}/air")
    path = run_combined_gold(spark, [silver.Generation(f"{root}/air")], f"{root}/gold", CombinedConfig(dedupe=False))["table"]
    back = spark.read.parquet(path)
    made = [c for c in back.columns if c not in AIR_QUALITY_SILVER.names]
    exact = ("int", "boolean")
    kinds = dict(back.dtypes)
    return back.select("stationID", "record_hash", TARGET, *[F.col(c) if kinds[c] in exact else r6(c) for c in made])


@query(
    "sorted_files",
    f"""WITH {OBS}, {DAILY_WEATHER}, r AS (SELECT row_number() OVER (ORDER BY date, stationID) AS rk, count(*) OVER () AS n FROM daily)
SELECT 'silver' AS layer, count(*) AS rows, 0 AS out_of_order FROM obs UNION ALL
SELECT CASE WHEN rk <= floor(n * 0.7::DOUBLE) THEN 'train' WHEN rk <= floor(n * (0.7::DOUBLE + 0.15::DOUBLE)) THEN 'val' ELSE 'test' END, count(*), 0
  FROM r GROUP BY 1""",
)
def sorted_files(spark, sf_dir):
    """Rows per layer and split, and how many stand before an earlier row of their file."""
    root = scratch_dir(spark, "sorted")
    silver.write_silver(silver_obs(spark, sf_dir), f"{root}/air")
    splits = _daily_files(spark, sf_dir, "sorted-gold")["splits"]

    def check(path, layer, time):
        place = "PARTITION BY _metadata.file_path ORDER BY _metadata.row_index"
        later = F.expr(f"struct(stationID, {time}) < lag(struct(stationID, {time})) OVER ({place})")
        rows = spark.read.parquet(path).withColumn("_late", F.coalesce(later, F.lit(False)))
        return rows.groupBy(layer.alias("layer")).agg(F.count(F.lit(1)).alias("rows"), F.count_if("_late").cast("int").alias("out_of_order"))

    return check(f"{root}/air", F.lit("silver"), "timestamp_utc").unionByName(check(splits, F.col("split"), "date"))


def _weather_docs(spark, sf_dir):
    """One weather response per event, with two hours; file names carry the station."""
    e = events(spark, sf_dir)
    v, hour = F.col("value"), F.date_trunc("hour", "ts")
    at = lambda k: F.date_format(hour + F.make_dt_interval(hours=F.lit(k)), "yyyy-MM-dd'T'HH:mm")
    hourly = F.struct(
        F.array(at(0), at(1)).alias("time"),
        F.array(v / 10, v / 10 + 1).alias("temperature_2m"),
        F.array(v, v).alias("wind_speed_10m"),
        F.array(v * 3.6, F.lit(None).cast("double")).alias("wind_u_component_10m"),
        F.array(-v * 3.6, v * 3.6).alias("wind_v_component_10m"),
    )
    return e.select(F.concat(F.lit("st"), F.col("user_id")).alias("stationID"), F.lit(13.5).alias("latitude"), F.lit(100.25).alias("longitude"), hourly.alias("hourly"))


@query(
    "weather_silver_files",
    """WITH s AS (SELECT DISTINCT user_id, 10 + user_id % 7 * 0.5::DOUBLE AS lat FROM events WHERE user_id % 4 <> 0),
r AS (SELECT user_id, date_trunc('hour', ts) + to_hours(k) AS t, k, value FROM events, (SELECT unnest([0, 1]) AS k))
SELECT 'st' || user_id AS stationID, epoch_us(t) AS at_micros, lat, round(value / 10 + k, 4) AS temp_c, round(value, 4) AS wind_ms,
  CASE WHEN k = 0 THEN round(value, 4) END AS u10_ms, round(CASE WHEN k = 0 THEN -value ELSE value END, 4) AS v10_ms,
  substr(sha256('st' || user_id || '|' || strftime(t, '%Y-%m-%d %H:%M:%S') || '+00:00'), 1, 16) AS record_hash
FROM r LEFT JOIN s USING (user_id)""",
)
def weather_silver_files(spark, sf_dir):
    """Bronze weather to Silver files with the positions of a stored station table, read back through the weather scan."""
    root = scratch_dir(spark, "weather-job")
    bronze.write_bronze(_weather_docs(spark, sf_dir), f"{root}/bronze")
    users = events(spark, sf_dir).select("user_id").distinct().filter("user_id % 4 <> 0")
    station = users.select(F.concat(F.lit("st"), F.col("user_id")).alias("stationID"), (F.lit(10) + F.col("user_id") % 7 * 0.5).alias("lat"), F.lit(100.0).alias("lon"))
    station.write.parquet(f"{root}/stations")
    rows = run_weather_to_silver(
        spark, f"{root}/bronze", f"{root}/silver", data_source="events", load_id="w", ingested_at="2024-02-01T00:00:00",
        stations=silver.read_stations(spark, f"{root}/stations"), ledger=f"{root}/ledger",
    )
    return rows.select("stationID", F.unix_micros("timestamp_utc").alias("at_micros"), "lat", *[F.round(c, 4).alias(c) for c in ("temp_c", "wind_ms", "u10_ms", "v10_ms")], "record_hash")


@query(
    "station_names_in_paths",
    """SELECT 's_' || user_id AS stationID, count(*) AS documents, count(*) * 4 - count(*) FILTER (event_id % 50 = 0) AS hours
FROM events GROUP BY 1""",
)
def station_names_in_paths(spark, sf_dir):
    """Documents without a station, stored under names that carry it."""
    root = scratch_dir(spark, "named")
    docs = bronze_docs(spark, sf_dir).select("hourly", F.concat(F.lit("batch_20240101_1_s_"), F.substring("stationID", 3, 20), F.lit(".json")).alias("name"))
    # The documents of a name meet first, so that there is a file for each name and not one from each task as well.
    docs.repartition("name").write.partitionBy("name").option("compression", "none").json(f"{root}/docs")
    # Spark chooses its own file names; the folder stands for the file here.
    read = bronze.read_bronze(spark, f"{root}/docs").withColumn("file_path", F.regexp_replace("file_path", "^.*/name=([^/]+)/.*$", "/$1"))
    named = bronze.with_station(read)
    hours = F.size(F.filter(F.transform("hourly.time", any_time), lambda t: t.isNotNull()))
    return named.groupBy("stationID").agg(F.count(F.lit(1)).alias("documents"), F.sum(hours).alias("hours"))


@query(
    "added_columns",
    f"WITH {OBS} SELECT event_id, stationID, NULL::DOUBLE AS u10_ms, NULL::VARCHAR AS data_source, true AS complete FROM obs",
)
def added_columns(spark, sf_dir):
    """Rows of an older schema get the columns they lack; the difference of column sets is empty afterwards."""
    o = obs(spark, sf_dir).withColumn("record_hash", F.col("event_id").cast("string"))
    full = add_missing_columns(o, WEATHER_SILVER)
    lacking = schema_diff(full, WEATHER_SILVER)
    return full.select(F.col("record_hash").cast("bigint").alias("event_id"), "stationID", F.col("u10_ms").cast("double").alias("u10_ms"), "data_source", F.lit(not lacking["missing"]).alias("complete"))


@query(
    "training_span",
    f"""WITH {OBS}, t AS (SELECT CAST(timestamp_utc AS DATE) AS d, row_number() OVER (ORDER BY timestamp_utc, event_id) AS rk, count(*) OVER () AS n FROM obs)
SELECT CAST(max(d) - min(d) + 1 AS INTEGER) AS days, max(d) - min(d) + 1 >= 10 AS sufficient FROM t WHERE rk <= floor(n * 0.7::DOUBLE)""",
)
def training_span_query(spark, sf_dir):
    from tidelines.operators.splits import chronological_split

    o = chronological_split(obs(spark, sf_dir), ["timestamp_utc", "event_id"], 0.7, 0.15, 0.15)
    return training_span(o.withColumn("date", F.to_date("timestamp_utc")), "split", "date", 10)


@query(
    "distances",
    f"""WITH {OBS}, p AS (SELECT event_id, lat, lon, 13 + (event_id % 80) / 10.0::DOUBLE AS a, 97 + (event_id % 90) / 10.0::DOUBLE AS o FROM obs)
SELECT event_id, round(2 * 6371.0::DOUBLE * asin(sqrt(least(1.0::DOUBLE, pow(sin(radians(a - lat) / 2), 2)
    + cos(radians(lat)) * cos(radians(a)) * pow(sin(radians(o - lon) / 2), 2)))), 4) AS km,
  round((degrees(atan2(sin(radians(o - lon)) * cos(radians(a)),
    cos(radians(lat)) * sin(radians(a)) - sin(radians(lat)) * cos(radians(a)) * cos(radians(o - lon)))) + 360) % 360, 4) AS bearing FROM p""",
)
def distances(spark, sf_dir):
    event = F.col("event_id")
    place = [F.lit(13) + (event % 80) / F.lit(10.0), F.lit(97) + (event % 90) / F.lit(10.0)]
    here = [F.col("lat"), F.col("lon")]
    return obs(spark, sf_dir).select("event_id", F.round(haversine_km(*here, *place), 4).alias("km"), F.round(bearing_deg(*here, *place), 4).alias("bearing"))
