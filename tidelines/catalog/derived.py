"""Panel tables derived from ``events``, in Spark and as SQL common table expressions.

Every event becomes one reading; the station is the user. Nulls and implausible values are placed by
``event_id`` so that both engines see the same data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelines.panel import Panel

POLLUTANT_FACTORS = {"no2_ugm3": 0.4, "o3_ugm3": 0.6, "so2_ugm3": 0.1, "co_ugm3": 3.0}
TIES = ("event_id",)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def _unless(every: int, value: Column) -> Column:
    return F.when(F.col("event_id") % every != 0, value)


def obs_of(e: DataFrame) -> DataFrame:
    """Station readings, one per event."""
    value, user, event = F.col("value"), F.col("user_id"), F.col("event_id")
    return e.select(
        F.concat(F.lit("st"), user).alias("stationID"),
        F.col("ts").alias("timestamp_utc"),
        "event_id",
        (F.lit(13.64) + (user % 30) * F.lit(0.01)).alias("lat"),
        (F.lit(100.34) + (user % 53) * F.lit(0.01)).alias("lon"),
        _unless(7, value).alias("pm2_5_ugm3"),
        _unless(11, value * 1.5).alias("pm10_ugm3"),
        _unless(13, value * 0.4).alias("no2_ugm3"),
        (value * 0.6).alias("o3_ugm3"),
        (value * 0.1).alias("so2_ugm3"),
        (value * 3.0).alias("co_ugm3"),
        (F.lit(20.0) + value / 10).alias("temp_c"),
        value.alias("humidity_pct"),
        (F.lit(950) + event % 120).cast("double").alias("pressure_hpa"),
        F.when(user % 10 != 0, value / 50).alias("precipitation_mm"),
        (value / 10).alias("wind_ms"),
        ((event * 37) % 360).cast("double").alias("wind_dir_deg"),
        (F.hour("ts") * 40).cast("double").alias("shortwave_radiation_wm2"),
        (event % 101).cast("double").alias("cloud_cover_pct"),
        F.col("event_type").alias("load_id"),
    )


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return obs_of(events(spark, sf_dir))


def panel() -> Panel:
    return Panel("stationID", "timestamp_utc", TIES)


OBS = """obs AS (
  SELECT 'st' || user_id AS stationID, ts AS timestamp_utc, event_id, event_type, user_id, value,
    13.64::DOUBLE + (user_id % 30) * 0.01::DOUBLE AS lat,
    100.34::DOUBLE + (user_id % 53) * 0.01::DOUBLE AS lon,
    CASE WHEN event_id % 7 <> 0 THEN value END AS pm2_5_ugm3,
    CASE WHEN event_id % 11 <> 0 THEN value * 1.5::DOUBLE END AS pm10_ugm3,
    CASE WHEN event_id % 13 <> 0 THEN value * 0.4::DOUBLE END AS no2_ugm3,
    value * 0.6::DOUBLE AS o3_ugm3,
    value * 0.1::DOUBLE AS so2_ugm3,
    value * 3.0::DOUBLE AS co_ugm3,
    20.0::DOUBLE + value / 10 AS temp_c,
    value AS humidity_pct,
    (950 + event_id % 120)::DOUBLE AS pressure_hpa,
    CASE WHEN user_id % 10 <> 0 THEN value / 50 END AS precipitation_mm,
    value / 10 AS wind_ms,
    ((event_id * 37) % 360)::DOUBLE AS wind_dir_deg,
    (hour(ts) * 40)::DOUBLE AS shortwave_radiation_wm2,
    (event_id % 101)::DOUBLE AS cloud_cover_pct,
    event_type AS load_id
  FROM events)"""

# Window text shared by the oracles.
W = "PARTITION BY stationID ORDER BY timestamp_utc, event_id"

DAILY_WEATHER = """daily AS (
  SELECT CAST(timestamp_utc AS DATE) AS date, stationID,
    arg_min(lat, timestamp_utc) AS lat, arg_min(lon, timestamp_utc) AS lon,
    avg(temp_c) AS temp_2m_mean, min(temp_c) AS temp_2m_min, max(temp_c) AS temp_2m_max,
    avg(humidity_pct) AS rh_2m_mean, avg(pressure_hpa) AS pressure_mean,
    coalesce(sum(precipitation_mm), 0) AS precip_sum, avg(wind_ms) AS wind_speed_mean,
    avg(wind_dir_deg) AS wind_direction_mean, avg(shortwave_radiation_wm2) AS radiation_mean,
    avg(cloud_cover_pct) AS cloud_cover_mean, arg_min(load_id, timestamp_utc) AS load_id
  FROM obs GROUP BY 1, 2)"""

DAILY_AQ = """daily_aq AS (
  SELECT CAST(timestamp_utc AS DATE) AS date, stationID,
    arg_min(lat, timestamp_utc) AS lat, arg_min(lon, timestamp_utc) AS lon,
    avg(pm2_5_ugm3) AS pm2_5_mean, avg(pm10_ugm3) AS pm10_mean, avg(no2_ugm3) AS no2_mean,
    avg(o3_ugm3) AS o3_mean, avg(so2_ugm3) AS so2_mean, avg(co_ugm3) AS co_mean
  FROM obs GROUP BY 1, 2)"""

SPLIT = """ranked AS (
  SELECT *, row_number() OVER (ORDER BY timestamp_utc, stationID, event_id) AS rk, count(*) OVER () AS n FROM obs),
split_obs AS (
  SELECT *, CASE WHEN rk <= floor(n * 0.7::DOUBLE) THEN 'train'
                 WHEN rk <= floor(n * (0.7::DOUBLE + 0.15::DOUBLE)) THEN 'val' ELSE 'test' END AS split
  FROM ranked)"""


def silver_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings in the canonical 16-column Silver form, plus the tie-break ``event_id``."""
    o = obs(spark, sf_dir)
    return o.select(
        "stationID",
        "lat",
        "lon",
        "timestamp_utc",
        F.unix_millis("timestamp_utc").alias("timestamp_unix_ms"),
        "pm2_5_ugm3",
        "pm10_ugm3",
        F.col("no2_ugm3").alias("nitrogen_dioxide_ugm3"),
        F.col("o3_ugm3").alias("ozone_ugm3"),
        F.col("so2_ugm3").alias("sulphur_dioxide_ugm3"),
        F.col("co_ugm3").alias("carbon_monoxide_ugm3"),
        F.lit("events").alias("data_source"),
        F.lit("2024-02-01T00:00:00").cast("timestamp").alias("ingestion_timestamp_utc"),
        "load_id",
        F.lit("2.0.0").alias("pipeline_version"),
        # A fixed-width number sorts like the event id, which makes it the tie-break of the jobs.
        F.lpad(F.col("event_id").cast("string"), 20, "0").alias("record_hash"),
    )


def station_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly mean per event type: a panel with natural gaps."""
    return (
        events(spark, sf_dir)
        .groupBy(F.col("event_type").alias("stationID"), F.date_trunc("hour", "ts").alias("timestamp_utc"))
        .agg(F.avg("value").alias("pm2_5_ugm3"))
    )


def dealt(rows: DataFrame, size: int = 25_000) -> DataFrame:
    """Rows dealt out by event, about ``size`` to a task, however few parts their file can be read in."""
    return rows.repartition(max(1, -(-rows.count() // size)), "event_id")


def bronze_docs(spark: SparkSession, sf_dir: str, deal: bool = False) -> DataFrame:
    """One air-quality response per event: four hours from the event's hour.

    Arrays may be short or absent, pollutants come under long or short names, and every 50th document has a
    time that cannot be read. With ``deal`` the tasks that make them grow in number with the events.
    """
    e = events(spark, sf_dir).select("event_id", "user_id", "ts", "value")
    e = dealt(e) if deal else e
    v, event = F.col("value"), F.col("event_id")
    hour = F.date_trunc("hour", "ts")

    def at(k: int) -> Column:
        return F.date_format(hour + F.make_dt_interval(hours=F.lit(k)), "yyyy-MM-dd'T'HH:mm")

    last = F.when(event % 50 == 0, F.lit("not-a-time")).otherwise(at(3))
    even = event % 2 == 0
    pair = F.array(v * 0.4, v * 0.4 + 1, v * 0.4 + 2, v * 0.4 + 3)
    none = F.lit(None).cast("array<double>")
    hourly = F.struct(
        F.array(at(0), at(1), at(2), last).alias("time"),
        F.array(v, F.when(event % 7 != 0, v + 1), v + 2, v + 3).alias("pm2_5"),
        F.array(v * 1.5, v * 1.5 + 1).alias("pm10"),
        F.when(even, pair).otherwise(none).alias("nitrogen_dioxide"),
        none.alias("ozone"),
        none.alias("sulphur_dioxide"),
        F.array(v * 3.0).alias("carbon_monoxide"),
        F.when(even, none).otherwise(pair).alias("no2"),
        F.array(v * 0.6, v * 0.6, v * 0.6, v * 0.6, v * 0.6).alias("o3"),
        none.alias("so2"),
        none.alias("co"),
    )
    return e.select(
        F.concat(F.lit("st"), F.col("user_id")).alias("stationID"),
        (F.lit(13.5) + (F.col("user_id") % 3) * 0.25).alias("latitude"),
        (F.lit(100.25) + (F.col("user_id") % 5) * 0.25).alias("longitude"),
        F.lit(2.0).alias("elevation"),
        hourly.alias("hourly"),
        "event_id",
    )


BRONZE = """bronze AS (
  SELECT 'st' || user_id AS stationID, event_id, k, value,
    13.5::DOUBLE + (user_id % 3) * 0.25::DOUBLE AS lat, 100.25::DOUBLE + (user_id % 5) * 0.25::DOUBLE AS lon,
    date_trunc('hour', ts) + to_hours(k) AS stamp,
    strftime(date_trunc('hour', ts) + to_hours(k), '%Y-%m-%dT%H:%M') AS time_text,
    CASE WHEN k = 1 AND event_id % 7 = 0 THEN NULL ELSE value + k END AS pm2_5,
    CASE WHEN k < 2 THEN value * 1.5::DOUBLE + k END AS pm10,
    value * 0.4::DOUBLE + k AS no2,
    value * 0.6::DOUBLE AS o3,
    CASE WHEN k = 0 THEN value * 3.0::DOUBLE END AS co
  FROM events, (SELECT unnest([0, 1, 2, 3]) AS k)
  WHERE NOT (k = 3 AND event_id % 50 = 0))"""


def weather_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One weather response per event as JSON text, with every kind of defect among them."""
    e = events(spark, sf_dir)
    v, kind = F.col("value"), F.col("event_id") % 11
    hour = F.date_trunc("hour", "ts")

    def at(k: Column | int) -> Column:
        return F.date_format(hour + F.make_dt_interval(hours=F.lit(k)), "yyyy-MM-dd'T'HH:mm")

    times = (
        F.when(kind == 2, F.array(at(0), at(1)))
        .when(kind == 3, F.array(at(0), at(2), at(3)))
        .otherwise(F.array(at(0), at(1), at(2)))
    )
    u = F.when(kind == 4, F.array(v, F.lit(None).cast("double"), v)).otherwise(F.array(v, v, v))
    w = F.when(kind != 1, F.array(-v, F.lit(0.0), F.lit(0.0)))
    hourly = F.struct(times.alias("time"), u.alias("wind_u_component_10m"), w.alias("wind_v_component_10m"))
    text = F.to_json(F.struct(F.lit(13.5).alias("latitude"), hourly.alias("hourly")))
    return e.select("event_id", F.when(kind == 0, F.substring(text, 1, 40)).otherwise(text).alias("body"))


def air_quality_v1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First generation: short names, floats; even users."""
    s = silver_obs(spark, sf_dir).filter(F.substring("stationID", 3, 20).cast("bigint") % 2 == 0)
    renamed = s.withColumnsRenamed(
        {
            "nitrogen_dioxide_ugm3": "no2_ugm3",
            "ozone_ugm3": "o3_ugm3",
            "sulphur_dioxide_ugm3": "so2_ugm3",
            "carbon_monoxide_ugm3": "co_ugm3",
        }
    )
    floats = ["pm2_5_ugm3", "pm10_ugm3", "no2_ugm3", "o3_ugm3", "so2_ugm3", "co_ugm3"]
    return renamed.withColumns({**{c: F.col(c).cast("float") for c in floats}, "pipeline_version": F.lit("1.0.0")})


def air_quality_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second generation: long names, doubles, ingestion time as text; odd users."""
    s = silver_obs(spark, sf_dir).filter(F.substring("stationID", 3, 20).cast("bigint") % 2 == 1)
    return s.withColumn("ingestion_timestamp_utc", F.lit("2024-02-01T00:00:00"))


def hotspots(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = F.col("event_id")
    return events(spark, sf_dir).select(
        F.to_date("ts").alias("date"),
        (F.lit(13) + (event % 80) / F.lit(10.0)).alias("lat"),
        (F.lit(97) + (event % 90) / F.lit(10.0)).alias("lon"),
        F.col("value").alias("frp"),
        F.element_at(F.array(F.lit("th"), F.lit("mm"), F.lit("la")), (event % 3 + 1).cast("int")).alias("country"),
    )
