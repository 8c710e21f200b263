"""Row-level feature, cleaning, split and normalisation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelines.catalog.derived import DAILY_AQ, DAILY_WEATHER, OBS, SPLIT, TIES, W, obs, panel, station_hours
from tidelines.catalog.registry import day, moment, query, r6
from tidelines.functions.calendar import (
    SHORT_PI,
    add_combined_calendar,
    add_daily_calendar,
    add_hourly_calendar,
    cyclic,
)
from tidelines.functions.wind import add_wind_vectors, wind_consistent, wind_direction, wind_speed
from tidelines.operators.aggregate import daily_air_quality, daily_weather
from tidelines.operators.clean import (
    clip,
    complete_entities,
    drop_null_rows,
    filter_rows,
    keep_entities,
    require,
)
from tidelines.operators.evaluate import banded_metrics, error_metrics, persistence_forecast
from tidelines.operators.interpolate import interpolate
from tidelines.operators.joins import merge_panels
from tidelines.operators.normalise import add_normalised, fit, normalise_in_place, stats_frame
from tidelines.operators.rank import ordinal_rank, position_slice
from tidelines.operators.splits import (
    chronological_split,
    fixed_split,
    fold_normalised,
    fold_statistics,
    fold_tests,
    walk_forward_folds,
)
from tidelines.operators.windows import (
    add_features,
    differences,
    lags,
    leads,
    percent_change,
    rolling,
    rolling_error,
    sequences,
    time_gaps,
)
from tidelines.panel import Panel

TARGET = "pm2_5_ugm3"
SPLIT_KEYS = ["timestamp_utc", "stationID", "event_id"]


def _fitted(spark, sf_dir):
    o = obs(spark, sf_dir)
    return o, panel().fit(o)


def _r(cols: str) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in cols.split())


WEATHER_COLS = (
    "lat lon temp_2m_mean temp_2m_min temp_2m_max rh_2m_mean pressure_mean precip_sum wind_speed_mean "
    "wind_direction_mean radiation_mean cloud_cover_mean"
)
AQ_COLS = "lat lon pm2_5_mean pm10_mean no2_mean o3_mean so2_mean co_mean"


@query(
    "daily_weather_agg",
    f"WITH {OBS}, {DAILY_WEATHER} SELECT strftime(date, '%Y-%m-%d') AS date, stationID, {_r(WEATHER_COLS)}, load_id FROM daily",
)
def daily_weather_agg(spark, sf_dir):
    d = daily_weather(obs(spark, sf_dir), ties=TIES)
    return d.select(day(), "stationID", *[r6(c) for c in WEATHER_COLS.split()], "load_id")


@query(
    "daily_aq_agg",
    f"WITH {OBS}, {DAILY_AQ} SELECT strftime(date, '%Y-%m-%d') AS date, stationID, {_r(AQ_COLS)} FROM daily_aq",
)
def daily_aq_agg(spark, sf_dir):
    d = daily_air_quality(obs(spark, sf_dir), ties=TIES)
    return d.select(day(), "stationID", *[r6(c) for c in AQ_COLS.split()])


_JOINED = "lat lon temp_2m_mean precip_sum pm2_5_mean pm10_mean o3_mean"


@query(
    "weather_aq_left_join",
    f"""WITH {OBS}, {DAILY_WEATHER}, {DAILY_AQ.replace("FROM obs", "FROM obs WHERE pm2_5_ugm3 IS NOT NULL")}
SELECT strftime(d.date, '%Y-%m-%d') AS date, d.stationID, round(d.lat, 6) AS lat, round(d.lon, 6) AS lon,
  {_r("temp_2m_mean precip_sum pm2_5_mean pm10_mean o3_mean")}
FROM daily d LEFT JOIN daily_aq a ON d.date = a.date AND d.stationID = a.stationID""",
)
def weather_aq_left_join(spark, sf_dir):
    o = obs(spark, sf_dir)
    air = daily_air_quality(require(o, [TARGET]), ties=TIES)
    m = merge_panels(daily_weather(o, ties=TIES), air)
    return m.select(day(), "stationID", *[r6(c) for c in _JOINED.split()])


@query(
    "weather_aq_full_join",
    f"""WITH {OBS}, {DAILY_WEATHER.replace("FROM obs", "FROM obs WHERE precipitation_mm IS NOT NULL")},
{DAILY_AQ.replace("FROM obs", "FROM obs WHERE pm2_5_ugm3 IS NOT NULL")}
SELECT strftime(coalesce(d.date, a.date), '%Y-%m-%d') AS date, coalesce(d.stationID, a.stationID) AS stationID,
  round(coalesce(d.lat, a.lat), 6) AS lat, round(coalesce(d.lon, a.lon), 6) AS lon,
  {_r("temp_2m_mean precip_sum pm2_5_mean pm10_mean o3_mean")}
FROM daily d FULL JOIN daily_aq a ON d.date = a.date AND d.stationID = a.stationID""",
)
def weather_aq_full_join(spark, sf_dir):
    o = obs(spark, sf_dir)
    weather = daily_weather(require(o, ["precipitation_mm"]), ties=TIES)
    air = daily_air_quality(require(o, [TARGET]), ties=TIES)
    m = merge_panels(weather, air, how="full")
    return m.select(day(), "stationID", *[r6(c) for c in _JOINED.split()])


_UV = "-wind_ms * sin(radians(wind_dir_deg)) AS u, -wind_ms * cos(radians(wind_dir_deg)) AS v"


def _vectors(spark, sf_dir):
    return add_wind_vectors(obs(spark, sf_dir), "wind_ms", "wind_dir_deg", "u", "v")


@query("wind_decompose", f"WITH {OBS}, uv AS (SELECT event_id, {_UV} FROM obs) SELECT event_id, {_r('u v')} FROM uv")
def wind_decompose(spark, sf_dir):
    return _vectors(spark, sf_dir).select("event_id", r6("u"), r6("v"))


@query(
    "wind_recompose",
    f"""WITH {OBS}, uv AS (SELECT event_id, {_UV} FROM obs)
SELECT event_id, round(sqrt(u * u + v * v), 6) AS speed,
  round((degrees(atan2(-u, -v)) + 360) % 360, 6) AS direction FROM uv""",
)
def wind_recompose(spark, sf_dir):
    u, v = F.col("u"), F.col("v")
    return _vectors(spark, sf_dir).select("event_id", r6(wind_speed(u, v), "speed"), r6(wind_direction(u, v), "direction"))


@query(
    "wind_consistency",
    f"""WITH {OBS}, uv AS (SELECT wind_ms + (event_id % 3) * 0.15::DOUBLE AS stored, {_UV} FROM obs)
SELECT count(*) AS n, count(*) FILTER (abs(stored - sqrt(u * u + v * v)) < 0.1) AS consistent,
  round(max(abs(stored - sqrt(u * u + v * v))), 6) AS max_difference FROM uv""",
)
def wind_consistency(spark, sf_dir):
    uv = _vectors(spark, sf_dir).withColumn("stored", F.col("wind_ms") + (F.col("event_id") % 3) * 0.15)
    difference = F.abs(F.col("stored") - wind_speed(F.col("u"), F.col("v")))
    return uv.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(wind_consistent("stored", "u", "v")).alias("consistent"),
        r6(F.max(difference), "max_difference"),
    )


@query(
    "vector_mean_wind",
    f"""WITH {OBS}, uv AS (SELECT CAST(timestamp_utc AS DATE) AS date, stationID, {_UV} FROM obs),
m AS (SELECT date, stationID, avg(u) AS u, avg(v) AS v FROM uv GROUP BY 1, 2)
SELECT strftime(date, '%Y-%m-%d') AS date, stationID,
  round((degrees(atan2(-u, -v)) + 360) % 360, 6) AS wind_direction_mean FROM m""",
)
def vector_mean_wind(spark, sf_dir):
    d = daily_weather(obs(spark, sf_dir), ties=TIES, wind_mean="vector")
    return d.select(day(), "stationID", r6("wind_direction_mean"))


HOURLY_LAGS = [1, 2, 3, 6, 12, 24]


@query(
    "lag_hourly",
    f"WITH {OBS} SELECT event_id, "
    + ", ".join(f"lag({TARGET}, {k}) OVER w AS {TARGET}_lag_{k}h" for k in HOURLY_LAGS)
    + f" FROM obs WINDOW w AS ({W})",
)
def lag_hourly(spark, sf_dir):
    o, p = _fitted(spark, sf_dir)
    out = add_features(o, p, lags([TARGET], HOURLY_LAGS))
    return out.select("event_id", *[f"{TARGET}_lag_{k}h" for k in HOURLY_LAGS])


_DAILY_SERIES = ["pm2_5_mean", "temp_2m_mean"]


@query(
    "lag_daily",
    f"""WITH {OBS}, {DAILY_WEATHER}, {DAILY_AQ}, m AS (
  SELECT d.date, d.stationID, temp_2m_mean, pm2_5_mean FROM daily d LEFT JOIN daily_aq a USING (date, stationID))
SELECT strftime(date, '%Y-%m-%d') AS date, stationID, """
    + ", ".join(f"round(lag({c}, {k}) OVER w, 6) AS {c}_lag{k}" for c in _DAILY_SERIES for k in (1, 2, 3))
    + " FROM m WINDOW w AS (PARTITION BY stationID ORDER BY date)",
)
def lag_daily(spark, sf_dir):
    o = obs(spark, sf_dir)
    m = merge_panels(daily_weather(o, ties=TIES), daily_air_quality(o, ties=TIES))
    out = add_features(m, Panel("stationID", "date"), lags(_DAILY_SERIES, (1, 2, 3), "{c}_lag{k}"))
    return out.select(day(), "stationID", *[r6(f"{c}_lag{k}") for c in _DAILY_SERIES for k in (1, 2, 3)])


def _rolling_sql(fn: str, name: str, n: int) -> str:
    frame = f"({W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return (
        f"CASE WHEN count({TARGET}) OVER {frame} = {n} "
        f"THEN round({fn}({TARGET}) OVER {frame}, 6) END AS {TARGET}_rolling_{name}_{n}h"
    )


def _rolling_query(spark, sf_dir, stats):
    o, p = _fitted(spark, sf_dir)
    out = add_features(o, p, rolling([TARGET], [3, 6, 12, 24], stats))
    return out.select("event_id", *[r6(f"{TARGET}_rolling_{s}_{n}h") for n in (3, 6, 12, 24) for s in stats])


@query(
    "rolling_mean_std",
    f"WITH {OBS} SELECT event_id, "
    + ", ".join(_rolling_sql(fn, s, n) for n in (3, 6, 12, 24) for fn, s in (("avg", "mean"), ("stddev_samp", "std")))
    + " FROM obs",
)
def rolling_mean_std(spark, sf_dir):
    return _rolling_query(spark, sf_dir, ["mean", "std"])


@query(
    "rolling_min_max",
    f"WITH {OBS} SELECT event_id, "
    + ", ".join(_rolling_sql(s, s, n) for n in (3, 6, 12, 24) for s in ("min", "max"))
    + " FROM obs",
)
def rolling_min_max(spark, sf_dir):
    return _rolling_query(spark, sf_dir, ["min", "max"])


@query(
    "lead_target",
    f"WITH {OBS} SELECT event_id, lead({TARGET}, 24) OVER ({W}) AS target_{TARGET}_24h FROM obs",
)
def lead_target(spark, sf_dir):
    o, p = _fitted(spark, sf_dir)
    return add_features(o, p, leads([TARGET], [24])).select("event_id", f"target_{TARGET}_24h")


@query(
    "diff_pct_change",
    f"""WITH {OBS}, l AS (SELECT event_id, {TARGET} AS c, lag({TARGET}, 1) OVER w AS l1, lag({TARGET}, 24) OVER w AS l24
FROM obs WINDOW w AS ({W}))
SELECT event_id, round(c - l1, 6) AS {TARGET}_diff_1h, round(c - l24, 6) AS {TARGET}_diff_24h,
  round((c - l1) / nullif(l1, 0) * 100, 6) AS {TARGET}_pct_change_1h FROM l""",
)
def diff_pct_change(spark, sf_dir):
    o, p = _fitted(spark, sf_dir)
    out = add_features(o, p, differences(TARGET), percent_change(TARGET))
    return out.select("event_id", *[r6(f"{TARGET}_{s}") for s in ("diff_1h", "diff_24h", "pct_change_1h")])


@query(
    "rolling_error",
    f"""WITH {OBS}, p AS (SELECT *, lag(wind_ms, 1) OVER ({W}) AS predicted FROM obs)
SELECT event_id, CASE WHEN count(abs(wind_ms - predicted)) OVER f = 7
  THEN round(avg(abs(wind_ms - predicted)) OVER f, 6) END AS rolling_mae
FROM p WINDOW f AS ({W} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
)
def rolling_error_query(spark, sf_dir):
    o, p = _fitted(spark, sf_dir)
    predicted = add_features(o, p, lags(["wind_ms"], [1], "predicted"))
    return add_features(predicted, p, rolling_error("wind_ms", "predicted", 7)).select("event_id", r6("rolling_mae"))


@query(
    "sequence_windows",
    f"""WITH {OBS} SELECT event_id,
  CASE WHEN row_number() OVER w >= 30 THEN
    list_aggregate(list_transform(list(value) OVER (w ROWS BETWEEN 29 PRECEDING AND CURRENT ROW),
      lambda x: CAST(x AS VARCHAR)), 'string_agg', ',') END AS sequence,
  lead(value, 1) OVER w AS target_1, lead(value, 3) OVER w AS target_3
FROM obs WINDOW w AS ({W})""",
)
def sequence_windows(spark, sf_dir):
    o, p = _fitted(spark, sf_dir)
    out = add_features(
        o, p, sequences(["humidity_pct", "wind_ms"], 30), leads(["humidity_pct"], [1, 3], "target_{k}")
    )
    text = F.array_join(F.transform("sequence", lambda s: s["humidity_pct"].cast("string")), ",")
    return out.select("event_id", text.alias("sequence"), "target_1", "target_3")


@query(
    "calendar_features",
    f"""WITH {OBS} SELECT event_id, hour(timestamp_utc) AS hour, day(timestamp_utc) AS day,
  month(timestamp_utc) AS month, isodow(timestamp_utc) AS day_of_week, year(timestamp_utc) AS year,
  (isodow(timestamp_utc) >= 5)::INT AS is_weekend, (isodow(timestamp_utc) < 5)::INT AS is_weekday,
  (hour(timestamp_utc) BETWEEN 6 AND 18)::INT AS is_daytime, dayofyear(timestamp_utc) AS day_of_year,
  strftime(timestamp_utc, '%Y-%m-%d') AS date FROM obs""",
)
def calendar_features(spark, sf_dir):
    o = obs(spark, sf_dir)
    hourly = add_hourly_calendar(o).select(
        "event_id", "timestamp_utc", "hour", "day", "month", "day_of_week", "year", "is_weekend"
    )
    t = hourly.drop("hour", "day", "month", "year")
    both = add_combined_calendar(t)
    return both.select(
        "event_id",
        "hour",
        "day",
        "month",
        "day_of_week",
        "year",
        F.col("is_weekend").cast("int").alias("is_weekend"),
        F.col("is_weekday").cast("int").alias("is_weekday"),
        F.col("is_daytime").cast("int").alias("is_daytime"),
        "day_of_year",
        day("timestamp_utc"),
    )


def _cyc(value: str, period: str, name: str, pi: str = "pi()") -> str:
    angle = f"({value}) * 2 * {pi} / {period}"
    return f"round(sin({angle}), 6) AS {name}_sin, round(cos({angle}), 6) AS {name}_cos"


@query(
    "cyclic_features",
    f"""WITH {OBS}, t AS (SELECT event_id, timestamp_utc AS t FROM obs)
SELECT event_id, {_cyc("hour(t)", "24", "hour")}, {_cyc("month(t) - 1", "12", "month")}, {_cyc("isodow(t)", "7", "dow")},
  {_cyc("dayofyear(t)", "365.25::DOUBLE", "day_of_year")}, {_cyc("month(t)", "12", "month_daily")},
  {_cyc("hour(t)", "24", "hour_short_pi", "3.14159::DOUBLE")} FROM t""",
)
def cyclic_features(spark, sf_dir):
    o = obs(spark, sf_dir).select("event_id", "timestamp_utc")
    names = ["hour", "month", "dow"]
    hourly = add_hourly_calendar(o).select("event_id", "timestamp_utc", *[f"{n}_{s}" for n in names for s in ("sin", "cos")])
    daily = add_daily_calendar(hourly.withColumnsRenamed({"month_sin": "m_sin", "month_cos": "m_cos"}), "timestamp_utc")
    daily = daily.withColumnsRenamed(
        {"month_sin": "month_daily_sin", "month_cos": "month_daily_cos", "m_sin": "month_sin", "m_cos": "month_cos"}
    )
    out = daily.select("*", *cyclic(F.hour("timestamp_utc"), 24, "hour_short_pi", pi=SHORT_PI))
    cols = [f"{n}_{s}" for n in [*names, "day_of_year", "month_daily", "hour_short_pi"] for s in ("sin", "cos")]
    return out.select("event_id", *[r6(c) for c in cols])


@query(
    "clip_outliers",
    f"""WITH {OBS} SELECT event_id, round(least(greatest(temp_c, -10), 55), 6) AS temp_c,
  round(least(greatest(humidity_pct, 0), 100), 6) AS humidity_pct,
  round(least(greatest(pressure_hpa, 950), 1050), 6) AS pressure_hpa,
  CASE WHEN {TARGET} IS NOT NULL THEN round(least(greatest({TARGET}, 0), 100), 6) END AS {TARGET} FROM obs""",
)
def clip_outliers(spark, sf_dir):
    bounds = {"temp_c": (-10, 55), "humidity_pct": (0, 100), "pressure_hpa": (950, 1050), TARGET: (0, 100)}
    return clip(obs(spark, sf_dir), bounds).select("event_id", *[r6(c) for c in bounds])


@query(
    "drop_null_rows",
    f"""WITH {OBS} SELECT event_id, {TARGET}, round(pm10_ugm3, 6) AS pm10_ugm3, round(precipitation_mm, 6) AS precipitation_mm
FROM obs WHERE {TARGET} IS NOT NULL AND pm10_ugm3 IS NOT NULL AND precipitation_mm IS NOT NULL""",
)
def drop_null_rows_query(spark, sf_dir):
    cols = obs(spark, sf_dir).select("event_id", TARGET, "pm10_ugm3", "precipitation_mm")
    return drop_null_rows(cols).select("event_id", TARGET, r6("pm10_ugm3"), r6("precipitation_mm"))


@query("filter_null_target", f"WITH {OBS} SELECT event_id, {TARGET} FROM obs WHERE {TARGET} IS NOT NULL")
def filter_null_target(spark, sf_dir):
    return require(obs(spark, sf_dir), [TARGET]).select("event_id", TARGET)


def _interpolate_sql(limit: str) -> str:
    def known(c: str) -> str:
        return (
            f"last_value(CASE WHEN {c} IS NOT NULL THEN rn END IGNORE NULLS) OVER back AS r0_{c}, "
            f"last_value({c} IGNORE NULLS) OVER back AS x0_{c}, "
            f"first_value(CASE WHEN {c} IS NOT NULL THEN rn END IGNORE NULLS) OVER ahead AS r1_{c}, "
            f"first_value({c} IGNORE NULLS) OVER ahead AS x1_{c}"
        )

    def value(c: str) -> str:
        return (
            f"round(CASE WHEN {c} IS NOT NULL THEN {c} WHEN r0_{c} IS NOT NULL AND r1_{c} IS NOT NULL {limit.format(c=c)} "
            f"THEN x0_{c} + (x1_{c} - x0_{c}) * (rn - r0_{c}) / (r1_{c} - r0_{c}) END, 6) AS {c}"
        )

    cols = [TARGET, "pm10_ugm3", "precipitation_mm"]
    return f"""WITH {OBS}, n AS (SELECT *, row_number() OVER ({W}) AS rn FROM obs),
k AS (SELECT *, {", ".join(known(c) for c in cols)} FROM n WINDOW
  back AS (PARTITION BY stationID ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  ahead AS (PARTITION BY stationID ORDER BY rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT event_id, {", ".join(value(c) for c in cols)} FROM k"""


def _interpolated(spark, sf_dir, max_gap=None):
    o, p = _fitted(spark, sf_dir)
    cols = [TARGET, "pm10_ugm3", "precipitation_mm"]
    return interpolate(o, p, cols, max_gap=max_gap).select("event_id", *[r6(c) for c in cols])


@query("interpolate_linear", _interpolate_sql(""))
def interpolate_linear(spark, sf_dir):
    return _interpolated(spark, sf_dir)


@query("interpolate_gap_limited", _interpolate_sql("AND r1_{c} - r0_{c} - 1 <= 1"))
def interpolate_gap_limited(spark, sf_dir):
    return _interpolated(spark, sf_dir, max_gap=1)


@query(
    "station_completeness",
    f"""WITH {OBS}, kept AS (SELECT stationID FROM obs GROUP BY 1
  HAVING avg(({TARGET} IS NULL)::INT) <= 0.15)
SELECT event_id, stationID FROM obs WHERE stationID IN (SELECT stationID FROM kept)""",
)
def station_completeness(spark, sf_dir):
    return complete_entities(obs(spark, sf_dir), "stationID", TARGET, 0.15).select("event_id", "stationID")


@query("chrono_split", f"WITH {OBS}, {SPLIT} SELECT event_id, split FROM split_obs")
def chrono_split(spark, sf_dir):
    return chronological_split(obs(spark, sf_dir), SPLIT_KEYS).select("event_id", "split")


@query(
    "fixed_date_split",
    f"""WITH {OBS} SELECT event_id, CASE WHEN timestamp_utc <= TIMESTAMP '2024-01-20' THEN 'train'
  WHEN timestamp_utc <= TIMESTAMP '2024-01-25' THEN 'val' ELSE 'test' END AS split FROM obs""",
)
def fixed_date_split(spark, sf_dir):
    return fixed_split(obs(spark, sf_dir), "timestamp_utc", "2024-01-20", "2024-01-25").select("event_id", "split")


_FITTED = ["temp_c", "pressure_hpa", TARGET]


@query(
    "zscore_train",
    f"""WITH {OBS}, {SPLIT}, s AS (SELECT """
    + ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in _FITTED)
    + " FROM split_obs WHERE split = 'train') SELECT event_id, "
    + ", ".join(f"round(({c} - m_{c}) / s_{c}, 6) AS {c}_norm" for c in _FITTED)
    + " FROM split_obs, s",
)
def zscore_train(spark, sf_dir):
    table = chronological_split(obs(spark, sf_dir), SPLIT_KEYS)
    stats = fit(table.filter(F.col("split") == "train"), _FITTED)
    return add_normalised(table, stats).select("event_id", *[r6(f"{c}_norm") for c in _FITTED])


@query(
    "minmax_train",
    f"""WITH {OBS}, {SPLIT}, s AS (SELECT """
    + ", ".join(f"min({c}) AS a_{c}, max({c}) AS b_{c}" for c in _FITTED)
    + " FROM split_obs WHERE split = 'train') SELECT event_id, "
    + ", ".join(f"round(({c} - a_{c}) / (b_{c} - a_{c}), 6) AS {c}" for c in _FITTED)
    + " FROM split_obs, s",
)
def minmax_train(spark, sf_dir):
    table = chronological_split(obs(spark, sf_dir), SPLIT_KEYS)
    stats = fit(table.filter(F.col("split") == "train"), _FITTED, "minmax")
    return normalise_in_place(table, stats).select("event_id", *[r6(c) for c in _FITTED])


@query(
    "normalization_stats",
    f"WITH {OBS}, {SPLIT} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, 'standard' AS method, round(avg({c}), 6) AS p1, round(stddev_samp({c}), 6) AS p2 "
        "FROM split_obs WHERE split = 'train'"
        for c in _FITTED
    ),
)
def normalization_stats(spark, sf_dir):
    table = chronological_split(obs(spark, sf_dir), SPLIT_KEYS)
    stats = fit(table.filter(F.col("split") == "train"), _FITTED)
    return stats_frame(spark, stats).select("feature", "method", r6("p1"), r6("p2"))


@query(
    "ordinal_rank",
    f"WITH {OBS} SELECT event_id, row_number() OVER (ORDER BY timestamp_utc, event_id) AS rank FROM obs",
)
def ordinal_rank_query(spark, sf_dir):
    return ordinal_rank(obs(spark, sf_dir), "timestamp_utc", ["event_id"]).select("event_id", "rank")


@query(
    "position_slice",
    f"""WITH {OBS}, r AS (SELECT event_id, row_number() OVER (ORDER BY timestamp_utc, event_id) - 1 AS place, count(*) OVER () AS n
  FROM obs) SELECT event_id FROM r WHERE place >= n // 4 AND place < n // 2""",
)
def position_slice_query(spark, sf_dir):
    """The second quarter of all rows by time."""
    o = obs(spark, sf_dir)
    n = o.count()
    return position_slice(o, "timestamp_utc", ["event_id"], n // 4, n // 2).select("event_id")


_FOLDS = f"""d AS (SELECT *, datediff('day', DATE '2024-01-03', CAST(timestamp_utc AS DATE)) AS day FROM obs),
folds AS (SELECT unnest(range(0, 9)) AS fold), long AS (
  SELECT day, unnest(['pm2_5_ugm3', 'temp_c']) AS feature, unnest([pm2_5_ugm3, temp_c]) AS value FROM d),
stats AS (SELECT fold, feature, count(value) AS n, avg(value) AS mean, stddev_samp(value) AS std, min(value) AS lo, max(value) AS hi
  FROM folds CROSS JOIN (SELECT DISTINCT feature FROM long) LEFT JOIN long USING (feature) WHERE day < (fold + 1) * 3 GROUP BY ALL)"""


@query(
    "fold_statistics",
    f"""WITH {OBS}, {_FOLDS} SELECT CAST(fold AS INTEGER) AS fold, feature, n, round(mean, 6) AS mean, round(std, 6) AS std, round(lo, 6) AS min,
  round(hi, 6) AS max FROM stats""",
)
def fold_statistics_query(spark, sf_dir):
    s = fold_statistics(obs(spark, sf_dir), "timestamp_utc", "2024-01-03", 3, 9, [TARGET, "temp_c"])
    return s.select("fold", "feature", "n", *[r6(c) for c in ("mean", "std", "min", "max")])


@query(
    "fold_metrics",
    f"""WITH {OBS}, {_FOLDS}, t AS (SELECT d.*, fold FROM d JOIN folds ON day >= (fold + 1) * 3 AND day < (fold + 1) * 3 + 5),
g AS (SELECT t.fold, s.mean AS predicted, {TARGET} AS actual, (temp_c - w.mean) / w.std AS scaled FROM t
  JOIN stats s ON s.fold = t.fold AND s.feature = '{TARGET}' JOIN stats w ON w.fold = t.fold AND w.feature = 'temp_c' WHERE {TARGET} IS NOT NULL)
SELECT CAST(fold AS INTEGER) AS fold, count(*) AS n, round(avg(abs(predicted - actual)), 6) AS mae,
  round(sqrt(avg((predicted - actual) * (predicted - actual))), 6) AS rmse, round(avg(predicted - actual), 6) AS bias,
  round(avg(scaled), 6) AS temp_c_norm FROM g GROUP BY fold""",
)
def fold_metrics(spark, sf_dir):
    """Errors of the training mean on each fold's test days, and their temperature on the fold's own scale."""
    where = ("timestamp_utc", "2024-01-03", 3, 9)
    o = obs(spark, sf_dir)
    stats = fold_statistics(o, *where, [TARGET, "temp_c"])
    rows = fold_normalised(fold_tests(o, *where, 5).filter(f"{TARGET} IS NOT NULL"), stats, ["temp_c"])
    means = stats.filter(F.col("feature") == TARGET).select("fold", F.col("mean").alias("predicted"))
    rows = rows.join(F.broadcast(means), "fold").withColumn("actual", F.col(TARGET))
    scaled = rows.groupBy("fold").agg(F.avg("temp_c_norm").alias("temp_c_norm"))
    m = error_metrics(rows, ["fold"]).join(scaled, "fold")
    return m.select("fold", "n", *[r6(c) for c in ("mae", "rmse", "bias", "temp_c_norm")])


@query(
    "walk_forward_folds",
    f"""WITH {OBS}, d AS (SELECT event_id, datediff('day', DATE '2024-01-01', CAST(timestamp_utc AS DATE)) AS day FROM obs),
f AS (SELECT event_id, fold, CASE WHEN day < (fold + 1) * 7 THEN 'train' WHEN day < (fold + 1) * 7 + 5 THEN 'test' END AS role
  FROM d, (SELECT unnest([0, 1, 2]) AS fold))
SELECT event_id, fold, role FROM f WHERE role IS NOT NULL""",
)
def walk_forward_folds_query(spark, sf_dir):
    folds = walk_forward_folds(obs(spark, sf_dir), "timestamp_utc", "2024-01-01", 7, 3, 5)
    return folds.select("event_id", "fold", "role")


@query(
    "time_gaps",
    """WITH h AS (SELECT DISTINCT event_type AS stationID, date_trunc('hour', ts) AS t FROM events),
s AS (SELECT stationID, t, epoch(t) - epoch(lag(t) OVER (PARTITION BY stationID ORDER BY t)) AS step FROM h)
SELECT stationID, strftime(t, '%Y-%m-%d %H:%M:%S') AS at, step::DOUBLE AS step_seconds FROM s
WHERE step IS NOT NULL AND step <> 3600""",
)
def time_gaps_query(spark, sf_dir):
    hours = station_hours(spark, sf_dir)
    gaps = time_gaps(hours, Panel("stationID", "timestamp_utc").fit(hours))
    return gaps.select("stationID", moment("timestamp_utc", "at"), "step_seconds")


@query(
    "filter_predicates",
    f"""WITH {OBS} SELECT event_id, stationID, humidity_pct FROM obs
WHERE load_id IN ('view', 'click') AND year(timestamp_utc) = 2024 AND month(timestamp_utc) = 1
  AND hour(timestamp_utc) BETWEEN 6 AND 18 AND humidity_pct BETWEEN 10 AND 100""",
)
def filter_predicates(spark, sf_dir):
    rows = filter_rows(
        obs(spark, sf_dir),
        entity="load_id",
        entities=["view", "click"],
        time="timestamp_utc",
        years=[2024],
        months=[1],
        hours=(6, 18),
    )
    return rows.filter(F.col("humidity_pct").between(10, 100)).select("event_id", "stationID", "humidity_pct")


@query(
    "station_subset",
    f"""WITH {OBS}, chosen AS (SELECT DISTINCT stationID FROM obs WHERE lat BETWEEN 13.70 AND 13.80 AND lon >= 100.5)
SELECT event_id, stationID, {TARGET} FROM obs WHERE stationID IN (SELECT stationID FROM chosen)""",
)
def station_subset(spark, sf_dir):
    o = obs(spark, sf_dir)
    chosen = o.filter(F.col("lat").between(13.70, 13.80) & (F.col("lon") >= 100.5)).select("stationID")
    return keep_entities(o, chosen, "stationID").select("event_id", "stationID", TARGET)


_FORECAST = f"""f AS (SELECT stationID, event_id, h AS horizon, lag(wind_ms, 1) OVER w AS predicted,
    CASE h WHEN 1 THEN lead(wind_ms, 1) OVER w WHEN 3 THEN lead(wind_ms, 3) OVER w ELSE lead(wind_ms, 24) OVER w END AS actual
  FROM obs, (SELECT unnest([1, 3, 24]) AS h)
  WINDOW w AS (PARTITION BY h, stationID ORDER BY timestamp_utc, event_id)),
g AS (SELECT *, predicted - actual AS e, (actual >= 5)::INT + (actual >= 10)::INT AS band
  FROM f WHERE predicted IS NOT NULL AND actual IS NOT NULL)"""
_METRICS = """count(*) AS n, round(avg(abs(e)), 6) AS mae, round(sqrt(avg(e * e)), 6) AS rmse, round(avg(e), 6) AS bias,
  round(1 - sum(e * e) / nullif(var_pop(actual) * count(*), 0), 6) AS r2,
  round(avg(abs(e)) * 0.7::DOUBLE + sqrt(avg(e * e)) * 0.3::DOUBLE, 6) AS loss"""
_METRIC_COLS = ["mae", "rmse", "bias", "r2", "loss"]


def _forecast(spark, sf_dir):
    o, p = _fitted(spark, sf_dir)
    return persistence_forecast(o, p, "wind_ms", [1, 3, 24])


@query(
    "forecast_metrics",
    f"WITH {OBS}, {_FORECAST} SELECT 'persistence' AS model, horizon, {_METRICS} FROM g GROUP BY horizon",
)
def forecast_metrics(spark, sf_dir):
    m = error_metrics(_forecast(spark, sf_dir))
    return m.select("model", "horizon", "n", *[r6(c) for c in _METRIC_COLS])


@query(
    "forecast_error_bands",
    f"WITH {OBS}, {_FORECAST} SELECT horizon, band, {_METRICS} FROM g GROUP BY horizon, band",
)
def forecast_error_bands(spark, sf_dir):
    m = banded_metrics(_forecast(spark, sf_dir), [5.0, 10.0])
    return m.select("horizon", "band", "n", *[r6(c) for c in _METRIC_COLS])
