"""Aggregates, quality reports, record handling and whole jobs over tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from tidelines.catalog.derived import (
    BRONZE,
    DAILY_AQ,
    DAILY_WEATHER,
    OBS,
    SPLIT,
    TIES,
    W,
    air_quality_v1,
    air_quality_v2,
    bronze_docs,
    hotspots,
    obs,
    panel,
    silver_obs,
    table,
    weather_texts,
)
from tidelines.catalog.feature_queries import SPLIT_KEYS, TARGET
from tidelines.catalog.registry import day, moment, query, r6
from tidelines.functions.records import record_hash_v1, record_hash_v2
from tidelines.functions.wind import conversion_correct
from tidelines.operators import aggregate as agg
from tidelines.operators import quality as q
from tidelines.operators.clean import latest_per_key, union_all
from tidelines.operators.planning import periods, work_list
from tidelines.operators.spatial import transboundary_index
from tidelines.operators.splits import chronological_split
from tidelines.plans.config import CombinedConfig, DailyConfig, HourlyConfig
from tidelines.plans.gold_jobs import combined_gold, daily_gold, hourly_gold
from tidelines.plans.silver_jobs import backfill_plan, quality_metrics
from tidelines.schemas import LONG_POLLUTANTS, WEATHER_BRONZE
from tidelines.sources import bronze, gold
from tidelines.sources.silver import reconcile


@query(
    "station_aggregates",
    f"""WITH {OBS}, s AS (SELECT stationID, avg({TARGET}) AS m, stddev_samp({TARGET}) AS d, avg(pm10_ugm3) AS p
FROM obs GROUP BY 1)
SELECT event_id, stationID, round(m, 6) AS station_pm25_mean, round(d, 6) AS station_pm25_std,
  round(p, 6) AS station_pm10_mean FROM obs JOIN s USING (stationID)""",
)
def station_aggregates(spark, sf_dir):
    from tidelines.operators.joins import attach_group_stats

    o = obs(spark, sf_dir)
    joined = attach_group_stats(o, agg.station_aggregates(o), "stationID")
    return joined.select(
        "event_id", "stationID", *[r6(f"station_{c}") for c in ("pm25_mean", "pm25_std", "pm10_mean")]
    )


@query(
    "yearly_counts",
    "SELECT year(o_orderdate) AS year, count(*) AS rows FROM orders GROUP BY 1",
)
def yearly_counts(spark, sf_dir):
    return agg.yearly_counts(table(spark, sf_dir, "orders"), "o_orderdate")


@query(
    "global_summary",
    f"""WITH {OBS} SELECT round(avg({TARGET}), 6) AS mean, round(stddev_samp({TARGET}), 6) AS std, min({TARGET}) AS min,
  max({TARGET}) AS max, count(*) FILTER ({TARGET} IS NULL) AS null_count,
  round(count(*) FILTER ({TARGET} IS NULL) * 100.0::DOUBLE / count(*), 6) AS null_pct FROM obs""",
)
def global_summary(spark, sf_dir):
    s = agg.global_summary(obs(spark, sf_dir), TARGET)
    return s.select(r6("mean"), r6("std"), "min", "max", "null_count", r6("null_pct"))


@query(
    "distinct_counts",
    f"""WITH {OBS} SELECT count(DISTINCT stationID) AS n_stationID, count(DISTINCT load_id) AS n_load_id,
  count(DISTINCT {TARGET}) + max(({TARGET} IS NULL)::INT) AS n_{TARGET} FROM obs""",
)
def distinct_counts(spark, sf_dir):
    return agg.distinct_counts(obs(spark, sf_dir), ["stationID", "load_id", TARGET])


@query(
    "monthly_average",
    """SELECT year(o_orderdate) AS year, month(o_orderdate) AS month, round(avg(o_totalprice), 6) AS mean,
  round(stddev_samp(o_totalprice), 6) AS std, count(DISTINCT o_custkey) AS stations FROM orders GROUP BY 1, 2""",
)
def monthly_average(spark, sf_dir):
    m = agg.monthly_average(table(spark, sf_dir, "orders"), "o_totalprice", "o_orderdate", "o_custkey")
    return m.select("year", "month", r6("mean"), r6("std"), "stations")


_RANKING = f"""WITH {OBS} SELECT stationID, round(avg(humidity_pct), 6) AS mean, max(humidity_pct) AS max FROM obs
GROUP BY stationID ORDER BY avg(humidity_pct) DESC, stationID"""


@query("station_ranking", _RANKING)
def station_ranking(spark, sf_dir):
    r = agg.station_ranking(obs(spark, sf_dir), "humidity_pct", "stationID")
    return r.select("stationID", r6("mean"), "max")


@query("top_k_stations", _RANKING + " LIMIT 10")
def top_k_stations(spark, sf_dir):
    r = agg.top_entities(obs(spark, sf_dir), "humidity_pct", "stationID", 10)
    return r.select("stationID", r6("mean"), "max")


@query(
    "quantiles",
    f"""WITH {OBS} SELECT p AS prob, round(v, 6) AS value FROM (
  SELECT unnest([0.5::DOUBLE, 0.95::DOUBLE]) AS p, unnest(quantile_cont({TARGET}, [0.5, 0.95])) AS v FROM obs)""",
)
def quantiles(spark, sf_dir):
    return agg.global_quantiles(obs(spark, sf_dir), TARGET, [0.5, 0.95]).select("prob", r6("value"))


@query(
    "split_drift",
    f"""WITH {OBS}, {SPLIT} SELECT split, p AS prob, round(v, 6) AS value FROM (
  SELECT split, unnest([0.0::DOUBLE, 0.25::DOUBLE, 0.5::DOUBLE, 0.75::DOUBLE, 1.0::DOUBLE]) AS p,
    unnest(quantile_cont({TARGET}, [0.0, 0.25, 0.5, 0.75, 1.0])) AS v FROM split_obs GROUP BY split)""",
)
def split_drift(spark, sf_dir):
    s = chronological_split(obs(spark, sf_dir), SPLIT_KEYS)
    return agg.exact_quantiles(s, TARGET, [0.0, 0.25, 0.5, 0.75, 1.0], ["split"]).select("split", "prob", r6("value"))


@query(
    "seasonal_profile",
    """SELECT month(o_orderdate) AS month, round(avg(o_totalprice), 6) AS mean,
  round(avg(o_totalprice) - stddev_samp(o_totalprice), 6) AS lower,
  round(avg(o_totalprice) + stddev_samp(o_totalprice), 6) AS upper FROM orders GROUP BY 1""",
)
def seasonal_profile(spark, sf_dir):
    p = agg.seasonal_profile(table(spark, sf_dir, "orders"), "o_totalprice", "o_orderdate")
    return p.select("month", r6("mean"), r6("lower"), r6("upper"))


@query(
    "year_over_year",
    "SELECT year(o_orderdate) AS year, "
    + ", ".join(f"round(avg(o_totalprice) FILTER (month(o_orderdate) = {m}), 6) AS m{m}" for m in range(1, 13))
    + " FROM orders GROUP BY 1",
)
def year_over_year(spark, sf_dir):
    y = agg.year_over_year(table(spark, sf_dir, "orders"), "o_totalprice", "o_orderdate")
    return y.select("year", *[r6(f"{m}", f"m{m}") for m in range(1, 13)])


_CORR = ["temp_c", TARGET, "pressure_hpa", "cloud_cover_pct"]


@query(
    "correlations",
    f"WITH {OBS} "
    + " UNION ALL ".join(
        f'SELECT \'{a}\' AS "left", \'{b}\' AS "right", round(corr({a}, {b}), 6) AS corr FROM obs'
        for i, a in enumerate(_CORR)
        for b in _CORR[i:]
    ),
)
def correlations(spark, sf_dir):
    return agg.correlations(obs(spark, sf_dir), _CORR).select("left", "right", r6("corr"))


@query(
    "lag_correlations",
    f"WITH {OBS}, l AS (SELECT {TARGET} AS y, "
    + ", ".join(f"lag(temp_c, {k}) OVER ({W}) AS x{k}" for k in (1, 3, 6))
    + " FROM obs) "
    + " UNION ALL ".join(f"SELECT {k} AS lag, round(corr(y, x{k}), 6) AS corr FROM l" for k in (1, 3, 6)),
)
def lag_correlations(spark, sf_dir):
    o = obs(spark, sf_dir)
    return agg.lag_correlations(o, panel().fit(o), TARGET, "temp_c", [1, 3, 6]).select("lag", r6("corr"))


@query(
    "rolling_correlation",
    f"""WITH {OBS} SELECT event_id, CASE WHEN count(wind_ms + pressure_hpa) OVER f = 12
  THEN round(corr(wind_ms, pressure_hpa) OVER f, 6) END AS rolling_corr
FROM obs WINDOW f AS ({W} ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)""",
)
def rolling_correlation(spark, sf_dir):
    o = obs(spark, sf_dir)
    out = agg.rolling_correlation(o, panel().fit(o), "wind_ms", "pressure_hpa", 12)
    return out.select("event_id", r6("rolling_corr"))


@query(
    "histogram",
    f"""WITH {OBS} SELECT CASE WHEN {TARGET} < 0 THEN 0 WHEN {TARGET} >= 200 THEN 41
  ELSE floor({TARGET} / 5)::BIGINT + 1 END AS bin, count(*) AS n FROM obs WHERE {TARGET} IS NOT NULL GROUP BY 1""",
)
def histogram(spark, sf_dir):
    return agg.histogram(obs(spark, sf_dir), TARGET, 0, 200, 40)


@query(
    "wind_rose",
    f"""WITH {OBS} SELECT (floor((wind_dir_deg + 11.25) / 22.5)::BIGINT % 16)::INT AS sector, count(*) AS n,
  round(avg(wind_ms), 6) AS mean_speed FROM obs GROUP BY 1""",
)
def wind_rose(spark, sf_dir):
    return agg.wind_rose(obs(spark, sf_dir), "wind_ms", "wind_dir_deg").select("sector", "n", r6("mean_speed"))


@query(
    "monthly_wind_vector",
    f"""WITH {OBS} SELECT year(timestamp_utc) AS year, month(timestamp_utc) AS month,
  round(avg(-wind_ms * sin(radians(wind_dir_deg))), 6) AS mean_u,
  round(avg(-wind_ms * cos(radians(wind_dir_deg))), 6) AS mean_v FROM obs GROUP BY 1, 2""",
)
def monthly_wind_vector(spark, sf_dir):
    from tidelines.functions.wind import add_wind_vectors

    uv = add_wind_vectors(obs(spark, sf_dir), "wind_ms", "wind_dir_deg", "u", "v")
    m = agg.monthly_wind_vector(uv, "u", "v", "timestamp_utc")
    return m.select("year", "month", r6("mean_u"), r6("mean_v"))


_PROFILED = {
    "stationID": "string",
    TARGET: "double",
    "pm10_ugm3": "double",
    "precipitation_mm": "double",
    "event_id": "bigint",
    "load_id": "string",
}


def _profile_sql(c: str, kind: str) -> str:
    numeric = kind != "string"
    stats = (
        f"round(min({c})::DOUBLE, 6) AS min, round(max({c})::DOUBLE, 6) AS max, round(avg({c}), 6) AS mean"
        if numeric
        else "NULL::DOUBLE AS min, NULL::DOUBLE AS max, NULL::DOUBLE AS mean"
    )
    return (
        f"SELECT '{c}' AS \"column\", '{kind}' AS dtype, count(*) FILTER ({c} IS NULL) AS null_count, "
        f"round(count(*) FILTER ({c} IS NULL) * 100.0::DOUBLE / count(*), 2) AS null_pct, {stats} FROM obs"
    )


@query("column_profile", f"WITH {OBS} " + " UNION ALL ".join(_profile_sql(c, k) for c, k in _PROFILED.items()))
def column_profile(spark, sf_dir):
    p = q.column_profile(obs(spark, sf_dir).select(*_PROFILED))
    return p.select("column", "dtype", "null_count", "null_pct", r6("min"), r6("max"), r6("mean"))


@query(
    "group_completeness",
    f"WITH {OBS}, p AS ("
    + " UNION ALL ".join(
        f"SELECT '{'calendar' if c == 'hour' else 'original'}' AS grp, "
        f"round(count(*) FILTER ({'NULL' if c == 'hour' else c} IS NULL AND {'FALSE' if c == 'hour' else 'TRUE'}) "
        "* 100.0::DOUBLE / count(*), 2) AS null_pct FROM obs"
        for c in [TARGET, "pm10_ugm3", "precipitation_mm", "hour"]
    )
    + ') SELECT grp AS "group", count(*) AS columns, round(100 - avg(null_pct), 6) AS complete_pct FROM p GROUP BY grp',
)
def group_completeness(spark, sf_dir):
    o = obs(spark, sf_dir).select(TARGET, "pm10_ugm3", "precipitation_mm", F.hour("timestamp_utc").alias("hour"))
    return q.group_completeness(o).select("group", "columns", r6("complete_pct"))


@query(
    "temporal_coverage",
    """WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders)
SELECT strftime(min(date), '%Y-%m-%d') AS min_date, strftime(max(date), '%Y-%m-%d') AS max_date,
  count(*) AS unique_dates, datediff('day', min(date), max(date)) + 1 AS expected_days,
  datediff('day', min(date), max(date)) + 1 - count(*) AS missing_days,
  round(count(*) * 100.0::DOUBLE / (datediff('day', min(date), max(date)) + 1), 2) AS coverage_pct FROM d""",
)
def temporal_coverage(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("date"))
    c = q.temporal_coverage(orders)
    return c.select(
        day("min_date", "min_date"),
        day("max_date", "max_date"),
        "unique_dates",
        "expected_days",
        "missing_days",
        "coverage_pct",
    )


@query(
    "station_coverage",
    f"""WITH {OBS} SELECT count(DISTINCT stationID) AS unique_stations, count(*) AS total_records,
  count(*) // count(DISTINCT stationID) AS avg_records_per_station FROM obs""",
)
def station_coverage(spark, sf_dir):
    return q.station_coverage(obs(spark, sf_dir))


@query(
    "entity_spans",
    f"""WITH {OBS} SELECT stationID, strftime(min(timestamp_utc), '%Y-%m-%d %H:%M:%S') AS first_seen,
  strftime(max(timestamp_utc), '%Y-%m-%d %H:%M:%S') AS last_seen, count(*) AS rows FROM obs GROUP BY 1""",
)
def entity_spans(spark, sf_dir):
    s = q.entity_spans(obs(spark, sf_dir), "stationID", "timestamp_utc")
    return s.select("stationID", moment("first_seen", "first_seen"), moment("last_seen", "last_seen"), "rows")


@query(
    "coverage_intervals",
    f"""WITH {OBS}, t AS (SELECT stationID, timestamp_utc AS t, count(*) AS n FROM obs GROUP BY ALL),
s AS (SELECT *, CASE WHEN t - lag(t) OVER w <= INTERVAL 6 HOUR THEN 0 ELSE 1 END AS new FROM t WINDOW w AS (PARTITION BY stationID ORDER BY t)),
k AS (SELECT *, sum(new) OVER (PARTITION BY stationID ORDER BY t) AS no FROM s),
i AS (SELECT stationID, no, min(t) AS a, max(t) AS b, CAST(sum(n) AS BIGINT) AS rows, count(*) AS times FROM k GROUP BY ALL)
SELECT stationID, epoch_us(a) AS started_micros, epoch_us(b) AS ended_micros, rows, times,
  round((epoch_us(lead(a) OVER (PARTITION BY stationID ORDER BY a)) - epoch_us(b)) / 1000000.0::DOUBLE, 6) AS gap_seconds FROM i""",
)
def coverage_intervals(spark, sf_dir):
    c = q.coverage_intervals(obs(spark, sf_dir), "stationID", "timestamp_utc", "6 hours", "day")
    micros = [F.unix_micros(x).alias(f"{x}_micros") for x in ("started", "ended")]
    return c.select("stationID", *micros, "rows", "times", r6("gap_seconds"))


@query(
    "split_inspection",
    f"""WITH {OBS}, {SPLIT} SELECT split, count(*) AS rows, strftime(min(timestamp_utc), '%Y-%m-%d') AS first,
  strftime(max(timestamp_utc), '%Y-%m-%d') AS last, count(DISTINCT stationID) AS stations,
  (count({TARGET}) > 0)::INT AS target_available FROM split_obs GROUP BY split""",
)
def split_inspection(spark, sf_dir):
    s = chronological_split(obs(spark, sf_dir), SPLIT_KEYS)
    i = q.split_inspection(s, "split", "timestamp_utc", "stationID", TARGET)
    return i.select(
        "split",
        "rows",
        day("first", "first"),
        day("last", "last"),
        "stations",
        F.col("target_available").cast("int").alias("target_available"),
    )


_RULES = [*q.WEATHER_RULES, q.Rule(TARGET, 0, 400)]


def _rule_sql(r: q.Rule) -> str:
    tests = [f"{r.column} < {r.low}" if r.low is not None else "", f"{r.column} > {r.high}" if r.high is not None else ""]
    tests.append(f"{r.column} IS NULL" if r.required else "")
    return f"SELECT '{r.name}' AS rule, count(*) FILTER ({' OR '.join(t for t in tests if t)}) AS violations FROM obs"


@query("rule_violations", f"WITH {OBS} " + " UNION ALL ".join(_rule_sql(r) for r in _RULES))
def rule_violations(spark, sf_dir):
    return q.rule_violations(obs(spark, sf_dir), _RULES)


@query(
    "quarantined_rows",
    f"""WITH {OBS} SELECT event_id, concat_ws(',', CASE WHEN temp_c > 60 THEN 'temp_c_range' END,
  CASE WHEN humidity_pct > 100 THEN 'humidity_pct_range' END,
  CASE WHEN {TARGET} > 400 THEN '{TARGET}_range' END) AS violations FROM obs
WHERE temp_c > 60 OR humidity_pct > 100 OR coalesce({TARGET} > 400, false)""",
)
def quarantined_rows(spark, sf_dir):
    _, rejected = q.quarantine(obs(spark, sf_dir), _RULES)
    return rejected.select("event_id", F.array_join("violations", ",").alias("violations"))


def _unified(spark, sf_dir):
    return union_all(reconcile(air_quality_v1(spark, sf_dir)), reconcile(air_quality_v2(spark, sf_dir)))


def _narrow(c: str) -> str:
    return f"CASE WHEN user_id % 2 = 0 THEN CAST(CAST({c} AS FLOAT) AS DOUBLE) ELSE {c} END"


_SHORT = [TARGET, "pm10_ugm3", "no2_ugm3", "o3_ugm3", "so2_ugm3", "co_ugm3"]


@query(
    "unify_schemas",
    f"""WITH {OBS} SELECT lpad(event_id::VARCHAR, 20, '0') AS record_hash, stationID,
  CASE WHEN user_id % 2 = 0 THEN '1.0.0' ELSE '2.0.0' END AS pipeline_version,
  '2024-02-01 00:00:00' AS ingested, """
    + ", ".join(f"round({_narrow(s)}, 6) AS {n}" for s, n in zip(_SHORT, LONG_POLLUTANTS))
    + " FROM obs",
)
def unify_schemas(spark, sf_dir):
    u = _unified(spark, sf_dir)
    return u.select(
        "record_hash",
        "stationID",
        "pipeline_version",
        moment("ingestion_timestamp_utc", "ingested"),
        *[r6(c) for c in LONG_POLLUTANTS],
    )


@query(
    "partition_column_presence",
    f"""WITH {OBS}, d AS (SELECT strftime(timestamp_utc, '%Y-%m-%d') AS date,
  CASE WHEN user_id % 2 = 0 THEN '1.0.0' ELSE '2.0.0' END AS pipeline_version, * FROM obs)
SELECT date, pipeline_version, rows, c AS "column", present FROM (
  SELECT date, pipeline_version, count(*) AS rows, unnest(['no2_ugm3', 'nitrogen_dioxide_ugm3', '{TARGET}']) AS c,
    unnest([count(no2_ugm3) FILTER (user_id % 2 = 0), count(no2_ugm3) FILTER (user_id % 2 = 1), count({TARGET})]) AS present
  FROM d GROUP BY 1, 2)""",
)
def partition_column_presence(spark, sf_dir):
    v1 = air_quality_v1(spark, sf_dir).drop("ingestion_timestamp_utc")
    v2 = air_quality_v2(spark, sf_dir).drop("ingestion_timestamp_utc")
    both = v1.unionByName(v2, allowMissingColumns=True).withColumn("date", F.date_format("timestamp_utc", "yyyy-MM-dd"))
    return q.partition_presence(both, ["date", "pipeline_version"], ["no2_ugm3", "nitrogen_dioxide_ugm3", TARGET])


@query(
    "conversion_check",
    """WITH c AS (SELECT value AS original, CAST(value / 3.6::DOUBLE AS FLOAT) AS actual FROM events)
SELECT count(*) AS n, count(*) FILTER (abs(actual - original / 3.6::DOUBLE) < 0.001) AS correct FROM c""",
)
def conversion_check(spark, sf_dir):
    from tidelines.functions.wind import kmh_to_ms

    v = table(spark, sf_dir, "events").select("value", kmh_to_ms(F.col("value")).cast("float").alias("actual"))
    return v.agg(F.count(F.lit(1)).alias("n"), F.count_if(conversion_correct("actual", "value")).alias("correct"))


@query(
    "load_verification",
    """SELECT 1 AS files, count(*) AS rows, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first,
  strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last, count(DISTINCT user_id) AS stations,
  round(count(value) * 100.0::DOUBLE / count(*), 6) AS available_pct FROM events""",
)
def load_verification(spark, sf_dir):
    v = q.load_verification(table(spark, sf_dir, "events"), "user_id", "ts", "value")
    return v.select("files", "rows", moment("first", "first"), moment("last", "last"), "stations", r6("available_pct"))


_LINE = [
    "l_orderkey",
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
]
_LINE_ORDER = [c for c in _LINE if c not in ("l_orderkey", "l_linenumber")]


@query(
    "dedupe_latest",
    f"""SELECT {", ".join(_LINE)}, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC, {", ".join(_LINE_ORDER)}) AS rn FROM lineitem) WHERE rn = 1""",
)
def dedupe_latest(spark, sf_dir):
    newest = [F.col("l_shipdate").desc(), *[F.col(c) for c in _LINE_ORDER]]
    d = latest_per_key(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], newest)
    return d.select(*_LINE, day("l_shipdate", "l_shipdate"))


_LOAD = {"data_source": "events", "load_id": "load-1", "ingested_at": "2024-02-01T00:00:00"}


@query(
    "unnest_bronze",
    f"""WITH {BRONZE} SELECT stationID, round(lat, 6) AS lat, round(lon, 6) AS lon,
  epoch_ms(stamp) AS timestamp_unix_ms, round(pm2_5, 6) AS pm2_5_ugm3, round(pm10, 6) AS pm10_ugm3,
  round(co, 6) AS carbon_monoxide_ugm3, NULL::DOUBLE AS sulphur_dioxide_ugm3 FROM bronze""",
)
def unnest_bronze(spark, sf_dir):
    s = bronze.air_quality_silver(bronze_docs(spark, sf_dir), **_LOAD)
    return s.select(
        "stationID",
        r6("lat"),
        r6("lon"),
        "timestamp_unix_ms",
        *[r6(c) for c in (TARGET, "pm10_ugm3", "carbon_monoxide_ugm3", "sulphur_dioxide_ugm3")],
    )


@query(
    "alias_fallback",
    f"""WITH {BRONZE} SELECT stationID, time_text, round(no2, 6) AS nitrogen_dioxide_ugm3, round(o3, 6) AS ozone_ugm3
FROM bronze""",
)
def alias_fallback(spark, sf_dir):
    s = bronze.air_quality_silver(bronze_docs(spark, sf_dir), **_LOAD)
    return s.select(
        "stationID",
        F.date_format("timestamp_utc", "yyyy-MM-dd'T'HH:mm").alias("time_text"),
        r6("nitrogen_dioxide_ugm3"),
        r6("ozone_ugm3"),
    )


@query(
    "silver_conform",
    f"""WITH {BRONZE} SELECT stationID, epoch_ms(stamp) AS timestamp_unix_ms,
  round(CAST(CAST(pm2_5 AS FLOAT) AS DOUBLE), 6) AS pm2_5_ugm3, round(CAST(CAST(no2 AS FLOAT) AS DOUBLE), 6) AS no2_ugm3,
  'events' AS data_source, '2024-02-01 00:00:00' AS ingested, 'load-1' AS load_id, '1.0.0' AS pipeline_version,
  substr(sha256(stationID || '|' || strftime(stamp, '%Y-%m-%d %H:%M:%S') || '+00:00'), 1, 16) AS record_hash FROM bronze""",
)
def silver_conform(spark, sf_dir):
    s = bronze.air_quality_silver(bronze_docs(spark, sf_dir), pipeline_version="1.0.0", generation=1, **_LOAD)
    return s.select(
        "stationID",
        "timestamp_unix_ms",
        r6(F.col(TARGET).cast("double"), TARGET),
        r6(F.col("no2_ugm3").cast("double"), "no2_ugm3"),
        "data_source",
        moment("ingestion_timestamp_utc", "ingested"),
        "load_id",
        "pipeline_version",
        "record_hash",
    )


@query(
    "record_hash_v1",
    f"""WITH {OBS} SELECT event_id,
  substr(sha256(stationID || '|' || strftime(timestamp_utc, '%Y-%m-%d %H:%M:%S') || '+00:00'), 1, 16) AS record_hash
FROM obs""",
)
def record_hash_v1_query(spark, sf_dir):
    h = record_hash_v1(F.col("stationID"), F.col("timestamp_utc"))
    return obs(spark, sf_dir).select("event_id", h.alias("record_hash"))


@query(
    "record_hash_v2",
    f"""WITH {OBS} SELECT event_id, md5(stationID || '_' || strftime(timestamp_utc, '%Y-%m-%dT%H:%M') || '_' ||
  coalesce({TARGET}::VARCHAR, 'None')) AS record_hash FROM obs""",
)
def record_hash_v2_query(spark, sf_dir):
    text = F.date_format("timestamp_utc", "yyyy-MM-dd'T'HH:mm")
    h = record_hash_v2(F.col("stationID"), text, F.col(TARGET))
    return obs(spark, sf_dir).select("event_id", h.alias("record_hash"))


@query(
    "bronze_file_checks",
    """WITH d AS (SELECT event_id % 11 AS k, abs(value) > 200 AS big FROM events),
c AS (SELECT count(*) AS documents, count(*) FILTER (k = 0) AS corrupt, count(*) FILTER (k = 1) AS missing_uv,
  count(*) FILTER (k = 2) AS bad_length, count(*) FILTER (k = 3) AS time_gap, count(*) FILTER (k = 4) AS nan,
  count(*) FILTER (k > 1 AND big) AS extreme FROM d)
SELECT unnest(['corrupt', 'missing_uv', 'bad_length', 'time_gap', 'nan', 'extreme']) AS "check",
  unnest([corrupt, missing_uv, bad_length, time_gap, nan, extreme]) AS failed, documents FROM c""",
)
def bronze_file_checks(spark, sf_dir):
    docs = bronze.parse_bronze(weather_texts(spark, sf_dir), "body", WEATHER_BRONZE)
    return bronze.check_summary(bronze.check_documents(docs, min_hours=3))


@query(
    "work_list",
    f"""WITH {OBS} SELECT stationID, strftime(s, '%Y-%m-%d') AS start,
  strftime(least(s + INTERVAL 1 MONTH - INTERVAL 1 DAY, DATE '2024-11-15'), '%Y-%m-%d') AS "end"
FROM (SELECT DISTINCT stationID FROM obs), (SELECT unnest(range(DATE '2024-01-01', DATE '2024-11-16', INTERVAL 1 MONTH)) AS s)""",
)
def work_list_query(spark, sf_dir):
    chunks = periods(F.lit("2024-01-01").cast("date"), F.lit("2024-11-15").cast("date"), 1)
    w = work_list(obs(spark, sf_dir), chunks)
    return w.select("stationID", day("start", "start"), day("end", "end"))


@query(
    "backfill_plan",
    f"""WITH {OBS}, done AS (SELECT stationID, date_trunc('quarter', timestamp_utc)::DATE AS start FROM obs
  GROUP BY 1, 2 HAVING count(*) >= 65)
SELECT w.stationID, strftime(s, '%Y-%m-%d') AS start,
  strftime(s + INTERVAL 3 MONTH - INTERVAL 1 DAY, '%Y-%m-%d') AS "end"
FROM (SELECT DISTINCT stationID FROM obs) w,
  (SELECT unnest(range(DATE '2023-01-01', DATE '2025-01-01', INTERVAL 3 MONTH))::DATE AS s)
WHERE NOT EXISTS (SELECT 1 FROM done d WHERE d.stationID = w.stationID AND d.start = s)""",
)
def backfill_plan_query(spark, sf_dir):
    o = obs(spark, sf_dir)
    loaded = o.groupBy("stationID", F.trunc("timestamp_utc", "quarter").alias("start")).count()
    plan = backfill_plan(o, loaded.filter(F.col("count") >= 65), "2023-01-01", "2024-12-31")
    return plan.select("stationID", day("start", "start"), day("end", "end"))


@query(
    "transboundary_index",
    f"""WITH {OBS}, {DAILY_WEATHER}, h AS (
  SELECT CAST(ts AS DATE) AS date, 13 + (event_id % 80) / 10.0::DOUBLE AS f_lat, 97 + (event_id % 90) / 10.0::DOUBLE AS f_lon,
    value AS frp, event_id % 3 AS c FROM events),
p AS (SELECT d.stationID, d.date, h.*, d.lat, d.lon, d.wind_direction_mean AS wd,
  2 * 6371.0::DOUBLE * asin(sqrt(least(1.0::DOUBLE, pow(sin(radians(lat - f_lat) / 2), 2)
    + cos(radians(f_lat)) * cos(radians(lat)) * pow(sin(radians(lon - f_lon) / 2), 2)))) AS km,
  degrees(atan2(sin(radians(lon - f_lon)) * cos(radians(lat)),
    cos(radians(f_lat)) * sin(radians(lat)) - sin(radians(f_lat)) * cos(radians(lat)) * cos(radians(lon - f_lon)))) AS toward
  FROM h JOIN daily d ON h.date = d.date WHERE f_lat BETWEEN 13 AND 21 AND f_lon BETWEEN 97 AND 106)
SELECT stationID, strftime(date, '%Y-%m-%d') AS date, count(*) FILTER (c = 0) AS hotspot_count_th,
  count(*) FILTER (c = 1) AS hotspot_count_mm, count(*) FILTER (c = 2) AS hotspot_count_la,
  round(sum(frp), 6) AS hotspot_frp_sum,
  round(sum(frp * greatest(0, cos(radians(toward - wd - 180))) * exp(-km / 200.0::DOUBLE)), 6) AS transboundary_index
FROM p WHERE km <= 800 GROUP BY 1, 2""",
)
def transboundary_index_query(spark, sf_dir):
    days = agg.daily_weather(obs(spark, sf_dir), ties=TIES)
    stations = days.select("date", "stationID", "lat", "lon", "wind_direction_mean")
    t = transboundary_index(hotspots(spark, sf_dir), stations)
    return t.select(
        "stationID",
        day(),
        *[f"hotspot_count_{c}" for c in ("th", "mm", "la")],
        r6("hotspot_frp_sum"),
        r6("transboundary_index"),
    )


@query(
    "job_daily_gold",
    f"""WITH {OBS}, {DAILY_WEATHER}, {DAILY_AQ}, m AS (
  SELECT d.*, a.pm2_5_mean, a.pm10_mean FROM daily d LEFT JOIN daily_aq a USING (date, stationID)),
f AS (SELECT *, lag(pm2_5_mean, 2) OVER w AS pm2_5_mean_lag2,
  CASE WHEN count(pm2_5_mean) OVER w3 = 3 THEN avg(pm2_5_mean) OVER w3 END AS pm2_5_mean_rolling_mean_3d,
  CASE WHEN count(temp_2m_mean) OVER w7 = 7 THEN stddev_samp(temp_2m_mean) OVER w7 END AS temp_2m_mean_rolling_std_7d,
  row_number() OVER (ORDER BY date, stationID) AS rk, count(*) OVER () AS n FROM m
  WINDOW w AS (PARTITION BY stationID ORDER BY date),
    w3 AS (PARTITION BY stationID ORDER BY date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW),
    w7 AS (PARTITION BY stationID ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)),
s AS (SELECT date, stationID, least(greatest(temp_2m_mean, -10), 55) AS temp_2m_mean,
  least(greatest(rh_2m_mean, 0), 100) AS rh_2m_mean, pm2_5_mean, pm2_5_mean_lag2, pm2_5_mean_rolling_mean_3d,
  temp_2m_mean_rolling_std_7d, -wind_speed_mean * sin(radians(wind_direction_mean)) AS wind_u10_mean,
  sin(dayofyear(date) * 2 * pi() / 365.25::DOUBLE) AS day_of_year_sin,
  CASE WHEN rk <= floor(n * 0.7::DOUBLE) THEN 'train' WHEN rk <= floor(n * (0.7::DOUBLE + 0.15::DOUBLE)) THEN 'val'
    ELSE 'test' END AS split FROM f),
t AS (SELECT avg(temp_2m_mean) AS tm, stddev_samp(temp_2m_mean) AS ts, avg(pm2_5_mean_lag2) AS lm,
  stddev_samp(pm2_5_mean_lag2) AS ls FROM s WHERE split = 'train')
SELECT strftime(date, '%Y-%m-%d') AS date, stationID, split, round(temp_2m_mean, 6) AS temp_2m_mean,
  round(rh_2m_mean, 6) AS rh_2m_mean, round(pm2_5_mean, 6) AS pm2_5_mean, round(pm2_5_mean_lag2, 6) AS pm2_5_mean_lag2,
  round(pm2_5_mean_rolling_mean_3d, 6) AS pm2_5_mean_rolling_mean_3d,
  round(temp_2m_mean_rolling_std_7d, 6) AS temp_2m_mean_rolling_std_7d, round(wind_u10_mean, 6) AS wind_u10_mean,
  round(day_of_year_sin, 6) AS day_of_year_sin, round((temp_2m_mean - tm) / ts, 6) AS temp_2m_mean_norm,
  round((pm2_5_mean_lag2 - lm) / ls, 6) AS pm2_5_mean_lag2_norm FROM s, t""",
)
def job_daily_gold(spark, sf_dir):
    o = obs(spark, sf_dir)
    gold_table, _ = daily_gold(o, o, DailyConfig(ties=TIES))
    cols = (
        "temp_2m_mean rh_2m_mean pm2_5_mean pm2_5_mean_lag2 pm2_5_mean_rolling_mean_3d temp_2m_mean_rolling_std_7d "
        "wind_u10_mean day_of_year_sin temp_2m_mean_norm pm2_5_mean_lag2_norm"
    )
    return gold_table.select(day(), "stationID", "split", *[r6(c) for c in cols.split()])


_FILLED = f"""n AS (SELECT *, row_number() OVER ({W}) AS rn FROM obs WHERE {TARGET} IS NOT NULL),
k AS (SELECT *, last_value(CASE WHEN pm10_ugm3 IS NOT NULL THEN rn END IGNORE NULLS) OVER b AS r0,
  last_value(pm10_ugm3 IGNORE NULLS) OVER b AS x0, first_value(CASE WHEN pm10_ugm3 IS NOT NULL THEN rn END IGNORE NULLS) OVER a AS r1,
  first_value(pm10_ugm3 IGNORE NULLS) OVER a AS x1, last_value(no2_ugm3 IGNORE NULLS) OVER b AS y0,
  first_value(no2_ugm3 IGNORE NULLS) OVER a AS y1
  FROM n WINDOW b AS (PARTITION BY stationID ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    a AS (PARTITION BY stationID ORDER BY rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
i AS (SELECT * REPLACE (CASE WHEN pm10_ugm3 IS NOT NULL THEN pm10_ugm3 ELSE x0 + (x1 - x0) * (rn - r0) / (r1 - r0) END AS pm10_ugm3),
  no2_ugm3 IS NOT NULL OR (y0 IS NOT NULL AND y1 IS NOT NULL) AS has_no2 FROM k)"""


@query(
    "job_hourly_gold",
    f"""WITH {OBS}, {_FILLED},
f AS (SELECT event_id, stationID, timestamp_utc, pm10_ugm3, has_no2, {TARGET} AS c, hour(timestamp_utc)::DOUBLE AS hour,
  (isodow(timestamp_utc) >= 5)::INT::DOUBLE AS weekend, lag({TARGET}, 24) OVER w AS l24, lag({TARGET}, 1) OVER w AS l1,
  avg({TARGET}) OVER (w ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) AS m24, lead({TARGET}, 24) OVER w AS target
  FROM i WINDOW w AS (PARTITION BY stationID ORDER BY rn)),
g AS (SELECT *, row_number() OVER (ORDER BY timestamp_utc, stationID, event_id) AS rk, count(*) OVER () AS n FROM f
  WHERE l24 IS NOT NULL AND target IS NOT NULL AND pm10_ugm3 IS NOT NULL AND has_no2),
s AS (SELECT *, CASE WHEN rk <= floor(n * 0.7::DOUBLE) THEN 'train'
  WHEN rk <= floor(n * (0.7::DOUBLE + 0.15::DOUBLE)) THEN 'val' ELSE 'test' END AS split FROM g),
t AS (SELECT avg(c) AS cm, stddev_samp(c) AS cs, avg(pm10_ugm3) AS pm, stddev_samp(pm10_ugm3) AS ps, avg(hour) AS hm,
  stddev_samp(hour) AS hs, avg(weekend) AS wm, stddev_samp(weekend) AS ws, avg(m24) AS mm, stddev_samp(m24) AS ms,
  avg(CASE WHEN l1 <> 0 THEN (c - l1) / l1 * 100 END) AS dm,
  stddev_samp(CASE WHEN l1 <> 0 THEN (c - l1) / l1 * 100 END) AS ds FROM s WHERE split = 'train')
SELECT lpad(event_id::VARCHAR, 20, '0') AS record_hash, split, round((c - cm) / cs, 6) AS {TARGET},
  round((pm10_ugm3 - pm) / ps, 6) AS pm10_ugm3, round((hour - hm) / hs, 6) AS hour, round((weekend - wm) / ws, 6) AS is_weekend,
  round((m24 - mm) / ms, 6) AS {TARGET}_rolling_mean_24h,
  CASE WHEN l1 <> 0 THEN round(((c - l1) / l1 * 100 - dm) / ds, 6) END AS {TARGET}_pct_change_1h, target AS target_{TARGET}_24h FROM s, t""",
)
def job_hourly_gold(spark, sf_dir):
    gold_table, _ = hourly_gold(silver_obs(spark, sf_dir), HourlyConfig())
    cols = [TARGET, "pm10_ugm3", "hour", "is_weekend", f"{TARGET}_rolling_mean_24h"]
    change = f"{TARGET}_pct_change_1h"  # infinite after a zero, which SQL has as null
    finite = F.when(F.abs(change) < float("inf"), F.round(change, 6)).alias(change)
    return gold_table.select("record_hash", "split", *[r6(c) for c in cols], finite, f"target_{TARGET}_24h")


@query(
    "job_combined_gold",
    f"""WITH {OBS}, s AS (SELECT stationID, avg({TARGET}) AS m, avg(pm10_ugm3) AS p FROM obs GROUP BY 1),
f AS (SELECT *, lag({TARGET}, 6) OVER w AS l6, count({TARGET}) OVER r AS n12, max({TARGET}) OVER r AS x12,
  stddev_samp({TARGET}) OVER r AS s12 FROM obs
  WINDOW w AS ({W}), r AS ({W} ROWS BETWEEN 11 PRECEDING AND CURRENT ROW))
SELECT lpad(event_id::VARCHAR, 20, '0') AS record_hash, {TARGET}, l6 AS {TARGET}_lag_6h,
  CASE WHEN n12 = 12 THEN x12 END AS {TARGET}_rolling_max_12h,
  CASE WHEN n12 = 12 THEN round(s12, 6) END AS {TARGET}_rolling_std_12h,
  round(sin(hour(timestamp_utc) * 2 * 3.14159::DOUBLE / 24), 6) AS hour_sin,
  (isodow(timestamp_utc) < 5)::INT AS is_weekday, round(m, 6) AS station_pm25_mean, round(p, 6) AS station_pm10_mean
FROM f JOIN s USING (stationID) WHERE {TARGET} IS NOT NULL""",
)
def job_combined_gold(spark, sf_dir):
    g = combined_gold(silver_obs(spark, sf_dir), CombinedConfig())
    return g.select(
        "record_hash",
        TARGET,
        f"{TARGET}_lag_6h",
        f"{TARGET}_rolling_max_12h",
        r6(f"{TARGET}_rolling_std_12h"),
        r6("hour_sin"),
        F.col("is_weekday").cast("int").alias("is_weekday"),
        r6("station_pm25_mean"),
        r6("station_pm10_mean"),
    )


@query(
    "gold_manifest",
    f"""WITH {OBS}, {DAILY_WEATHER}, f AS (SELECT date, row_number() OVER (ORDER BY date, stationID) AS rk,
  count(*) OVER () AS n FROM daily),
s AS (SELECT date, CASE WHEN rk <= floor(n * 0.7::DOUBLE) THEN 'train'
  WHEN rk <= floor(n * (0.7::DOUBLE + 0.15::DOUBLE)) THEN 'val' ELSE 'test' END AS split FROM f)
SELECT count(*) FILTER (split = 'train') AS train_rows, count(*) FILTER (split = 'val') AS val_rows,
  count(*) FILTER (split = 'test') AS test_rows, strftime(min(date) FILTER (split = 'val'), '%Y-%m-%d') AS val_first,
  strftime(max(date) FILTER (split = 'val'), '%Y-%m-%d') AS val_last, 72 AS total_count, 23 AS normalized_count FROM s""",
)
def gold_manifest(spark, sf_dir):
    """Manifest of the weather-only daily table: 49 columns and 25 that can be normalised.

    The events lie within one month, so the two month encodings have no spread and are left out.
    """
    gold_table, _ = daily_gold(obs(spark, sf_dir), None, replace(DailyConfig(), ties=TIES))
    m = gold.manifest(gold_table, "date", {}, "1.0.0", "2024-02-01T00:00:00Z")
    return m.select(
        F.col("splits.train.rows").alias("train_rows"),
        F.col("splits.val.rows").alias("val_rows"),
        F.col("splits.test.rows").alias("test_rows"),
        F.col("splits.val.first").alias("val_first"),
        F.col("splits.val.last").alias("val_last"),
        "features.total_count",
        "features.normalized_count",
    )


_SILVER = {
    "stationID": None,
    "lat": "lat",
    "lon": "lon",
    "timestamp_utc": None,
    "timestamp_unix_ms": "(epoch_us(timestamp_utc) // 1000)",
    TARGET: TARGET,
    "pm10_ugm3": "pm10_ugm3",
    "nitrogen_dioxide_ugm3": "no2_ugm3",
    "ozone_ugm3": "o3_ugm3",
    "sulphur_dioxide_ugm3": "so2_ugm3",
    "carbon_monoxide_ugm3": "co_ugm3",
    "data_source": None,
    "ingestion_timestamp_utc": None,
    "load_id": None,
    "pipeline_version": None,
    "record_hash": None,
}


def _report_sql(name: str, value: str | None) -> str:
    nulls = f"count(*) FILTER ({value} IS NULL)" if value else "0"
    stats = [f"{fn}({value})::DOUBLE" if value else "NULL" for fn in ("min", "max", "avg")]
    digits = 3 if name == "timestamp_unix_ms" else 6
    return (
        f"SELECT 'profile' AS section, '{name}' AS item, unnest(['null_count', 'null_pct', 'min', 'max', 'mean']) AS metric, "
        f"round(unnest([({nulls})::DOUBLE, round(({nulls}) * 100.0::DOUBLE / count(*), 2), {', '.join(stats)}]), {digits}) AS value FROM obs"
    )


@query(
    "job_quality_report",
    f"WITH {OBS}, c AS (SELECT count(DISTINCT CAST(timestamp_utc AS DATE)) AS u, "
    "datediff('day', min(timestamp_utc), max(timestamp_utc)) + 1 AS e, count(DISTINCT stationID) AS s, count(*) AS n FROM obs) "
    + " UNION ALL ".join(_report_sql(name, value) for name, value in _SILVER.items())
    + """ UNION ALL SELECT 'temporal', 'date', unnest(['unique_dates', 'expected_days', 'missing_days', 'coverage_pct']),
  unnest([u::DOUBLE, e::DOUBLE, (e - u)::DOUBLE, round(u * 100.0::DOUBLE / e, 2)]) FROM c
UNION ALL SELECT 'stations', 'stationID', unnest(['unique_stations', 'total_records', 'avg_records_per_station']),
  unnest([s::DOUBLE, n::DOUBLE, (n // s)::DOUBLE]) FROM c""",
)
def job_quality_report(spark, sf_dir):
    # Three digits for epoch times: SQL rounds by scaling, and six more digits do not fit a double there.
    digits = F.when(F.col("item") == "timestamp_unix_ms", F.round("value", 3)).otherwise(F.round("value", 6))
    return quality_metrics(silver_obs(spark, sf_dir)).select("section", "item", "metric", digits.alias("value"))
