"""Queries that go through stored files and streams. Every file is derived from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelines.catalog.derived import BRONZE, OBS, W, bronze_docs, events, obs, panel, silver_obs
from tidelines.catalog.feature_queries import TARGET
from tidelines.catalog.registry import day, query, r6
from tidelines.functions.records import any_time
from tidelines.operators.reports import merged_coverage, merged_profile, store_report, stored_report
from tidelines.operators.windows import lags, rolling
from tidelines.panel import Panel
from tidelines.plans.config import HourlyConfig
from tidelines.plans.gold_jobs import run_hourly_gold
from tidelines.plans.silver_jobs import run_bronze_to_silver
from tidelines.session import scratch_dir, staged
from tidelines.sources import bronze, inventory, silver
from tidelines.sources.files import delete, list_files
from tidelines.sources.ledger import Ledger
from tidelines.streaming import panel_streams as ps

_LOAD = {"data_source": "events", "load_id": "load-1", "ingested_at": "2024-02-01T00:00:00"}
_SILVER_SQL = f"""WITH {BRONZE} SELECT stationID, epoch_ms(stamp) AS timestamp_unix_ms, round(pm2_5, 6) AS pm2_5_ugm3,
  round(no2, 6) AS nitrogen_dioxide_ugm3, round(pm10, 6) AS pm10_ugm3 FROM bronze"""
_SILVER_COLS = [TARGET, "nitrogen_dioxide_ugm3", "pm10_ugm3"]


@query("job_bronze_to_silver", _SILVER_SQL)
def job_bronze_to_silver(spark, sf_dir):
    root = scratch_dir(spark, "bronze")
    bronze.write_bronze(bronze_docs(spark, sf_dir, deal=True).drop("event_id"), f"{root}/bronze")
    s = run_bronze_to_silver(spark, f"{root}/bronze", f"{root}/silver", **_LOAD)
    return s.select("stationID", "timestamp_unix_ms", *[r6(c) for c in _SILVER_COLS])


@query("repeated_loads", _SILVER_SQL)
def repeated_loads(spark, sf_dir):
    """Half of the documents are loaded, then all of them, then all again; a load of the rest that was interrupted between
    its write and its commit lies in between. Silver must hold what one load gives."""
    root = scratch_dir(spark, "repeated")
    docs = bronze_docs(spark, sf_dir, deal=True)
    even = F.col("event_id") % 2 == 0
    paths = (f"{root}/bronze", f"{root}/silver")
    ledger = f"{root}/ledger"
    load = lambda number: run_bronze_to_silver(spark, *paths, **{**_LOAD, "load_id": f"load-{number}"}, ledger=ledger)
    bronze.write_bronze(docs.filter(even).drop("event_id"), paths[0])
    load(1)
    bronze.write_bronze(docs.filter(~even).drop("event_id"), paths[0])
    # What the job does up to the moment it is interrupted: begun and written, not committed.
    Ledger(ledger).begin(spark, "load-2")
    silver.write_silver(bronze.air_quality_silver(bronze.with_station(bronze.read_bronze(spark, paths[0])), **{**_LOAD, "load_id": "load-2"}), paths[1])
    load(2)
    s = load(3)
    return s.select("stationID", "timestamp_unix_ms", *[r6(c) for c in _SILVER_COLS])


@query(
    "silver_round_trip",
    f"""WITH {OBS} SELECT lpad(event_id::VARCHAR, 20, '0') AS record_hash, stationID, {TARGET},
  round(co_ugm3, 6) AS carbon_monoxide_ugm3 FROM obs WHERE year(timestamp_utc) = 2024""",
)
def silver_round_trip(spark, sf_dir):
    root = scratch_dir(spark, "silver")
    silver.write_silver(silver_obs(spark, sf_dir), root)
    back = silver.read_air_quality(spark, [silver.Generation(root)], years=[2024])
    return back.select("record_hash", "stationID", TARGET, r6("carbon_monoxide_ugm3"))


@query(
    "layer_inventory",
    f"""WITH {BRONZE} SELECT * FROM (VALUES ('bronze', true, (SELECT count(*) FROM bronze)), ('gold', false, 0),
  ('silver', true, (SELECT count(*) FROM events))) AS t(layer, has_files, n_rows)""",
)
def layer_inventory(spark, sf_dir):
    root = scratch_dir(spark, "layers")
    bronze.write_bronze(bronze_docs(spark, sf_dir, deal=True).drop("event_id"), f"{root}/bronze")
    silver.write_silver(silver_obs(spark, sf_dir), f"{root}/silver")
    layers = {"bronze": f"{root}/bronze", "silver": f"{root}/silver", "gold": f"{root}/gold"}
    found = inventory.layer_inventory(spark, layers)
    readings = bronze.read_bronze(spark, layers["bronze"]).select(F.explode("hourly.time").alias("time"))
    rows = {"bronze": readings.filter(any_time(F.col("time")).isNotNull()).count(), "silver": spark.read.parquet(layers["silver"]).count()}
    counted = F.create_map(*[F.lit(x) for pair in rows.items() for x in pair])[F.col("layer")]
    return found.select("layer", F.col("exists").alias("has_files"), F.coalesce(counted, F.lit(0)).cast("long").alias("n_rows"))


@query("mixed_generations", f"""WITH {OBS} SELECT lpad(event_id::VARCHAR, 20, '0') AS record_hash, stationID, {TARGET},
  epoch_us(timestamp_utc) AS at FROM obs""")
def mixed_generations(spark, sf_dir):
    """Rows of even and odd events stored by two versions of the loader, in the same month folders."""
    root = scratch_dir(spark, "mixed")
    rows = silver_obs(spark, sf_dir)
    even = F.substring("record_hash", 20, 1).cast("int") % 2 == 0
    silver.write_silver(rows.filter(even), root)
    text = F.date_format("ingestion_timestamp_utc", "yyyy-MM-dd'T'HH:mm:ss")
    silver.write_silver(rows.filter(~even).withColumn("ingestion_timestamp_utc", text), root)
    back = silver.read_air_quality(spark, [silver.Generation(root)])
    return back.select("record_hash", "stationID", TARGET, F.unix_micros("timestamp_utc").alias("at"))


@query(
    "checksum_verify",
    f"""WITH {OBS}, rows AS (SELECT timestamp_utc - to_years(CAST(event_id % 4 AS INTEGER)) AS stamp FROM obs), months AS (
  SELECT DISTINCT year(stamp) AS year, strftime(stamp, 'year=%Y/month=%m') AS folder FROM rows), top AS (SELECT max(year) AS y FROM months)
SELECT folder, CASE top.y - year WHEN 0 THEN 'mismatch' WHEN 1 THEN 'missing' ELSE 'ok' END AS status FROM months, top
UNION ALL SELECT folder || '/more', 'unrecorded' FROM months, top WHERE year = top.y""",
)
def checksum_verify(spark, sf_dir):
    """Checksums of Silver over several years are stored; then the last year is written anew with other contents, a folder
    is added to it, and the year before is deleted."""
    root = scratch_dir(spark, "checksums")
    silver_dir = f"{root}/silver"
    back = F.make_ym_interval((-(F.col("record_hash").cast("long") % 4)).cast("int"), F.lit(0))
    rows = silver_obs(spark, sf_dir).withColumn("timestamp_utc", F.col("timestamp_utc") + back)
    silver.write_silver(rows, silver_dir)
    inventory.write_checksums(spark, silver_dir, f"{root}/sums")
    stored = spark.read.parquet(silver_dir)
    last = stored.agg(F.max("year")).first()[0]
    altered = stored.filter(F.col("year") == last).withColumn("pipeline_version", F.lit("x"))
    altered = staged(altered.withColumn("month", F.lpad("month", 2, "0")), "altered")
    altered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year", "month").parquet(silver_dir)
    for row in altered.select("month").distinct().collect():
        altered.filter(F.col("month") == row["month"]).drop("year", "month").write.parquet(f"{silver_dir}/year={last}/month={row['month']}/more")
    gone = stored.filter(F.col("year") == last - 1).select(F.col("_metadata.file_path").alias("file")).distinct()
    delete(spark, [r["file"] for r in gone.collect()])
    status = inventory.verify_checksums(spark, silver_dir, inventory.read_checksums(spark, f"{root}/sums"))
    # New files have new names; by folder, old and new ones are the same file.
    folder = F.regexp_replace("name", "/[^/]*$", "").alias("folder")
    seen = status.groupBy(folder).agg(F.collect_set("status").alias("s"))
    altered_in_place = F.array_contains("s", "missing") & F.array_contains("s", "unrecorded")
    return seen.select("folder", F.when(altered_in_place, F.lit("mismatch")).otherwise(F.element_at("s", 1)).alias("status"))


@query("stream_bronze_to_silver", _SILVER_SQL)
def stream_bronze_to_silver(spark, sf_dir):
    root = scratch_dir(spark, "stream-bronze")
    bronze.write_bronze(bronze_docs(spark, sf_dir, deal=True).drop("event_id"), f"{root}/bronze")
    rows = ps.bronze_to_silver(ps.read_bronze_stream(spark, f"{root}/bronze"), **_LOAD)
    ps.append_parquet(rows, f"{root}/silver", f"{root}/checkpoint", ["year", "month"]).awaitTermination()
    s = silver.read_air_quality(spark, [silver.Generation(f"{root}/silver")])
    return s.select("stationID", "timestamp_unix_ms", *[r6(c) for c in _SILVER_COLS])


@query("hourly_gold_files", f"""WITH {OBS} SELECT lpad(event_id::VARCHAR, 20, '0') AS record_hash, {TARGET},
  lag({TARGET}) OVER w AS {TARGET}_lag_1h, lead({TARGET}) OVER w AS target_{TARGET}_1h FROM obs WHERE {TARGET} IS NOT NULL
  WINDOW w AS (PARTITION BY stationID ORDER BY timestamp_utc, event_id)
  QUALIFY lag({TARGET}, 24) OVER w IS NOT NULL AND target_{TARGET}_1h IS NOT NULL""")
def hourly_gold_files(spark, sf_dir):
    """The hourly job from written files to written splits, which are read back."""
    root = scratch_dir(spark, "hourly-job")
    gaps = ("pm10_ugm3", "nitrogen_dioxide_ugm3", "ozone_ugm3", "sulphur_dioxide_ugm3", "carbon_monoxide_ugm3")
    rows = silver_obs(spark, sf_dir)
    silver.write_silver(rows.withColumns({c: F.coalesce(c, F.lit(0.0)) for c in gaps if c in rows.columns}), f"{root}/air")
    config = HourlyConfig(lag_hours=(1,), rolling_windows=(), horizon=1, dedupe=False, normalise=False)
    paths = run_hourly_gold(spark, [silver.Generation(f"{root}/air")], f"{root}/gold", config)
    back = spark.read.parquet(paths["splits"])
    return back.select("record_hash", TARGET, f"{TARGET}_lag_1h", f"target_{TARGET}_1h")


def _event_stream(spark, sf_dir):
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    raw = ps.read_stream(spark, sf_dir, schema, "events.parquet")
    return raw.withColumn("ts", F.col("ts").cast("timestamp"))


@query(
    "stream_daily",
    """SELECT strftime(ts, '%Y-%m-%d') AS date, user_id, count(*) AS rows, round(avg(value), 6) AS value_mean,
  min(value) AS value_min, max(value) AS value_max FROM events GROUP BY 1, 2""",
)
def stream_daily(spark, sf_dir):
    """Events arrive in files of one week each, a micro-batch per file; days are finished as the watermark passes them."""
    root = scratch_dir(spark, "stream-daily")
    e = events(spark, sf_dir).select("user_id", "ts", "value")
    week = F.trunc("ts", "week")
    for row in e.select(week.alias("week")).distinct().orderBy("week").collect():
        e.filter(week == F.lit(row.week)).coalesce(1).write.mode("append").parquet(f"{root}/arrivals")
    days = ps.daily_means(ps.read_stream(spark, f"{root}/arrivals", e.schema, files_per_trigger=1), Panel("user_id", "ts"), ["value"])
    ps.keep_days(days, f"{root}/days", f"{root}/checkpoint", ["date", "user_id"]).awaitTermination()
    final = ps.read_days(spark, f"{root}/days")
    last = e.agg(F.max("ts")).first()[0]
    open_ = F.col("date") >= F.to_date(F.lit(last) - F.expr("INTERVAL 2 DAYS"))
    return final.filter(F.col("closed") != open_).select(day(), "user_id", "rows", r6("value_mean"), "value_min", "value_max")


@query("stream_dedupe", "SELECT DISTINCT user_id, epoch_us(ts) AS at_micros FROM events")
def stream_dedupe(spark, sf_dir):
    """Every event arrives once, and those divisible by five a second time."""
    root = scratch_dir(spark, "stream-dedupe")
    copies = F.when(F.col("event_id") % 5 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    sent = _event_stream(spark, sf_dir).withColumn("copy", F.explode(copies)).select("user_id", "ts")
    once = ps.dedupe(sent, Panel("user_id", "ts"))
    ps.append_parquet(once, f"{root}/rows", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/rows").select("user_id", F.unix_micros("ts").alias("at_micros"))


@query(
    "stream_features",
    f"""WITH {OBS} SELECT event_id, lag({TARGET}, 2) OVER ({W}) AS {TARGET}_lag_2h,
  CASE WHEN count({TARGET}) OVER f = 3 THEN round(avg({TARGET}) OVER f, 6) END AS {TARGET}_rolling_mean_3h
FROM obs WINDOW f AS ({W} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
)
def stream_features(spark, sf_dir):
    """Rows arrive in shuffled order, in five parts; later parts correct what earlier ones have given. With a ring of
    five rows most late rows are found in it, the others in the history."""
    root = scratch_dir(spark, "stream-features")
    o = obs(spark, sf_dir).select("event_id", "stationID", "timestamp_utc", TARGET)
    part = F.pmod(F.xxhash64("event_id"), F.lit(5))
    for k in range(5):
        o.filter(part == k).write.mode("append").parquet(f"{root}/arrivals")
    # A part has as many files as tasks have written it; batches are a fifth of the files each.
    files = list_files(spark, f"{root}/arrivals", "*.parquet").count()
    ps.incremental_features(
        ps.read_stream(spark, f"{root}/arrivals", o.schema, files_per_trigger=max(1, -(-files // 5))),
        panel(),
        [lags([TARGET], [2]), rolling([TARGET], [3], ["mean"])],
        f"{root}/features",
        f"{root}/checkpoint",
        f"{root}/history",
        late_rows=5,
    ).awaitTermination()
    final = ps.latest_updates(spark, f"{root}/features", ["event_id", "stationID", "timestamp_utc"])
    return final.select("event_id", f"{TARGET}_lag_2h", r6(f"{TARGET}_rolling_mean_3h"))


def _monthly_report(spark, sf_dir):
    """All months but the last are stored, then a last one that was half there, then that month again, alone."""
    path = f"{scratch_dir(spark, 'reports')}/report"
    table = obs(spark, sf_dir)
    last = table.agg(F.max(F.to_date("timestamp_utc"))).first()[0].replace(day=1)
    store_report(table.filter(F.col("timestamp_utc") < F.lit(last).cast("timestamp")), path, "timestamp_utc", [TARGET])
    for part in (table.filter(F.dayofmonth("timestamp_utc") < 5), table):
        store_report(part, path, "timestamp_utc", [TARGET], months=[last])
    return stored_report(spark, path)


@query(
    "monthly_profile",
    f"""WITH {OBS} SELECT count(*) AS rows, count(*) FILTER (pm2_5_ugm3 IS NULL) AS null_count, round(min(pm2_5_ugm3), 6) AS min,
  round(max(pm2_5_ugm3), 6) AS max, round(avg(pm2_5_ugm3), 6) AS mean FROM obs""",
)
def monthly_profile(spark, sf_dir):
    return merged_profile(_monthly_report(spark, sf_dir)).select("rows", "null_count", r6("min"), r6("max"), r6("mean"))


@query(
    "monthly_coverage",
    f"""WITH {OBS}, c AS (SELECT min(timestamp_utc::DATE) AS first, max(timestamp_utc::DATE) AS last,
    count(DISTINCT timestamp_utc::DATE) AS days FROM obs)
SELECT strftime(first, '%Y-%m-%d') AS min_date, strftime(last, '%Y-%m-%d') AS max_date, days AS unique_dates,
  last - first + 1 AS expected_days, last - first + 1 - days AS missing_days FROM c""",
)
def monthly_coverage(spark, sf_dir):
    cover = merged_coverage(_monthly_report(spark, sf_dir))
    return cover.select(day("min_date", "min_date"), day("max_date", "max_date"), "unique_dates", "expected_days", "missing_days")
