"""Stored layers, whole jobs and streams."""

from __future__ import annotations

import gzip
import json
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidelines.catalog.derived import TIES, bronze_docs, obs, silver_obs
from tidelines.operators.clean import add_missing_columns, conform, latest_per_key
from tidelines.operators.normalise import Stat, fit, normalise_in_place, read_stats, usable, write_stats
from tidelines.operators.planning import day_periods, periods
from tidelines.operators.quality import Rule, column_group, quarantine, schema_diff, training_span
from tidelines.plans.config import CombinedConfig, DailyConfig, HourlyConfig
from tidelines.plans.gold_jobs import (
    combined_gold,
    daily_gold,
    hourly_features,
    hourly_gold,
    newest_readings,
    run_combined_gold,
    run_daily_gold,
    run_hourly_gold,
)
from tidelines.plans.silver_jobs import run_bronze_to_silver
from tidelines.schemas import AIR_QUALITY_SILVER, WEATHER_BRONZE, WEATHER_SILVER
from tidelines.session import scratch_dir
from tidelines.sources import bronze, gold, inventory, silver

LOAD = {"data_source": "test", "load_id": "l1", "ingested_at": "2024-02-01T00:00:00"}


def gz(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with gzip.open(path, "wt", encoding="utf-8") as f:
        f.write(text if isinstance(text, str) else json.dumps(text))


def document(times, **arrays):
    return {"latitude": 13.7, "longitude": 100.5, "hourly": {"time": times, **arrays}}


@pytest.fixture
def bronze_dir(tmp_path):
    root = tmp_path / "bronze"
    times = ["2023-12-31T23:00", "2024-01-01T00:00", "2024-01-01T01:00"]
    gz(f"{root}/2023/12/batch_20231231_202312_st_1.json.gz", document(times, pm2_5=[1.5, None], no2=[1, 2, 3]))
    gz(f"{root}/2023/12/batch_20231231_202312_st_2.json.gz", document([]))
    gz(f"{root}/2023/12/batch_20231231_202312_st_3.json.gz", '{"latitude": 1, "hourly": ')
    path = f"{root}/2023/12/batch_20231231_202312_st_4.json.gz"
    gz(path, document(times, pm2_5=[1, 2, 3]))
    with open(path, "rb") as f:
        head = f.read()[:20]
    with open(path, "wb") as f:
        f.write(head)
    return str(root)


def test_bronze_to_silver(spark, bronze_dir, tmp_path):
    stations = spark.createDataFrame([("st_1", 13.0, 100.0)], "stationID string, lat double, lon double")
    target = str(tmp_path / "silver")
    rows = run_bronze_to_silver(
        spark, bronze_dir, target, stations=stations, checksums=str(tmp_path / "sums"), losses=str(tmp_path / "lost"), **LOAD
    ).orderBy("timestamp_utc").collect()
    assert [(r.stationID, r.lat, r.pm2_5_ugm3, r.nitrogen_dioxide_ugm3, r.ozone_ugm3) for r in rows] == [
        ("st_1", 13.0, 1.5, 1.0, None),
        ("st_1", 13.0, None, 2.0, None),
        ("st_1", 13.0, None, 3.0, None),
    ]
    # md5 of "st_1_2023-12-31T23:00_1.5"
    import hashlib

    assert rows[0].record_hash == hashlib.md5(b"st_1_2023-12-31T23:00_1.5").hexdigest()
    assert rows[1].record_hash == hashlib.md5(b"st_1_2024-01-01T00:00_None").hexdigest()
    # Rows are filed under the month of their own time, not under that of the document.
    parts = {(r.year, r.month) for r in spark.read.parquet(target).select("year", "month").distinct().collect()}
    assert parts == {(2023, 12), (2024, 1)}
    recorded = inventory.read_checksums(spark, str(tmp_path / "sums"))
    assert {r.status for r in inventory.verify_checksums(spark, target, recorded).collect()} == {"ok"}


def test_damaged_files_are_named(spark, bronze_dir):
    docs = bronze.read_bronze(spark, bronze_dir, skip_broken=True).cache()
    assert docs.filter("_corrupt IS NOT NULL").count() == 1
    lost = {os.path.basename(r.file_path): (r.reason, r.documents) for r in bronze.losses(spark, bronze_dir).collect()}
    assert "batch_20231231_202312_st_4.json.gz" in lost
    assert sorted(n for _, n in lost.values() if n) == [1]


def test_cut_file_is_named_and_stops_the_job(spark, tmp_path):
    import gzip

    from tidelines.sources.footers import LostData

    lines = "\n".join(json.dumps({"stationID": "a", "hourly": {"time": ["2024-01-01T00:00"], "pm2_5": [k]}}) for k in range(5_000))
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "whole.json.gz").write_bytes(gzip.compress(lines[:2_000].rsplit("\n", 1)[0].encode()))
    packed = gzip.compress(lines.encode())
    (tmp_path / "b" / "cut.json.gz").write_bytes(packed[: len(packed) // 2])
    load = {"data_source": "x", "load_id": "l", "ingested_at": "2024-02-01T00:00:00"}
    with pytest.raises(LostData, match="cut.json.gz: truncated"):
        run_bronze_to_silver(spark, str(tmp_path / "b"), str(tmp_path / "s"), **load)
    assert not (tmp_path / "s").exists()
    run_bronze_to_silver(spark, str(tmp_path / "b"), str(tmp_path / "s"), **load, losses=str(tmp_path / "lost"))
    lost = spark.read.parquet(str(tmp_path / "lost")).collect()
    assert {os.path.basename(r.file_path) for r in lost if r.reason == "truncated"} == {"cut.json.gz"}


def test_mixed_folder_keeps_all_rows(spark, tmp_path):
    us = pa.timestamp("us", tz="UTC")
    folder = tmp_path / "air" / "year=2024" / "month=01"
    folder.mkdir(parents=True)
    times = [1_704_067_200_000_000 + 3_600_000_000 * k for k in range(4)]
    kinds = {
        "text": pa.array(["2024-01-02T03:04:05"] * 4),
        "utc": pa.array([1_704_164_645_000_000] * 4, us),
        "plain": pa.array([1_704_164_645_000_000] * 4, pa.timestamp("us")),
    }
    for name, ingested in kinds.items():
        columns = {"stationID": [name] * 4, "timestamp_utc": pa.array(times, us), "pm2_5_ugm3": [1.0, 2.0, None, 4.0]}
        pq.write_table(pa.table({**columns, "ingestion_timestamp_utc": ingested}), folder / f"{name}.parquet")
    df = silver.read_air_quality(spark, [silver.Generation(str(tmp_path / "air"))])
    assert df.count() == len(df.collect()) == 12
    assert {str(r.ingestion_timestamp_utc) for r in df.collect()} == {"2024-01-02 03:04:05"}
    (folder / "broken.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception, match="broken.parquet"):
        silver.read_air_quality(spark, [silver.Generation(str(tmp_path / "air"))])
    kept = silver.read_air_quality(spark, [silver.Generation(str(tmp_path / "air"))], losses=str(tmp_path / "lost"))
    assert kept.count() == 12
    assert spark.read.parquet(str(tmp_path / "lost")).count() == 1


def test_numbered_station_names(spark, tmp_path):
    gz(f"{tmp_path}/b/batch_20240101_0001.json.gz", document(["2024-01-01T00:00"], temperature_2m=[20]))
    numbers = spark.createDataFrame([(1, "x9")], "number int, stationID string")
    docs = bronze.with_station(bronze.read_bronze(spark, f"{tmp_path}/b", WEATHER_BRONZE), numbers)
    row = bronze.weather_silver(docs, **LOAD).first()
    assert (row.stationID, row.temp_c, row.u10_ms) == ("x9", 20.0, None)


def test_weather_silver_units_and_hash(spark, tmp_path):
    import hashlib

    gz(
        f"{tmp_path}/b/batch_20240101_b_w1.json.gz",
        document(["2024-01-01T05:00", "bad"], wind_speed_10m=[36, 1], wind_u_component_10m=[36, 1], wind_v_component_10m=[None, 1]),
    )
    docs = bronze.with_station(bronze.read_bronze(spark, f"{tmp_path}/b", WEATHER_BRONZE))
    out = bronze.weather_silver(docs, **LOAD)
    assert out.schema.names == WEATHER_SILVER.names
    rows = out.collect()
    assert len(rows) == 1
    assert (rows[0].wind_ms, rows[0].u10_ms, rows[0].v10_ms) == (36.0, 10.0, None)
    assert rows[0].record_hash == hashlib.sha256(b"w1|2024-01-01 05:00:00+00:00").hexdigest()[:16]


def test_generations_are_reconciled(spark, tmp_path):
    us = pa.timestamp("us", tz="UTC")
    common = {"stationID": ["a"], "pm2_5_ugm3": pa.array([1.5], pa.float32())}
    old = {
        **common,
        "timestamp_utc": pa.array([1_704_067_200_000_000_123], pa.timestamp("ns", tz="UTC")),
        "no2_ugm3": pa.array([2.5], pa.float32()),
        "ingestion_timestamp_utc": pa.array([1_704_067_200_000_000], us),
    }
    new = {
        "stationID": ["b"],
        "pm2_5_ugm3": [3.0],
        "timestamp_utc": pa.array([1_704_067_200_000_000], us),
        "nitrogen_dioxide_ugm3": [4.0],
        "ingestion_timestamp_utc": ["2024-01-02T03:04:05.5"],
    }
    for name, data in (("old", old), ("new", new)):
        folder = tmp_path / name / "year=2024" / "month=01"
        folder.mkdir(parents=True)
        pq.write_table(pa.table(data), folder / "part.parquet")
    before = spark.conf.get("spark.sql.legacy.parquet.nanosAsLong")
    silver.allow_nanoseconds(spark)
    try:
        gens = [silver.Generation(str(tmp_path / "old"), nanos=True), silver.Generation(str(tmp_path / "new"), "string")]
        df = silver.read_air_quality(spark, gens, years=[2024])
        assert df.schema.names == AIR_QUALITY_SILVER.names
        rows = df.orderBy("stationID").collect()
        assert [(r.stationID, r.pm2_5_ugm3, r.nitrogen_dioxide_ugm3) for r in rows] == [("a", 1.5, 2.5), ("b", 3.0, 4.0)]
        assert len({r.timestamp_utc for r in rows}) == 1
        assert str(rows[1].ingestion_timestamp_utc) == "2024-01-02 03:04:05.500000"
        assert silver.read_air_quality(spark, gens, years=[1999]).count() == 0
    finally:
        spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", before)
    with pytest.raises(ValueError):
        silver.read_air_quality(spark, [])


def test_missing_inputs(spark, tmp_path):
    assert silver.read_optional_air_quality(spark, str(tmp_path / "absent")) is None
    with pytest.raises(Exception):
        silver.read_weather(spark, str(tmp_path / "absent"))
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError):
        silver.read_weather(spark, str(tmp_path / "empty"))


def test_schema_helpers(spark):
    df = spark.createDataFrame([("a", 1.0)], "stationID string, lat double")
    assert schema_diff(df, AIR_QUALITY_SILVER)["missing"][0] == "lon"
    assert add_missing_columns(df, AIR_QUALITY_SILVER).schema.names == AIR_QUALITY_SILVER.names
    with pytest.raises(Exception):
        conform(df, AIR_QUALITY_SILVER)
    assert [column_group(c) for c in ("x_norm", "a_lag_1h", "a_rolling_mean_3h", "station_x", "hour_sin", "year", "lat")] == [
        "normalised", "lag", "rolling", "station", "calendar", "calendar", "original"
    ]


def test_quarantine_is_a_partition(spark):
    df = spark.createDataFrame([(1.0,), (None,), (11.0,)], "x double")
    good, bad = quarantine(df, [Rule("x", 0, 10)])
    assert (good.count(), [r.violations for r in bad.collect()]) == (2, [["x_range"]])
    assert quarantine(df, [Rule("x", 0, 10, required=True)])[1].count() == 2


def test_checksum_states(spark, tmp_path):
    data = tmp_path / "d"
    data.mkdir()
    for n in ("a", "b", "c"):
        (data / f"{n}.parquet").write_bytes(n.encode())
    import hashlib

    (data / "a.parquet.md5").write_text(hashlib.md5(b"a").hexdigest() + "  a.parquet\n")
    (data / "b.parquet.md5").write_text(hashlib.md5(b"x").hexdigest() + "  b.parquet\n")
    (data / "z.parquet.md5").write_text(hashlib.md5(b"z").hexdigest() + "  z.parquet\n")
    recorded = inventory.read_sidecars(spark, str(data))
    got = {r.name[0]: r.status for r in inventory.verify_checksums(spark, str(data), recorded).collect()}
    assert got == {"a": "ok", "b": "mismatch", "c": "unrecorded", "z": "missing"}
    layers = inventory.layer_inventory(spark, {"d": str(data), "none": str(tmp_path / "none")}, "*.parquet")
    assert {(r.layer, r.exists, r.files, r.bytes) for r in layers.collect()} == {("d", True, 3, 3), ("none", False, 0, 0)}


def test_periods(spark):
    one = spark.sql("SELECT date'2024-01-01' AS a, date'2024-08-10' AS b")
    got = one.select(F.inline(periods(F.col("a"), F.col("b"), 3))).collect()
    assert [(str(r.start), str(r.end)) for r in got] == [
        ("2024-01-01", "2024-03-31"), ("2024-04-01", "2024-06-30"), ("2024-07-01", "2024-08-10")
    ]
    days = one.select(F.inline(day_periods(F.col("a"), F.date_add("a", 9), 7))).collect()
    assert [(str(r.start), str(r.end)) for r in days] == [("2024-01-01", "2024-01-07"), ("2024-01-08", "2024-01-10")]


def test_newest_reading_wins(spark):
    df = spark.sql(
        """SELECT 'a' AS stationID, timestamp'2024-01-01' AS timestamp_utc, v AS x, timestamp'2024-02-01' + make_dt_interval(v)
        AS ingestion_timestamp_utc, 'h' AS record_hash FROM (SELECT explode(array(1, 3, 2)) AS v)"""
    )
    assert [r.x for r in newest_readings(df).collect()] == [3]
    assert latest_per_key(df, ["stationID"], [F.col("x")]).first().x == 1


def test_column_counts(spark, sf_dir):
    o, s = obs(spark, sf_dir), silver_obs(spark, sf_dir)
    table, stats = daily_gold(o, None, DailyConfig(ties=TIES))
    assert len([c for c in table.columns if not c.endswith("_norm")]) == 49
    assert len([x for x in stats if usable(x, 1e-8)]) == len(table.columns) - 49
    features = hourly_features(s, HourlyConfig())
    assert len(features.columns) == 54
    assert len(hourly_gold(s, HourlyConfig())[1]) == 43
    assert len(combined_gold(s, CombinedConfig()).columns) == 52


def test_statistics_come_from_training_rows_only(spark):
    df = spark.createDataFrame([("train", 1.0, 5.0), ("train", 3.0, 5.0), ("test", 100.0, 9.0)], "split string, x double, c double")
    stats = fit(df.filter("split = 'train'"), ["x", "c"])
    out = normalise_in_place(df, stats).orderBy("x").collect()
    assert out[-1].x == pytest.approx((100 - 2) / 2**0.5) and out[-1].c == 9.0
    mm = normalise_in_place(df, fit(df.filter("split = 'train'"), ["x"], "minmax")).orderBy("x").collect()
    assert [r.x for r in mm] == [0.0, 1.0, 49.5]
    with pytest.raises(ValueError):
        fit(df, ["x"], "robust")


def test_stats_round_trip(spark, tmp_path):
    stats = [Stat("a", "standard", 0.1, 2.0), Stat("b", "minmax", -1e-7, None)]
    write_stats(spark, stats, str(tmp_path / "s"))
    assert sorted(read_stats(spark, str(tmp_path / "s")), key=lambda s: s.feature) == stats


def test_daily_job_from_files(spark, sf_dir, tmp_path):
    o = obs(spark, sf_dir)
    weather = add_missing_columns(o.withColumn("record_hash", F.col("event_id").cast("string")), WEATHER_SILVER)
    silver.write_silver(weather, str(tmp_path / "weather"))
    silver.write_silver(silver_obs(spark, sf_dir), str(tmp_path / "air"))
    paths = run_daily_gold(spark, str(tmp_path / "weather"), str(tmp_path / "air"), str(tmp_path / "gold"))
    train = gold.read_split(spark, paths["splits"], "train")
    row = spark.read.json(paths["manifest"]).first()
    assert train.count() == row.splits.train.rows > 0
    assert "co_mean" in train.columns and row.features.total_count == len(row.features.columns)
    without = run_daily_gold(spark, str(tmp_path / "weather"), str(tmp_path / "none"), str(tmp_path / "gold2"))
    assert "co_mean" not in gold.read_split(spark, without["splits"], "val").columns


def test_hourly_and_combined_jobs_from_files(spark, sf_dir, tmp_path):
    air = silver_obs(spark, sf_dir)
    silver.write_silver(air.unionByName(air), str(tmp_path / "air"))
    gens = [silver.Generation(str(tmp_path / "air"))]
    short = HourlyConfig(years=(2024,), lag_hours=(1,), rolling_windows=(3,), horizon=1)
    paths = run_hourly_gold(spark, gens, str(tmp_path / "gold"), short)
    config = spark.read.json(paths["manifest"]).first().config
    assert (int(config.rows_read), int(config.rows_dropped)) == (2 * air.count(), air.count())
    table = run_combined_gold(spark, gens, str(tmp_path / "gold"), CombinedConfig(years=(2024,)))["table"]
    # Every reading was stored twice and counts once.
    assert spark.read.parquet(table).count() == air.filter("pm2_5_ugm3 IS NOT NULL").count()


def test_training_span(spark):
    df = spark.sql("SELECT explode(array(date'2018-01-01', date'2018-01-10')) AS date, 'train' AS split")
    assert tuple(training_span(df, "split", "date", 10).first()) == (10, True)
    assert tuple(training_span(df, "split", "date").first()) == (10, False)


def test_command_line(spark, sf_dir, tmp_path, capsys):
    from tidelines.__main__ import main

    silver.write_silver(silver_obs(spark, sf_dir), str(tmp_path / "air"))
    main(["inspect", str(tmp_path / "air")])
    main(["inventory", f"silver={tmp_path / 'air'}"])
    main(["combined-gold", str(tmp_path / "gold"), f"{tmp_path / 'air'}:timestamp", "--years", "2024"])
    out = capsys.readouterr().out
    assert "unique_stations" in out and "|silver|true" in out and "airquality_combined" in out


def test_bronze_written_by_month(spark, sf_dir):
    path = scratch_dir(spark, "bronze-test")
    docs = bronze_docs(spark, sf_dir).drop("event_id")
    bronze.write_bronze(docs, path)
    assert bronze.read_bronze(spark, path).count() == docs.count()
