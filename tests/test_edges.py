"""Null times, stray dates, shared times, values without a place on a scale, and plans from numbered files."""

from __future__ import annotations

import gzip
import json

import pytest
from pyspark.sql import functions as F

from tidelines.operators import rank as rank_module
from tidelines.operators.aggregate import global_quantiles
from tidelines.operators.normalise import fit
from tidelines.operators.rank import ordinal_rank
from tidelines.operators.splits import chronological_split
from tidelines.operators.windows import add_features, lags, rolling
from tidelines.panel import SLICE, Panel
from tidelines.plans.config import HourlyConfig
from tidelines.plans.gold_jobs import hourly_features
from tidelines.plans.silver_jobs import backfill_plan, done_periods, run_weather_to_silver
from tidelines.session import scratch_dir

P = Panel("stationID", "t", ("id",))
LIMIT = 200


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def odd_times(spark, kind):
    times = {
        "null": lambda i: None if i % 97 == 0 else i * 3600,
        "stray": lambda i: -62_000_000_000 if i == 0 else i * 3600,
        "shared": lambda i: 7200,
        "burst": lambda i: i * 3600 if i % 10 == 0 else 5,
    }[kind]
    df = spark.createDataFrame([(i, "a" if i % 4 else "b", times(i), float(i)) for i in range(4000)], "id long, stationID string, s long, x double")
    return df.withColumn("t", F.timestamp_seconds("s")).repartition(5)


@pytest.mark.parametrize("kind", ["null", "stray", "shared", "burst"])
def test_slices_change_nothing_and_stay_small(spark, kind):
    df = odd_times(spark, kind)
    fitted = P.fit(df, max_rows=LIMIT)
    sizes = fitted.slices.attach(df).groupBy("stationID", SLICE).count()
    assert sizes.agg(F.max("count")).first()[0] <= 2 * LIMIT
    features = [lags(["x"], [1, 24]), rolling(["x"], [24], ["mean"])]
    assert rows(add_features(df, P, *features)) == rows(add_features(df, fitted, *features))


@pytest.mark.parametrize("kind", ["null", "shared"])
def test_ranks_with_odd_times(spark, kind):
    df = odd_times(spark, kind)
    want = {r.id: k + 1 for k, r in enumerate(sorted(df.collect(), key=lambda r: (r.s is not None, r.s or 0, r.id)))}
    assert {r.id: r.rank for r in ordinal_rank(df, "t", ["id"]).collect()} == want


@pytest.mark.parametrize("odd", [float("nan"), float("inf"), float("-inf")])
def test_quantiles_end_with_odd_values(spark, monkeypatch, odd):
    monkeypatch.setattr(rank_module, "_FINISH", 50)
    values = [float(i % 500) for i in range(2000)] + [odd] * 3 + [1e308, -1e308, 5e-324]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = {r.prob: r.value for r in global_quantiles(df, "x", [0.25, 0.5, 0.75]).collect()}
    order = sorted(values, key=lambda v: (v != v, v if v == v else 0))
    for p, v in got.items():
        at = p * (len(order) - 1)
        low, high = order[int(at)], order[min(len(order) - 1, int(at) + 1)]
        assert low <= v <= high


def test_split_with_null_ties(spark, monkeypatch):
    df = spark.createDataFrame([(i, None if i % 3 else f"k{i:04d}") for i in range(600)], "i long, tie string")
    df = df.withColumn("t", F.timestamp_seconds((F.col("i") / 100).cast("long")))
    plain = rows(chronological_split(df, ["t", "tie", "i"]))
    monkeypatch.setattr(rank_module, "_FINISH", 20)
    assert rows(chronological_split(df, ["t", "tie", "i"])) == plain
    counts = {s: sum(r[-1] == s for r in plain) for s in ("train", "val", "test")}
    assert counts == {"train": 420, "val": 90, "test": 90}


def test_statistics_leave_infinity_out(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (float("inf"),), (float("nan"),)], "x double")
    assert fit(df, ["x"])[0].p1 == 2.0


def test_hourly_rows_after_zero_and_missing_share(spark):
    names = ["pm10_ugm3", "nitrogen_dioxide_ugm3", "ozone_ugm3", "sulphur_dioxide_ugm3", "carbon_monoxide_ugm3"]
    data = [(s, i, None if s == "gappy" and i % 3 == 0 else float(i % 5), f"{s}{i:03d}") for s in ("full", "gappy") for i in range(90)]
    df = spark.createDataFrame(data, "stationID string, i long, pm2_5_ugm3 double, record_hash string")
    df = df.withColumns({"timestamp_utc": F.timestamp_seconds(F.col("i") * 3600), **{c: F.lit(1.0) for c in names}}).drop("i")
    config = HourlyConfig(rolling_windows=(3,), horizon=1)
    whole = hourly_features(df, config)
    after_zero = whole.filter("stationID = 'full' AND pm2_5_ugm3_lag_1h = 0")
    assert after_zero.count() == 13 and after_zero.filter(F.abs("pm2_5_ugm3_pct_change_1h") == float("inf")).count() == 13
    strict = hourly_features(df, HourlyConfig(rolling_windows=(3,), horizon=1, max_missing_ratio=0.1))
    assert {r.stationID for r in strict.collect()} == {"full"} and {r.stationID for r in whole.collect()} == {"full", "gappy"}


def test_cluster_needs_a_shared_folder():
    class Stub:
        class conf:
            get = staticmethod(lambda *_: None)

        class sparkContext:
            master = "spark://somewhere:7077"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(Stub, "x")


def test_plan_and_load_of_numbered_weather_files(spark, tmp_path):
    hours = [f"2024-01-01T{h:02d}:00" for h in range(3)]
    document = {"latitude": 1.0, "longitude": 2.0, "hourly": {"time": hours, "temperature_2m": [1.0, 2.0, 3.0], "wind_u_component_10m": [3.6] * 3, "wind_v_component_10m": [7.2] * 3}}
    (tmp_path / "b").mkdir()
    with gzip.open(tmp_path / "b" / "batch_20240101_0002.json.gz", "wt") as f:
        json.dump(document, f)
    numbers = spark.createDataFrame([(1, "x"), (2, "y")], "number int, stationID string")
    done = done_periods(spark, str(tmp_path / "b"), numbers)
    stations = spark.createDataFrame([("x",), ("y",)], "stationID string")
    plan = {(r.stationID, str(r.start), str(r.end)) for r in backfill_plan(stations, done, "2024-01-01", "2024-05-15").collect()}
    assert plan == {("x", "2024-01-01", "2024-03-31"), ("x", "2024-04-01", "2024-05-15"), ("y", "2024-04-01", "2024-05-15")}
    load = {"data_source": "d", "load_id": "l", "ingested_at": "2024-02-01T00:00:00"}
    silver = run_weather_to_silver(spark, str(tmp_path / "b"), str(tmp_path / "s"), **load, numbered=numbers)
    got = silver.orderBy("timestamp_utc").collect()
    assert [(r.stationID, round(r.u10_ms, 3), round(r.v10_ms, 3)) for r in got] == [("y", 1.0, 2.0)] * 3


def test_hotspots_in_the_daily_table(spark, sf_dir):
    from tidelines.catalog.derived import TIES, hotspots, obs
    from tidelines.operators.aggregate import daily_weather
    from tidelines.operators.spatial import transboundary_index
    from tidelines.plans.config import DailyConfig
    from tidelines.plans.gold_jobs import HOTSPOT_COLUMNS, daily_features

    weather, config = obs(spark, sf_dir), DailyConfig(ties=TIES)
    first = hotspots(spark, sf_dir).agg(F.min("date")).first()[0]
    fires = hotspots(spark, sf_dir).filter(F.col("date") > F.lit(first))
    table = daily_features(weather, None, config, fires)
    got = {(r.stationID, r.date): tuple(r[c] for c in HOTSPOT_COLUMNS) for r in table.collect()}
    days = daily_weather(weather, ties=TIES)
    index = transboundary_index(fires, days.select("date", "stationID", "lat", "lon", "wind_direction_mean"))
    want = {(r.stationID, r.date): tuple(float(r[c]) for c in HOTSPOT_COLUMNS) for r in index.collect()}
    assert len(got) == days.count() and any(d == first for _, d in got)
    for key, values in got.items():
        assert values == pytest.approx(want.get(key, (0.0,) * 5))
    plain = daily_features(weather, None, config).agg(*[F.count(c).alias(c) for c in HOTSPOT_COLUMNS]).first()
    assert set(plain.asDict().values()) == {0}


def test_hotspots_against_every_pair(spark, monkeypatch):
    """Stations in and around the region, across the date line and at a pole; busy cells are dealt over tasks."""
    import math
    import random

    import tidelines.operators.spatial as spatial
    from tidelines.functions.geo import bearing_deg, haversine_km

    monkeypatch.setattr(spatial, "PLACES_PER_TASK", 3)
    rng = random.Random(5)
    fires = [(f"2024-01-0{1 + k % 2}", rng.uniform(12.5, 21.5), rng.uniform(96.5, 106.5), rng.uniform(0, 9), rng.choice(["th", "mm", "la", "xx"])) for k in range(400)]
    fires += fires[:50]
    places = [(rng.uniform(5, 30), rng.uniform(85, 118)) for _ in range(40)] + [(90.0, 0.0), (-15.0, -79.0), (20.9, -170.0), (None, 100.0)]
    stations = [(d, f"s{k}", lat, lon, rng.uniform(0, 360)) for k, (lat, lon) in enumerate(places) for d in ("2024-01-01", "2024-01-02", "2024-01-03")]
    f = spark.createDataFrame(fires, "date string, lat double, lon double, frp double, country string")
    s = spark.createDataFrame(stations, "date string, stationID string, lat double, lon double, wind_direction_mean double")
    for radius in (60.0, 800.0, 9000.0):
        got = {(r.stationID, r.date): r for r in spatial.transboundary_index(f, s, radius_km=radius).collect()}
        a, b = f.select("date", F.col("lat").alias("fa"), F.col("lon").alias("fo"), "frp", "country"), s.filter("lat IS NOT NULL")
        a = a.filter(F.col("fa").between(13, 21) & F.col("fo").between(97, 106))
        km = haversine_km(F.col("fa"), F.col("fo"), F.col("lat"), F.col("lon"))
        toward = bearing_deg(F.col("fa"), F.col("fo"), F.col("lat"), F.col("lon"))
        weight = F.greatest(F.lit(0.0), F.cos(F.radians(toward - F.col("wind_direction_mean") - 180))) * F.exp(-km / 200)
        want = a.join(b, "date").filter(km <= radius).groupBy("stationID", "date").agg(
            F.count_if(F.col("country") == "th").alias("th"), F.sum("frp").alias("frp"), F.sum(F.col("frp") * weight).alias("transport")
        ).collect()
        assert {(r.stationID, r.date) for r in want} == set(got) and (radius > 1000 or len(got) < len(stations))
        for r in want:
            g = got[r.stationID, r.date]
            assert g.hotspot_count_th == r.th and math.isclose(g.hotspot_frp_sum, r.frp, rel_tol=1e-9)
            assert math.isclose(g.transboundary_index, r.transport, rel_tol=1e-6, abs_tol=1e-9)


def test_hotspot_at_a_station(spark):
    """The same place but for the last digit of a latitude, which no difference of products can tell."""
    from tidelines.functions.geo import bearing_deg, haversine_km
    from tidelines.operators.spatial import transboundary_index

    places = [(13.640000000000001 + k * 0.01, 100.34 + k * 0.06) for k in (0, 6, 16)] + [(13.700000000000001, 100.7), (13.8, 100.8)]
    stations = spark.createDataFrame(
        [("2024-01-01", f"s{k}-{wind}", lat, lon, float(wind)) for k, (lat, lon) in enumerate(places) for wind in range(0, 360, 30)],
        "date string, stationID string, lat double, lon double, wind_direction_mean double",
    )
    fires = spark.createDataFrame(
        [("2024-01-01", round(lat, 2), round(lon, 2), 5.0, "th") for lat, lon in places], "date string, lat double, lon double, frp double, country string"
    )
    a = fires.select("date", F.col("lat").alias("fa"), F.col("lon").alias("fo"), "frp")
    ends = [F.col(c) for c in ("fa", "fo", "lat", "lon")]
    weight = F.greatest(F.lit(0.0), F.cos(F.radians(bearing_deg(*ends) - F.col("wind_direction_mean") - 180)))
    pairs = a.join(stations, "date").withColumn("km", haversine_km(*ends)).filter("km <= 0.1")
    want = {r.stationID: r.t for r in pairs.groupBy("stationID").agg(F.sum(F.col("frp") * weight * F.exp(-F.col("km") / 200)).alias("t")).collect()}
    got = {r.stationID: r.transboundary_index for r in transboundary_index(fires, stations, radius_km=0.1).collect()}
    assert set(got) == set(want) == {r.stationID for r in stations.collect()}
    assert all(got[k] == pytest.approx(want[k], abs=1e-6) for k in want)
