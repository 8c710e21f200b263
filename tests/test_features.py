"""Hand-computed cases for windows, interpolation, clipping, calendar and wind."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from tests.conftest import column
from tidelines.functions.calendar import add_combined_calendar, add_daily_calendar, add_hourly_calendar
from tidelines.functions.geo import bearing_deg, haversine_km
from tidelines.functions.wind import add_wind_vectors, wind_direction, wind_speed
from tidelines.operators.aggregate import daily_weather
from tidelines.operators.clean import clip, drop_null_rows
from tidelines.operators.evaluate import seasonal_metrics
from tidelines.operators.interpolate import interpolate
from tidelines.operators.windows import (
    add_features,
    differences,
    lags,
    leads,
    percent_change,
    rolling,
    sequences,
    time_gaps,
)
from tidelines.panel import Panel

P = Panel("stationID", "timestamp_utc")


def test_lag_and_lead(series):
    out = add_features(series([1, None, 3, 4]), P, lags(["x"], [1, 2]), leads(["x"], [1]))
    assert column(out, "x_lag_1h") == [None, 1, None, 3]
    assert column(out, "x_lag_2h") == [None, None, 1, None]
    assert column(out, "target_x_1h") == [None, 3, 4, None]


def test_rolling_needs_full_window(series):
    out = add_features(series([1, 2, 3, None, 5, 6, 7]), P, rolling(["x"], [3]))
    assert column(out, "x_rolling_mean_3h") == [None, None, 2, None, None, None, 6]
    assert column(out, "x_rolling_std_3h") == [None, None, 1, None, None, None, 1]
    assert column(out, "x_rolling_min_3h") == [None, None, 1, None, None, None, 5]
    assert column(out, "x_rolling_max_3h") == [None, None, 3, None, None, None, 7]


@pytest.mark.parametrize("windows", [[1, 2], [5], [3, 7, 14], [24], [3, 6, 12, 24], [50]])
def test_rolling_blocks_match_pandas(series, windows):
    import random

    rng = random.Random(5)
    values = [None if rng.random() < 0.03 else rng.uniform(-1e3, 1e3) for _ in range(120)]
    out = add_features(series(values), P, rolling(["x"], windows)).orderBy("i").toPandas()
    for n in windows:
        for stat in ("mean", "std", "min", "max"):
            want = getattr(out["x"].astype("float64").rolling(n), stat)()
            got = out[f"x_rolling_{stat}_{n}h"].astype("float64")
            assert got.isna().tolist() == want.isna().tolist()
            assert got.dropna().tolist() == pytest.approx(want.dropna().tolist(), rel=1e-9, abs=1e-9)


def test_rolling_std_of_a_constant_is_zero(series):
    out = add_features(series([1e9 + 0.1] * 30), P, rolling(["x"], [24], ["std"]))
    assert column(out, "x_rolling_std_24h")[-1] == pytest.approx(0, abs=1e-6)
    with pytest.raises(ValueError):
        rolling(["x"], [3], ["median"])


def test_percent_change_of_zero(series):
    df = series([0, 5, 10, 10])
    assert column(add_features(df, P, percent_change("x")), "x_pct_change_1h") == [None, None, 100, 0]
    ieee = column(add_features(df, P, percent_change("x", zero_div="ieee")), "x_pct_change_1h")
    assert ieee[:3] == [None, math.inf, 100]
    signed = column(add_features(series([0, 0, -1]), P, percent_change("x", zero_div="ieee")), "x_pct_change_1h")
    assert math.isnan(signed[1]) and signed[2] == -math.inf
    with pytest.raises(ValueError):
        percent_change("x", zero_div="raise")


def test_difference(series):
    assert column(add_features(series([1, 4, 9]), P, differences("x", [1])), "x_diff_1h") == [None, 3, 5]


def test_sequences(series):
    out = add_features(series([1, 2, 3]), P, sequences(["x", "i"], 2))
    assert [None if s is None else [(v.x, v.i) for v in s] for s in column(out, "sequence")] == [
        None,
        [(1, 0), (2, 1)],
        [(2, 1), (3, 2)],
    ]


def test_windows_do_not_cross_stations(series):
    both = series([1, 2]).unionByName(series([7, 8], "b"))
    out = add_features(both, P, lags(["x"], [1]))
    got = {(r.stationID, r.i): r.x_lag_1h for r in out.collect()}
    assert got == {("a", 0): None, ("a", 1): 1, ("b", 0): None, ("b", 1): 7}


def test_time_gaps(series):
    df = series([1, 2, 3, 4]).filter("i <> 2")
    assert [(r.i, r.step_seconds) for r in time_gaps(df, P).collect()] == [(3, 7200.0)]


@pytest.mark.parametrize(
    ("max_gap", "want"),
    [(None, [None, 1, 2, 3, 4, None]), (1, [None, 1, None, None, 4, None]), (2, [None, 1, 2, 3, 4, None])],
)
def test_interpolation(series, max_gap, want):
    df = series([None, 1, None, None, 4, None])
    assert column(interpolate(df, P, ["x", "absent"], max_gap=max_gap), "x") == want


def test_interpolation_nearest(series):
    df = series([0, None, None, None, 8])
    assert column(interpolate(df, P, ["x"], method="nearest"), "x") == [0, 0, 8, 8, 8]
    with pytest.raises(ValueError):
        interpolate(df, P, ["x"], method="cubic")


def test_clip_keeps_null(series):
    assert column(clip(series([None, -1, 5, 99]), {"x": (0, 10)}), "x") == [None, 0, 5, 10]


def test_drop_null_rows_keeps_nan(series):
    assert len(column(drop_null_rows(series([1, None, float("nan")])), "x")) == 2


def test_iso_weekday_and_weekend(spark):
    friday = spark.sql("SELECT timestamp'2023-01-06 10:00:00' AS timestamp_utc")
    row = add_hourly_calendar(friday).first()
    assert (row.day_of_week, row.is_weekend) == (5, True)
    assert add_hourly_calendar(friday, weekend_from=6).first().is_weekend is False
    combined = add_combined_calendar(friday).first()
    assert (combined.is_weekday, combined.is_daytime, combined.day_of_year) == (False, True, 6)
    assert add_daily_calendar(friday, "timestamp_utc").first().month_sin == pytest.approx(0.5)


def test_wind(spark):
    df = spark.sql("SELECT 10D AS s, 90D AS d")
    row = add_wind_vectors(df, "s", "d", "u", "v").first()
    assert row.u == pytest.approx(-10) and row.v == pytest.approx(0, abs=1e-9)
    back = add_wind_vectors(df, "s", "d", "u", "v").select(
        wind_speed(F.col("u"), F.col("v")).alias("s"), wind_direction(F.col("u"), F.col("v")).alias("d")
    )
    assert tuple(back.first()) == pytest.approx((10, 90))


def test_daily_weather_edges(spark):
    rows = spark.sql(
        """SELECT 'a' AS stationID, timestamp'2024-01-01 20:00:00' AS timestamp_utc, 1D AS lat, 2D AS lon, 3D AS temp_c,
        50D AS humidity_pct, 1000D AS pressure_hpa, CAST(NULL AS DOUBLE) AS precipitation_mm, 5D AS wind_ms,
        350D AS wind_dir_deg, 0D AS shortwave_radiation_wm2, 0D AS cloud_cover_pct, 'l' AS load_id
        UNION ALL SELECT 'a', timestamp'2024-01-01 21:00:00', 9D, 9D, 5D, 50D, 1000D, NULL, 5D, 10D, 0D, 0D, 'm'"""
    )
    row = daily_weather(rows).first()
    assert (row.precip_sum, row.lat, row.load_id, row.temp_2m_mean) == (0.0, 1.0, "l", 4.0)
    assert row.wind_direction_mean == 180.0
    vector = daily_weather(rows, wind_mean="vector").first().wind_direction_mean
    assert min(vector, 360 - vector) == pytest.approx(0, abs=1e-6)
    shifted = daily_weather(rows, shift_hours=3.5).orderBy("date").collect()
    assert [str(r.date) for r in shifted] == ["2024-01-01", "2024-01-02"]


def test_distance_and_bearing(spark):
    lit = F.lit
    row = spark.range(1).select(
        haversine_km(lit(0.0), lit(0.0), lit(1.0), lit(0.0)).alias("north_km"),
        bearing_deg(lit(0.0), lit(0.0), lit(0.0), lit(1.0)).alias("east"),
        bearing_deg(lit(1.0), lit(0.0), lit(0.0), lit(0.0)).alias("south"),
    ).first()
    assert tuple(row) == pytest.approx((111.1949, 90.0, 180.0), abs=1e-3)


def test_seasonal_metrics(spark):
    df = spark.sql(
        """SELECT 'm' AS model, 1 AS horizon, d AS at, 1D AS actual, p AS predicted FROM VALUES
        (date'2024-01-05', 2D), (date'2024-12-05', 4D), (date'2024-07-05', 1D) AS t(d, p)"""
    )
    got = {r.season: (r.n, r.mae, r.bias) for r in seasonal_metrics(df, "at").collect()}
    assert got == {"DJF": (2, 2.0, 2.0), "JJA": (1, 0.0, 0.0)}


@pytest.fixture
def calm(spark, tmp_path):
    """Still air from every direction, each event a station of its own, and the rows that SQL gives."""
    import duckdb

    from __spark_entry__ import oracle_sql, queries

    spark.range(360).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-01 10:00:00' AS ts", "id AS user_id", "'view' AS event_type", "0D AS value", "'' AS props"
    ).write.parquet(f"{tmp_path}/events.parquet")

    def both(name):
        con = duckdb.connect()
        con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
        got = queries()[name](spark, str(tmp_path))
        names = ", ".join(got.columns)
        want = con.execute(f"SELECT {names} FROM ({oracle_sql()[name]})").fetchall()
        return sorted(tuple(r) for r in got.collect()), sorted(want)

    return both


def test_direction_of_calm_air(calm):
    got, want = calm("wind_recompose")
    assert got == want and {r[2] for r in got} == {0.0, 180.0}


def test_mean_direction_of_calm_days(calm):
    got, want = calm("vector_mean_wind")
    assert got == want and {r[2] for r in got} == {180.0}
