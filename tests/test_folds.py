"""Fold statistics, coverage intervals, and ranks with hot keys."""

from __future__ import annotations

import math
import statistics

import pytest
from pyspark.sql import functions as F

from tidelines.operators.quality import coverage_intervals
from tidelines.operators.rank import ordinal_rank, position_slice
from tidelines.operators.splits import fold_normalised, fold_statistics, fold_tests, walk_forward_folds
from tidelines.panel import SLICE, Panel


def _panel(spark, days, values):
    df = spark.createDataFrame(list(zip(range(len(days)), days, values)), "id long, d int, x double")
    return df.withColumn("t", F.when(F.col("d").isNotNull(), F.date_add(F.lit("2024-01-01").cast("date"), F.col("d"))))


@pytest.mark.parametrize("shift", [0.0, 1e9])
def test_fold_statistics_are_those_of_each_training_set(spark, shift):
    days = [-5, 0, 0, 1, 2, 2, 9, 10, 11, 30, None, 4]
    values = [1.0, 2.5, None, 4.0, float("nan"), 7.0, 0.5, 3.0, float("inf"), 100.0, 5.0, -2.0]
    values = [v if v is None else v + shift for v in values]
    got = {(r.fold, r.feature): r for r in fold_statistics(_panel(spark, days, values), "t", "2024-01-01", 3, 5, ["x", "d"]).collect()}
    assert len(got) == 10
    for fold in range(5):
        train = [v for d, v in zip(days, values) if d is not None and d < (fold + 1) * 3 and v is not None and math.isfinite(v)]
        r = got[fold, "x"]
        assert (r.n, r.min, r.max) == (len(train), min(train), max(train))
        assert r.mean == pytest.approx(statistics.mean(train), rel=1e-14)
        assert r.std == pytest.approx(statistics.stdev(train), rel=1e-6)


def test_folds_without_rows_have_nulls(spark):
    got = fold_statistics(_panel(spark, [4, 4], [1.0, 1.0]), "t", "2024-01-01", 2, 4, ["x"]).orderBy("fold").collect()
    assert [(r.n, r.mean, r.std) for r in got] == [(0, None, None), (0, None, None), (2, 1.0, 0.0), (2, 1.0, 0.0)]
    empty = fold_statistics(_panel(spark, [4], [1.0]).limit(0), "t", "2024-01-01", 2, 3, ["x"]).collect()
    assert [(r.n, r.mean) for r in empty] == [(0, None)] * 3


def test_fold_tests_are_the_test_rows_of_all_folds(spark):
    df = _panel(spark, [*range(-3, 40), None], [1.0] * 44)
    for step, folds, horizon in ((7, 3, 5), (2, 6, 9), (1, 500, 3)):
        where = ("t", "2024-01-01", step, folds, horizon)
        all_folds = walk_forward_folds(df, *where)
        rows = lambda d: sorted((r.id, r.fold) for r in d.select("id", "fold").collect())
        assert rows(fold_tests(df, *where)) == rows(all_folds.filter("role = 'test'"))
        want = [(i, f, "train" if d < (f + 1) * step else "test") for i, d in enumerate(range(-3, 40)) for f in range(folds) if d < (f + 1) * step + horizon]
        assert sorted((r.id, r.fold, r.role) for r in all_folds.collect()) == sorted(want)


def test_each_fold_has_its_own_scale(spark):
    df = _panel(spark, list(range(8)), [0.0, 2.0, 4.0, 6.0, 1.0, 1.0, 1.0, 1.0])
    where = ("t", "2024-01-01", 2, 3)
    scaled = fold_normalised(fold_tests(df, *where, 2), fold_statistics(df, *where, ["x"]), ["x"])
    got = {(r.fold, r.id): r.x_norm for r in scaled.collect()}
    assert got[0, 2] == pytest.approx((4 - 1) / math.sqrt(2)) and got[1, 4] == pytest.approx((1 - 3) / statistics.stdev([0, 2, 4, 6]))
    assert fold_normalised(fold_tests(df, *where, 2), fold_statistics(df.withColumn("x", F.lit(1.0)), *where, ["x"]), ["x"]).filter("x_norm IS NOT NULL").count() == 0


@pytest.mark.parametrize("unit", ["hour", "day", "month"])
def test_coverage_intervals(spark, unit):
    hours = {"a": [0, 1, 2, 2, 4, 5, 47, 48, 49, 800], "b": [7], None: [1, 3], "c": []}
    rows = [(s, h * 3600) for s, hs in hours.items() for h in hs] + [("c", None)]
    df = spark.createDataFrame(rows, "stationID string, s long").withColumn("t", F.timestamp_seconds("s"))
    got = coverage_intervals(df, "stationID", "t", "1 hour", unit)
    back = {(r.stationID, r.a // 3600, r.b // 3600, r.rows, r.times, r.gap_seconds) for r in got.select("*", F.unix_seconds("started").alias("a"), F.unix_seconds("ended").alias("b")).collect()}
    assert back == {
        ("a", 0, 2, 4, 3, 7200.0), ("a", 4, 5, 2, 2, 42 * 3600.0), ("a", 47, 49, 3, 3, 751 * 3600.0), ("a", 800, 800, 1, 1, None),
        ("b", 7, 7, 1, 1, None), (None, 1, 1, 1, 1, 7200.0), (None, 3, 3, 1, 1, None),
    }


def test_ranks_of_equal_keys_are_spread_over_tasks(spark):
    df = spark.range(40_000).select("id", F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id")).alias("k")).withColumn("t", F.timestamp_seconds("k"))
    got = ordinal_rank(df, "t", [], "rank").collect()
    assert sorted(r["rank"] for r in got) == list(range(1, 40_001))
    byrank = [r.k for r in sorted(got, key=lambda r: r["rank"])]
    assert byrank == sorted(byrank)
    assert ordinal_rank(df.limit(0), "t", []).count() == 0
    assert position_slice(df, "t", ["id"], 39_990, 50_000).count() == 10


def test_borders_are_found_by_halving(spark):
    df = spark.range(5000).select(F.lit("a").alias("stationID"), F.timestamp_seconds(F.col("id") % 1000).alias("t"), "id")
    fitted = Panel("stationID", "t", ("id",)).fit(df, max_rows=20)
    borders = fitted.slices.table.first()["_borders"]
    assert len(borders) > 200 and fitted.slices.steps == len(borders).bit_length()
    for r in fitted.slices.attach(df).sample(0.1, 1).select(F.unix_micros("t").alias("m"), "id", SLICE).collect():
        assert r[SLICE] == sum((b["time"], b["tie0"]) <= (r.m, r.id) for b in borders)
