"""Streams in many small batches: closed days, late rows, repeated batches."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from tidelines.operators.windows import add_features, lags, rolling
from tidelines.panel import Panel
from tidelines.streaming import panel_streams as ps

P = Panel("stationID", "t", ("id",))
SCHEMA = "id long, stationID string, t timestamp, x double"


def _rows(spark, hours):
    rows = [(k, s, h * 3600, float((k * 37) % 101)) for k, (s, h) in enumerate(hours)]
    return spark.createDataFrame(rows, "id long, stationID string, s long, x double").select("id", "stationID", F.timestamp_seconds("s").alias("t"), "x")


def _arrive(df, path):
    df.coalesce(1).write.mode("append").parquet(path)


def _files(path):
    return sum(len([f for f in names if f.endswith(".parquet")]) for _, _, names in os.walk(path))


def test_days_are_closed_once_and_files_follow_the_days(spark, tmp_path):
    at = lambda name: str(tmp_path / name)
    all_rows = _rows(spark, [(s, 6 * k) for k in range(48) for s in "ab"])
    for part in range(24):  # two batches a day, twelve days
        _arrive(all_rows.filter(F.col("id").between(part * 4, part * 4 + 3)), at("in"))
    days = ps.daily_means(ps.read_stream(spark, at("in"), all_rows.schema, files_per_trigger=1), P, ["x"])
    ps.keep_days(days, at("days"), at("check"), ["date", "stationID"]).awaitTermination()
    got = ps.read_days(spark, at("days"))
    want = all_rows.groupBy(F.to_date("t").alias("date"), "stationID").agg(F.count(F.lit(1)).alias("rows"), F.avg("x").alias("x_mean"))
    key = ["date", "stationID", "rows", "x_mean"]
    assert sorted(map(tuple, got.select(key).collect())) == sorted(map(tuple, want.select(key).collect()))
    assert got.filter("closed").select("date").distinct().count() == 9
    # After 24 batches and one for the watermark: two batches of open days, and one folder for each closed day.
    assert len(os.listdir(at("days/open"))) == 2 and len([f for f in os.listdir(at("days/closed"))]) == 9
    assert _files(at("days")) <= 4 * (9 + 2)  # four partitions


def test_a_batch_that_is_repeated_leaves_nothing_twice(spark, tmp_path):
    at = lambda name: str(tmp_path / name)
    rows = _rows(spark, [("a", 12 * k) for k in range(20)])
    for part in range(4):
        _arrive(rows.filter(F.col("id").between(part * 5, part * 5 + 4)), at("in"))
        stream = ps.read_stream(spark, at("in"), rows.schema)
        ps.keep_days(ps.daily_means(stream, P, ["x"]), at("days"), at("check"), ["date", "stationID"]).awaitTermination()
        ps.incremental_features(ps.read_stream(spark, at("in"), rows.schema), P, [lags(["x"], [1])], at("f"), at("check2"), at("h"), late_rows=0).awaitTermination()
        if part == 2:  # the last batch is not noted as done: it runs again
            for check in ("check", "check2"):
                commits = [c for c in os.listdir(at(f"{check}/commits")) if c.isdigit()]
                last = max(commits, key=int)
                for name in (last, f".{last}.crc"):
                    os.remove(at(f"{check}/commits/{name}"))
    assert ps.read_days(spark, at("days")).agg(F.sum("rows")).first()[0] == 20
    final = ps.latest_updates(spark, at("f"), ["stationID", "t", "id"])
    assert {(r.id, r.x_lag_1h) for r in final.collect()} == {(r.id, r.x_lag_1h) for r in add_features(rows, P, lags(["x"], [1])).collect()}


@pytest.mark.parametrize("late_rows", [0, 3, 1000])
def test_features_of_rows_in_any_order(spark, tmp_path, late_rows):
    at = lambda name: str(tmp_path / name)
    hours = [("a", h) for h in range(60)] + [("b", h // 3) for h in range(30)] + [(None, h) for h in range(9)] + [("late", 0)]
    rows = _rows(spark, hours)
    order = list(range(len(hours)))
    random.Random(3).shuffle(order)
    order.remove(0)
    order.append(0)  # the very first row comes last
    for part in range(6):
        _arrive(rows.filter(F.col("id").isin(order[part::6] if part < 5 else [*order[5::6], order[4]])), at("in"))  # one row is sent twice
    features = [lags(["x"], [1, 4]), rolling(["x"], [3], ["mean", "max"])]
    ps.incremental_features(ps.read_stream(spark, at("in"), rows.schema, files_per_trigger=1), P, features, at("f"), at("check"), at("h"), late_rows).awaitTermination()
    final = ps.latest_updates(spark, at("f"), ["stationID", "t", "id"])
    names = ["id", "x_lag_1h", "x_lag_4h", "x_rolling_mean_3h", "x_rolling_max_3h"]
    want = add_features(rows, P, *features).select(names).collect()
    got = final.select(names).collect()
    assert len(got) == len(want)
    plain = lambda rows_: sorted(tuple(None if v is None else round(v, 9) for v in r) for r in rows_)
    assert sorted(plain(got), key=repr) == sorted(plain(want), key=repr)
    ring = spark.read.parquet(at("h/ring")).filter("batch = 5").groupBy("stationID").count()
    assert ring.agg(F.max("count")).first()[0] <= 4 + late_rows


def test_features_with_large_entities_null_times_and_ties(spark, tmp_path):
    """Entities above the limit are cut into slices; a late row without a time, and one that shares its time, are early."""
    at = lambda name: str(tmp_path / name)
    rows = _rows(spark, [("a", h // 2) for h in range(60)] + [("b", h) for h in range(9)])
    rows = rows.withColumn("t", F.when(~F.col("id").isin(20, 68), F.col("t")))
    for ids in (range(24, 66), [*range(24), 66], [67, 68]):
        _arrive(rows.filter(F.col("id").isin(*ids)), at("in"))
    features = [lags(["x"], [1, 2])]
    stream = ps.read_stream(spark, at("in"), rows.schema, files_per_trigger=1)
    ps.incremental_features(stream, P, features, at("f"), at("check"), at("h"), 2, max_rows=20).awaitTermination()
    names = ["id", "x_lag_1h", "x_lag_2h"]
    got = ps.latest_updates(spark, at("f"), ["stationID", "t", "id"]).select(names)
    want = add_features(rows, P, *features).select(names)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_batches_of_the_query_are_read_by_several_tasks(spark, tmp_path, monkeypatch, sf_dir):
    from tidelines.catalog import file_queries

    monkeypatch.setattr(file_queries, "scratch_dir", lambda spark, purpose: str(tmp_path / purpose))
    source = str(tmp_path / "source")
    spark.read.parquet(f"{sf_dir}/events.parquet").repartition(3).write.parquet(f"{source}/events.parquet")
    assert file_queries.stream_features(spark, source).count() == spark.read.parquet(f"{source}/events.parquet").count()
    rows = tmp_path / "stream-features/history/rows"
    assert len(list(rows.glob("batch=*"))) == 5
    assert min(_files(folder) for folder in rows.glob("batch=*")) > 1


def test_features_that_look_ahead_are_refused(spark):
    from tidelines.operators.windows import leads

    with pytest.raises(ValueError):
        ps.incremental_features(None, P, [leads(["x"], [1])], "a", "b", "c")
