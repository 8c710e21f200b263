"""One station holds more than a third of all rows: sliced results must equal the plain ones."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidelines.operators import rank as rank_module
import tidelines.operators.aggregate as aggregate_module
from tidelines.operators.aggregate import exact_quantiles, global_quantiles
from tidelines.operators.clean import latest_per_key
from tidelines.operators.interpolate import interpolate
from tidelines.operators.rank import ordinal_rank, position_slice, rows_at_ranks
from tidelines.operators.splits import chronological_split
from tidelines.operators.windows import add_features, lags, leads, percent_change, rolling
from tidelines.panel import SLICE, Panel
from tidelines.session import staged

P = Panel("stationID", "timestamp_utc", ("id",))


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        station = "hot" if rng.random() < 0.4 else (None if rng.random() < 0.05 else f"s{rng.randrange(40)}")
        # Half of the rows fall in a short burst, and many times are equal.
        seconds = rng.randrange(200) if rng.random() < 0.5 else rng.randrange(500_000)
        x = None if rng.random() < 0.3 else round(rng.uniform(-50, 50), 2)
        y = None if rng.random() < 0.97 else float(i)
        rows.append((i, station, seconds, x, y))
    df = spark.createDataFrame(rows, "id long, stationID string, s long, x double, y double")
    return df.withColumn("timestamp_utc", F.timestamp_seconds(F.col("s") + 1_700_000_000)).cache()


@pytest.fixture(scope="module")
def fitted(skewed):
    panel = P.fit(skewed, max_rows=150)
    assert panel.slices is not None
    return panel


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_only_the_large_station_is_sliced(skewed, fitted):
    sliced = fitted.slices.attach(skewed)
    per = {r.stationID: r.n for r in sliced.groupBy("stationID").agg(F.countDistinct(SLICE).alias("n")).collect()}
    assert per.pop("hot") > 4
    assert set(per.values()) == {1}
    assert sliced.filter(F.col("stationID") == "hot").groupBy(SLICE).count().agg(F.max("count")).first()[0] < 1000


def test_small_panel_is_not_sliced(skewed):
    assert P.fit(skewed).slices is None


def test_features(skewed, fitted):
    features = [lags(["x"], [1, 24]), rolling(["x"], [3, 24]), leads(["x"], [5]), percent_change("x")]
    plain, sliced = (add_features(skewed, p, *features) for p in (P, fitted))
    assert rows(plain) == rows(sliced.select(*plain.columns))


def test_both_branches_read_one_exchange(spark, fitted, skewed):
    stored = staged(skewed, "skew-test")
    for df in (add_features(stored, fitted, lags(["x"], [1])), interpolate(stored, fitted, ["x"])):
        df.collect()
        final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert "ReusedExchange" in final


@pytest.mark.parametrize("max_gap", [None, 2])
def test_interpolation(skewed, fitted, max_gap):
    # ``y`` is known in 3 of 100 rows, so most gaps cross slice borders.
    plain, sliced = (interpolate(skewed, p, ["x", "y"], max_gap=max_gap) for p in (P, fitted))
    got, want = rows(sliced), rows(plain)
    assert [r[:3] for r in got] == [r[:3] for r in want]
    for a, b in zip(got, want):
        assert a[3:5] == pytest.approx(b[3:5], nan_ok=True) if None not in a + b else (a[3] is None) == (b[3] is None)


def test_ordinal_rank(skewed):
    got = {r.id: r["rank"] for r in ordinal_rank(skewed, "timestamp_utc", ["id"]).collect()}
    order = sorted(skewed.collect(), key=lambda r: (r.s, r.id))
    assert got == {r.id: i + 1 for i, r in enumerate(order)}
    some = position_slice(skewed, "timestamp_utc", ["id"], 10, 20)
    assert sorted(r.id for r in some.collect()) == sorted(r.id for r in order[10:20])


@pytest.mark.parametrize("finish", [5, 100_000])
@pytest.mark.parametrize("keys", [["timestamp_utc", "stationID", "id"], ["stationID", "id"], ["s", "id"]])
def test_rows_at_ranks(skewed, monkeypatch, finish, keys):
    monkeypatch.setattr(rank_module, "_FINISH", finish)
    known = skewed.filter(F.col("stationID").isNotNull())
    order = sorted(known.collect(), key=lambda r: tuple(r[k] for k in keys))
    total, got = rows_at_ranks(known, keys, lambda n: [0, n // 3, n // 3 + 1, n, n + 1])
    assert total == len(order) and got[0] is None and got[4] is None
    for found, rank in zip(got[1:], [total // 3, total // 3 + 1, total]):
        want = order[rank - 1]
        assert tuple(found[k] for k in keys) == tuple(want[k] for k in keys)


@pytest.mark.parametrize("finish", [5, 100_000])
def test_split_sizes(skewed, monkeypatch, finish):
    monkeypatch.setattr(rank_module, "_FINISH", finish)
    split = chronological_split(skewed.na.drop(subset=["stationID"]), ["timestamp_utc", "stationID", "id"])
    sizes = {r.split: r["count"] for r in split.groupBy("split").count().collect()}
    n = sum(sizes.values())
    assert sizes["train"] == int(n * 0.7) and sizes["val"] == int(n * (0.7 + 0.15)) - int(n * 0.7)
    bounds = {r.split: (r.lo, r.hi) for r in split.groupBy("split").agg(F.min("s").alias("lo"), F.max("s").alias("hi")).collect()}
    assert bounds["train"][1] <= bounds["val"][0] and bounds["val"][1] <= bounds["test"][0]


def test_whole_dates_and_bad_ratios(skewed):
    daily = skewed.withColumn("date", F.to_date("timestamp_utc")).na.drop(subset=["stationID"])
    split = chronological_split(daily, ["date", "stationID", "id"], whole_dates=True)
    assert split.groupBy("date").agg(F.countDistinct("split").alias("n")).agg(F.max("n")).first()[0] == 1
    with pytest.raises(ValueError):
        chronological_split(daily, ["date"], 0.7, 0.2, 0.2)


def test_published_split_sizes(spark):
    n = 218_971
    df = spark.range(n).select(F.date_add(F.lit("2018-01-01").cast("date"), (F.col("id") % 2830).cast("int")).alias("date"), F.col("id"))
    sizes = {r.split: r["count"] for r in chronological_split(df, ["date", "id"]).groupBy("split").count().collect()}
    assert sizes == {"train": 153_279, "val": 32_846, "test": 32_846}


def test_exact_quantiles(skewed):
    import numpy as np

    got = {(r.stationID, r.prob): r.value for r in exact_quantiles(skewed, "x", [0.0, 0.5, 0.95], ["stationID"]).collect()}
    groups: dict = {}
    for r in skewed.collect():
        if r.x is not None:
            groups.setdefault(r.stationID, []).append(r.x)
    assert len(got) == 3 * len(groups)
    for (station, prob), value in got.items():
        assert value == pytest.approx(np.quantile(groups[station], prob))


@pytest.mark.parametrize("most", [1, 40])
def test_quantiles_of_heavy_tails(spark, monkeypatch, most):
    """Far outliers leave all other values to one cell of equal width, and one value may be half of a group."""
    import numpy as np

    monkeypatch.setattr(aggregate_module, "MAX_ORDERED", most)
    monkeypatch.setattr(aggregate_module, "SKETCH_CELLS", 8)
    rng = np.random.default_rng(3)
    tail = np.concatenate([np.exp(rng.normal(0, 30, 1500)), -np.exp(rng.normal(0, 30, 1500)), [1e300, -1e300], np.full(1000, 0.25)])
    plain = rng.normal(0, 1, 1000)
    odd = np.concatenate([plain, [np.inf, -np.inf]])
    rows = [(g, float(v)) for g, vs in (("tail", tail), ("plain", plain), ("odd", odd), (None, plain[:3])) for v in vs]
    df = spark.createDataFrame(rows, "g string, x double").repartition(4)
    probs = [0.0, 0.1, 0.5, 0.6, 0.999]
    got = {(r.g, r.prob): r.value for r in exact_quantiles(df, "x", probs, ["g"]).collect()}
    assert len(got) == 4 * len(probs)
    for (g, p), value in got.items():
        if g == "odd" and p == 0.0:
            continue  # between minus infinity and a number lies no number
        data = {"tail": tail, "plain": plain, "odd": odd, None: plain[:3]}[g]
        assert value == pytest.approx(np.quantile(data, p), rel=1e-12)


def test_quantiles_of_one_repeated_value(spark):
    df = spark.range(100).select(F.lit(4.0).alias("x"), F.lit("a").alias("g"))
    assert [r.value for r in exact_quantiles(df, "x", [0.1, 0.9], ["g"]).collect()] == [4.0, 4.0]
    assert [r.value for r in global_quantiles(df, "x", [0.1, 0.9]).collect()] == [4.0, 4.0]
    assert [r.value for r in global_quantiles(df.filter("x < 0"), "x", [0.5]).collect()] == [None]


@pytest.mark.parametrize("finish", [5, 100_000])
def test_global_quantiles(skewed, monkeypatch, finish):
    import numpy as np

    monkeypatch.setattr(rank_module, "_FINISH", finish)
    values = [r.x for r in skewed.collect() if r.x is not None]
    for r in global_quantiles(skewed, "x", [0.0, 0.31, 0.5, 1.0]).collect():
        assert r.value == pytest.approx(np.quantile(values, r.prob))


def test_copies_are_limited_before_the_shuffle(skewed, capsys):
    latest_per_key(skewed, ["stationID"], [F.col("timestamp_utc").desc(), F.col("id")]).explain()
    plan = capsys.readouterr().out
    assert "Partial" in plan.split("Exchange")[1] and "WindowGroupLimit" in plan
