"""Chronological train/val/test splits and walk-forward folds."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelines.operators.rank import rows_at_ranks


@dataclass(frozen=True)
class Cuts:
    """Last train row and last train-or-val row in the order of ``keys`` (None: no such row)."""

    keys: tuple[str, ...]
    train: Row | None
    val: Row | None


def chronological_cuts(
    df: DataFrame,
    keys: Sequence[str],
    train_ratio: float = 0.70,
    val_ratio: float = 0.15,
    test_ratio: float = 0.15,
) -> Cuts:
    """Find the two rows that end the train and val parts in the order of ``keys`` (time first).

    Only counting scans over the key columns are needed; rows with a null time are not counted.
    """
    if abs(train_ratio + val_ratio + test_ratio - 1.0) > 1e-6:
        raise ValueError("the three shares of a split must add up to one")
    dated = df.filter(F.col(keys[0]).isNotNull()).select(*[c for k in keys for c in _never_null(df, k, k == keys[0])])
    ends = [train_ratio, train_ratio + val_ratio]
    _, rows = rows_at_ranks(dated, dated.columns, lambda total: [int(total * end) for end in ends])
    return Cuts(tuple(keys), *[row and _with_nulls(row, keys) for row in rows])


def _never_null(df: DataFrame, key: str, first: bool) -> list[Column]:
    """A key as columns without null, in the same order: a mark that puts nulls first, and a value."""
    if first:
        return [F.col(key)]
    kind = df.schema[key].dataType
    spare = {T.StringType: F.lit(""), T.TimestampType: F.timestamp_seconds(F.lit(0)), T.DateType: F.lit("1970-01-01")}
    value = F.coalesce(F.col(key), spare.get(type(kind), F.lit(0)).cast(kind))
    return [F.col(key).isNotNull().cast("int").alias(f"{key} is known"), value.alias(key)]


def _with_nulls(row: Row, keys: Sequence[str]) -> Row:
    return Row(**{k: row[k] if k == keys[0] or row[f"{k} is known"] else None for k in keys})


def _upto(df: DataFrame, keys: Sequence[str], cut: Row | None) -> Column:
    if cut is None:
        return F.lit(False)
    limit = F.struct(*[F.lit(cut[k]).cast(df.schema[k].dataType).alias(k) for k in keys])
    return F.struct(*[F.col(k) for k in keys]) <= limit


def assign_split(df: DataFrame, cuts: Cuts, name: str = "split") -> DataFrame:
    """Add the split as a comparison with the cut rows: a map-only step, no sort and no shuffle."""
    dated = F.col(cuts.keys[0]).isNotNull()
    label = (
        F.when(dated & _upto(df, cuts.keys, cuts.train), "train")
        .when(dated & _upto(df, cuts.keys, cuts.val), "val")
        .otherwise("test")
    )
    return df.withColumn(name, label)


def chronological_split(
    df: DataFrame,
    keys: Sequence[str],
    train_ratio: float = 0.70,
    val_ratio: float = 0.15,
    test_ratio: float = 0.15,
    whole_dates: bool = False,
) -> DataFrame:
    """Rank-based chronological split in the order of ``keys``.

    With ``whole_dates`` a time value is never divided between two splits: all its rows go where the
    first of them falls.
    """
    cuts = chronological_cuts(df, keys, train_ratio, val_ratio, test_ratio)
    if whole_dates:
        cuts = Cuts(cuts.keys[:1], cuts.train, cuts.val)
    return assign_split(df, cuts)


def fixed_split(
    df: DataFrame, time: str, train_end: str | datetime, val_end: str | datetime, name: str = "split"
) -> DataFrame:
    """Split at two given times, both inclusive on the earlier side."""
    ends = [F.lit(v).cast("timestamp") for v in (train_end, val_end)]
    at = F.col(time).cast("timestamp")
    return df.withColumn(name, F.when(at <= ends[0], "train").when(at <= ends[1], "val").otherwise("test"))


def _day(time: str, start: str) -> Column:
    return F.datediff(F.col(time).cast("date"), F.lit(start).cast("date"))


def _between(day: Column, low: Column, high: Column) -> Column:
    """The whole numbers from low to high, none if low is above or there is no day."""
    return F.when(day.isNotNull() & (low <= high), F.sequence(low, high)).otherwise(F.array().cast("array<bigint>"))


def _tested(day: Column, step_days: int, folds: int, horizon_days: int) -> Column:
    """Folds in whose test horizon a day lies: those cut at or before it, by less than the horizon."""
    first = F.greatest(F.floor((day - horizon_days) / step_days), F.lit(0))
    return _between(day, first, F.least(F.floor(day / step_days) - 1, F.lit(folds - 1)))


def walk_forward_folds(
    df: DataFrame, time: str, start: str, step_days: int, folds: int, horizon_days: int
) -> DataFrame:
    """Expanding-window folds: fold i trains on everything before its cut, tests on the next horizon.

    A row can belong to several folds; the folds are computed from the row's own time, so no join, and a plan is as short
    for five hundred folds as for five. Every row appears once for each fold it trains: where statistics or metrics are
    wanted, ``fold_statistics`` and ``fold_tests`` spare the copies. Rows without a time are in no fold.
    """
    day = _day(time, start)
    trained = _between(day, F.greatest(F.floor(day / step_days), F.lit(0)), F.lit(folds - 1).cast("bigint"))
    role = lambda name: lambda i: F.struct(i.cast("int").alias("fold"), F.lit(name).alias("role"))
    roles = F.concat(F.transform(trained, role("train")), F.transform(_tested(day, step_days, folds, horizon_days), role("test")))
    return df.withColumn("_fold", F.explode(roles)).select(
        *df.columns, F.col("_fold.fold").alias("fold"), F.col("_fold.role").alias("role")
    )


def fold_tests(df: DataFrame, time: str, start: str, step_days: int, folds: int, horizon_days: int) -> DataFrame:
    """Rows with each fold that tests them: at most horizon / step folds, rounded up."""
    tested = _tested(_day(time, start), step_days, folds, horizon_days)
    return df.select("*", F.explode(F.transform(tested, lambda i: i.cast("int"))).alias("fold"))


def fold_statistics(df: DataFrame, time: str, start: str, step_days: int, folds: int, cols: Sequence[str]) -> DataFrame:
    """fold, feature, n, mean, std, min and max of the training rows of every fold, in one pass over the rows.

    Training sets only grow, from one step to the next. So a row is counted in its step alone, as count, mean and sum of
    squared deviations; steps (a few rows per feature) are then merged one after the other, which loses no digits as
    sums of squares would. Nulls, infinity and NaN are left out. A fold without values has n = 0 and nulls.
    """
    day = _day(time, start)
    step = F.greatest(F.floor(day / step_days), F.lit(0)).cast("int").alias("step")
    pairs = df.filter(day < folds * step_days).select(step, *[F.col(c).cast("double").alias(c) for c in cols])
    long = pairs.unpivot(["step"], list(cols), "feature", "value").filter(F.abs("value") < float("inf"))
    moments = long.groupBy("feature", "step").agg(
        F.count("value").alias("n"),
        F.avg("value").alias("mean"),
        (F.var_pop("value") * F.count("value")).alias("m2"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    kind = "struct<n:bigint,mean:double,m2:double,min:double,max:double>"
    part = F.struct("n", "mean", "m2", "min", "max")
    by_step = moments.groupBy("feature").agg(F.map_from_entries(F.collect_list(F.struct("step", part))).alias("steps"))
    empty = F.struct(F.lit(0), F.lit(0.0), F.lit(0.0), F.lit(None), F.lit(None)).cast(kind)

    def merged(a: Column, b: Column) -> Column:
        n, apart = a["n"] + b["n"], b["mean"] - a["mean"]
        share = F.coalesce(F.try_divide(b["n"], n), F.lit(0.0))
        return F.struct(
            n.alias("n"),
            (a["mean"] + apart * share).alias("mean"),
            (a["m2"] + b["m2"] + apart * apart * a["n"] * share).alias("m2"),
            F.least(a["min"], b["min"]).alias("min"),
            F.greatest(a["max"], b["max"]).alias("max"),
        ).cast(kind)

    # Every feature has a row for every fold, also one without any value before the last cut.
    features = df.sparkSession.createDataFrame([(c,) for c in cols], "feature string")
    full = features.join(by_step, "feature", "left")
    each = F.transform(F.sequence(F.lit(0), F.lit(folds - 1)), lambda k: F.coalesce(F.get(F.map_values("steps"), F.array_position(F.map_keys("steps"), k).cast("int") - 1), empty))
    grown = F.aggregate(each, F.array().cast(f"array<{kind}>"), lambda done, s: F.array_append(done, merged(F.coalesce(F.try_element_at(done, F.lit(-1)), empty), s)))
    rows = full.select("feature", F.posexplode(grown).alias("fold", "s"))
    some = F.col("s.n") > 0
    return rows.select(
        "fold",
        "feature",
        F.col("s.n").alias("n"),
        F.when(some, F.col("s.mean")).alias("mean"),
        F.when(F.col("s.n") > 1, F.sqrt(F.col("s.m2") / (F.col("s.n") - 1))).alias("std"),
        F.col("s.min").alias("min"),
        F.col("s.max").alias("max"),
    )


def fold_normalised(tested: DataFrame, statistics: DataFrame, cols: Sequence[str], suffix: str = "_norm", min_std: float = 1e-8) -> DataFrame:
    """Test rows (``fold_tests``) with columns scaled by the statistics of their own fold's training rows; null where a
    fold has no spread. The statistics have one row per fold and feature, so joining them shuffles no test row."""
    wide = statistics.groupBy("fold").pivot("feature", list(cols)).agg(F.first("mean").alias("mean"), F.first("std").alias("std"))
    named = wide.withColumnRenamed("fold", "_fold")
    joined = tested.join(F.broadcast(named), F.col("fold") == F.col("_fold"), "left")
    scaled = [F.when(F.col(f"{c}_std") > min_std, (F.col(c) - F.col(f"{c}_mean")) / F.col(f"{c}_std")).alias(f"{c}{suffix}") for c in cols]
    return joined.select(*[tested[c] for c in tested.columns], *scaled)
