"""Normalisation with statistics of the training rows only."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Stat:
    """Fitted parameters of one feature: (mean, std) for standard, (min, max) for minmax."""

    feature: str
    method: str
    p1: float | None
    p2: float | None


STAT_SCHEMA = "feature string, method string, p1 double, p2 double"


def numeric_columns(df: DataFrame, exclude: Iterable[str] = (), integers: bool = True) -> list[str]:
    """Numeric columns outside a denylist, in schema order."""
    kinds: tuple[type, ...] = (T.DoubleType, T.FloatType)
    if integers:
        kinds += (T.LongType, T.IntegerType)
    denied = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds) and f.name not in denied]


def fit(train: DataFrame, cols: Iterable[str], method: str = "standard") -> list[Stat]:
    """Statistics of all columns in one aggregate over (feature, value) pairs.

    One row of parameters per column comes back. The long form keeps the aggregation buffer small, so it
    stays in generated code however many columns there are, and it is combined map-side.
    """
    if method not in ("standard", "minmax"):
        raise ValueError(f"method must be 'standard' or 'minmax', got {method!r}")
    cols = list(cols)
    if not cols:
        return []
    first, second = (F.avg, F.stddev_samp) if method == "standard" else (F.min, F.max)
    pairs = train.selectExpr(*[f"CAST(`{c}` AS DOUBLE) AS `{c}`" for c in cols]).unpivot([], cols, "feature", "value")
    pairs = pairs.filter(F.abs("value") < float("inf"))  # neither infinity nor NaN has a place on a scale
    rows = pairs.groupBy("feature").agg(first("value").alias("p1"), second("value").alias("p2")).collect()
    found = {r["feature"]: r for r in rows}
    return [Stat(c, method, *(found[c][1:] if c in found else (None, None))) for c in cols]


def usable(stat: Stat, min_std: float = 0.0) -> bool:
    """A feature with no spread in the training rows is left alone."""
    if stat.p1 is None or stat.p2 is None:
        return False
    return stat.p2 > min_std if stat.method == "standard" else stat.p1 != stat.p2


def scaled(stat: Stat) -> str:
    """SQL expression of the scaled feature; the parameters are written with full precision."""
    span = stat.p2 if stat.method == "standard" else stat.p2 - stat.p1
    return f"(CAST(`{stat.feature}` AS DOUBLE) - {stat.p1!r}D) / {span!r}D"


def add_normalised(df: DataFrame, stats: Iterable[Stat], suffix: str = "_norm", min_std: float = 1e-8) -> DataFrame:
    """Keep the columns and add a scaled copy of each usable one."""
    return df.selectExpr("*", *[f"{scaled(s)} AS `{s.feature}{suffix}`" for s in stats if usable(s, min_std)])


def normalise_in_place(df: DataFrame, stats: Iterable[Stat]) -> DataFrame:
    """Replace every usable column by its scaled value."""
    by_name = {s.feature: s for s in stats if usable(s)}
    return df.selectExpr(*[f"{scaled(by_name[c])} AS `{c}`" if c in by_name else f"`{c}`" for c in df.columns])


def stats_frame(spark: SparkSession, stats: Iterable[Stat]) -> DataFrame:
    """Statistics in long form, one row per feature."""
    return spark.createDataFrame([(s.feature, s.method, s.p1, s.p2) for s in stats], STAT_SCHEMA)


def write_stats(spark: SparkSession, stats: Iterable[Stat], path: str) -> None:
    stats_frame(spark, stats).write.mode("overwrite").json(path)


def read_stats(spark: SparkSession, path: str) -> list[Stat]:
    """Reload statistics; one row per feature column, so the result is as small as the schema."""
    return [Stat(*r) for r in spark.read.schema(STAT_SCHEMA).json(path).collect()]
