"""Row filters, clipping, placeholders, schema conformity and deduplication."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Physical bounds of the daily columns.
DAILY_BOUNDS: dict[str, tuple[float, float]] = {
    "temp_2m_mean": (-10, 55),
    "temp_2m_min": (-10, 55),
    "temp_2m_max": (-10, 55),
    "rh_2m_mean": (0, 100),
    "pressure_mean": (950, 1050),
    "precip_sum": (0, 500),
    "wind_speed_mean": (0, 150),
    "radiation_mean": (0, 1500),
    "cloud_cover_mean": (0, 100),
    "pm2_5_mean": (0, 1000),
    "pm10_mean": (0, 1000),
}


def require(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Rows in which all given columns are present (for example the target)."""
    return df.filter(" AND ".join(f"`{c}` IS NOT NULL" for c in cols))


def drop_null_rows(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """Rows without any null. NaN counts as a value, unlike in ``DataFrame.na.drop``."""
    return require(df, list(cols) if cols is not None else df.columns)


def clip(df: DataFrame, bounds: Mapping[str, tuple[float, float]] = DAILY_BOUNDS) -> DataFrame:
    """Limit columns to their bounds; null stays null, absent columns are skipped."""

    def limited(c: str) -> str:
        lo, hi = (f"{float(v)!r}D" for v in bounds[c])
        return f"CASE WHEN `{c}` IS NOT NULL THEN least(greatest(`{c}`, {lo}), {hi}) END AS `{c}`"

    return df.selectExpr(*[limited(c) if c in bounds else f"`{c}`" for c in df.columns])


def add_placeholders(df: DataFrame, cols: Iterable[str], kind: str = "double") -> DataFrame:
    """Typed null columns for inputs that are not available yet."""
    return df.selectExpr("*", *[f"CAST(NULL AS {kind}) AS `{c}`" for c in cols if c not in df.columns])


def filter_rows(
    df: DataFrame,
    entity: str | None = None,
    entities: Iterable[str] | None = None,
    time: str | None = None,
    years: Iterable[int] | None = None,
    months: Iterable[int] | None = None,
    hours: tuple[int, int] | None = None,
) -> DataFrame:
    """Membership and range predicates.

    Years become ranges of the time column itself, which reach the row groups of the scan; months and hours cannot.
    """
    if entities is not None:
        df = df.filter(F.col(entity).isin(list(entities)))
    if years is not None:
        kind = df.schema[time].dataType
        start = lambda y: F.lit(f"{y:04d}-01-01 00:00:00").cast(kind)
        spans = [(F.col(time) >= start(y)) & (F.col(time) < start(y + 1)) for y in sorted(set(years))]
        df = df.filter(reduce(lambda a, b: a | b, spans, F.lit(False)))
    if months is not None:
        df = df.filter(F.month(time).isin(list(months)))
    if hours is not None:
        df = df.filter(F.hour(time).between(*hours))
    return df


def keep_entities(df: DataFrame, chosen: DataFrame, entity: str) -> DataFrame:
    """Rows of the entities listed in ``chosen``, a table of any size."""
    return df.join(chosen.select(entity).distinct(), entity, "left_semi")


def complete_entities(df: DataFrame, entity: str, col: str, max_missing_ratio: float = 0.3) -> DataFrame:
    """Rows of the entities whose share of nulls in ``col`` is within the limit."""
    share = F.avg(F.col(col).isNull().cast("double"))
    kept = df.groupBy(entity).agg(share.alias("_missing")).filter(F.col("_missing") <= max_missing_ratio)
    return df.join(kept, entity, "left_semi")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Declared columns in declared order and type. A missing column is an AnalysisException."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def add_missing_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Like ``conform``, but columns the older data does not have become null."""
    have = set(df.columns)
    return df.select(
        *[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def latest_per_key(df: DataFrame, keys: Iterable[str], newest_first: Iterable[Column]) -> DataFrame:
    """One row per key: the first in the given order.

    Spark limits each key to one row per map task before the shuffle (WindowGroupLimit), so a key with a
    huge number of copies does not travel.
    """
    order = Window.partitionBy(*keys).orderBy(*newest_first)
    return df.withColumn("_rn", F.row_number().over(order)).filter(F.col("_rn") == 1).drop("_rn")


def union_all(*frames: DataFrame) -> DataFrame:
    """Strict vertical union by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames)
