"""Calendar parts and cyclic encodings of a timestamp or date."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def iso_weekday(time: Column) -> Column:
    """1 = Monday ... 7 = Sunday."""
    return F.weekday(time) + 1


def cyclic(value: Column, period: float, name: str, offset: float = 0, pi: float = math.pi) -> list[Column]:
    """Sine and cosine of a value that repeats with ``period``."""
    angle = (value - F.lit(offset)) * F.lit(2 * pi) / F.lit(float(period))
    return [F.sin(angle).alias(f"{name}_sin"), F.cos(angle).alias(f"{name}_cos")]


def add_hourly_calendar(df: DataFrame, time: str = "timestamp_utc", weekend_from: int = 5) -> DataFrame:
    """Twelve calendar columns of the hourly table.

    ``weekend_from`` is the first ISO weekday that counts as weekend; 5 reproduces the established data
    (Friday to Sunday), 6 is Saturday and Sunday.
    """
    t = F.col(time)
    dow = iso_weekday(t)
    return df.select(
        "*",
        F.hour(t).alias("hour"),
        F.dayofmonth(t).alias("day"),
        F.month(t).alias("month"),
        dow.alias("day_of_week"),
        F.year(t).alias("year"),
        (dow >= weekend_from).alias("is_weekend"),
        *cyclic(F.hour(t), 24, "hour"),
        *cyclic(F.month(t), 12, "month", offset=1),
        *cyclic(dow, 7, "dow"),
    )


def add_daily_calendar(df: DataFrame, date: str = "date") -> DataFrame:
    """Cyclic day of year and month of the daily table."""
    d = F.col(date)
    return df.select("*", *cyclic(F.dayofyear(d), 365.25, "day_of_year"), *cyclic(F.month(d), 12, "month"))


# Fixed value: the combined table was always built with this many digits.
SHORT_PI = 3.14159


def add_combined_calendar(
    df: DataFrame, time: str = "timestamp_utc", weekend_from: int = 5, pi: float = SHORT_PI
) -> DataFrame:
    """Twelve calendar columns of the combined table; ``weekend_from`` as in add_hourly_calendar."""
    t = F.col(time)
    return df.select(
        "*",
        F.year(t).alias("year"),
        F.month(t).alias("month"),
        F.dayofmonth(t).alias("day"),
        F.hour(t).alias("hour"),
        iso_weekday(t).alias("weekday"),
        F.dayofyear(t).alias("day_of_year"),
        *cyclic(F.hour(t), 24, "hour", pi=pi),
        *cyclic(F.month(t), 12, "month", pi=pi),
        F.hour(t).between(6, 18).alias("is_daytime"),
        (iso_weekday(t) < weekend_from).alias("is_weekday"),
    )


def season(time: Column) -> Column:
    """Meteorological season by month: DJF, MAM, JJA, SON."""
    m = F.month(time)
    return (
        F.when(m.isin(12, 1, 2), "DJF").when(m.between(3, 5), "MAM").when(m.between(6, 8), "JJA").otherwise("SON")
    )
