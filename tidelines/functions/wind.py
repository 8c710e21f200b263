"""Wind vectors. Directions are degrees the wind comes from, u points east and v north."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def wind_u(speed: Column, direction: Column) -> Column:
    return -speed * F.sin(F.radians(direction))


def wind_v(speed: Column, direction: Column) -> Column:
    return -speed * F.cos(F.radians(direction))


def wind_speed(u: Column, v: Column) -> Column:
    return F.hypot(u, v)


def wind_direction(u: Column, v: Column) -> Column:
    """Degrees from 0 to 360. A vector of length zero has the direction of its zeros: 180 where the northward part to the
    source, ``-v``, is a negative zero, else 0. Spark's atan2 takes all zeros as positive; a power tells them apart."""
    calm = F.when(F.pow(v, F.lit(-1.0)) > 0, F.lit(180.0)).otherwise(F.lit(0.0))
    turned = (F.degrees(F.atan2(-u, -v)) + F.lit(360.0)) % F.lit(360.0)
    return F.when((u == 0) & (v == 0), calm).otherwise(turned)


def kmh_to_ms(speed: Column) -> Column:
    return speed / F.lit(3.6)


def add_wind_vectors(
    df: DataFrame,
    speed: str = "wind_speed_mean",
    direction: str = "wind_direction_mean",
    u: str = "wind_u10_mean",
    v: str = "wind_v10_mean",
) -> DataFrame:
    s, d = F.col(speed), F.col(direction)
    return df.select("*", wind_u(s, d).alias(u), wind_v(s, d).alias(v))


def wind_consistent(speed: str, u: str, v: str, tolerance: float = 0.1) -> Column:
    """True where the stored speed agrees with its components."""
    return F.abs(F.col(speed) - wind_speed(F.col(u), F.col(v))) < tolerance


def conversion_correct(actual: str, original: str, factor: float = 3.6, tolerance: float = 0.001) -> Column:
    """True where ``actual`` is ``original / factor``."""
    return F.abs(F.col(actual) - F.col(original) / F.lit(factor)) < tolerance
