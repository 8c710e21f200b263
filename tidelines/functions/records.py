"""Record identity and timestamps of raw measurements."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RAW_TIME = "yyyy-MM-dd'T'HH:mm"


def parse_time(text: Column) -> Column:
    """UTC timestamp of ``2024-01-31T05:00``; null when malformed. The session runs in UTC."""
    return F.try_to_timestamp(text, F.lit(RAW_TIME))


def any_time(text: Column) -> Column:
    """UTC timestamp of a raw or ISO text with or without seconds and zone; null when malformed."""
    return F.coalesce(parse_time(text), text.try_cast("timestamp"))


def epoch_millis(time: Column) -> Column:
    return F.unix_millis(time)


def record_hash_v1(station: Column, time: Column) -> Column:
    """First 16 hex digits of sha256 over ``station|time``, the time written with its UTC offset."""
    text = F.concat(F.date_format(time, "yyyy-MM-dd HH:mm:ss"), F.lit("+00:00"))
    return F.substring(F.sha2(F.concat_ws("|", station, text), 256), 1, 16)


def record_hash_v2(station: Column, time_text: Column, value: Column) -> Column:
    """md5 over ``station_time_value``; a missing value is written as None."""
    return F.md5(F.concat_ws("_", station, time_text, F.coalesce(value.cast("string"), F.lit("None"))))
