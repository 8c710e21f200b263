"""Work lists for backfills: which entity and period still has to be loaded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def periods(start: Column, end: Column, months: int) -> Column:
    """Array of (start, end) dates covering [start, end] in calendar steps; the last one is cut at ``end``."""
    starts = F.sequence(F.trunc(start, "month"), end, F.make_interval(months=F.lit(months)))
    return F.transform(
        starts,
        lambda s: F.struct(
            F.greatest(s, start).alias("start"), F.least(F.date_sub(F.add_months(s, months), 1), end).alias("end")
        ),
    )


def day_periods(start: Column, end: Column, days: int) -> Column:
    """Array of (start, end) dates of ``days`` days each, the last one cut at ``end``."""
    starts = F.sequence(start, end, F.make_dt_interval(days=F.lit(days)))
    return F.transform(
        starts,
        lambda s: F.struct(s.alias("start"), F.least(F.date_add(s, days - 1), end).alias("end")),
    )


def work_list(stations: DataFrame, chunks: Column, entity: str = "stationID") -> DataFrame:
    """One row per station and period. Each station row generates its own periods, so nothing is joined."""
    one_each = stations.select(entity).distinct()
    return one_each.select(entity, F.inline(chunks))


def remaining(work: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Work items without an entry in the ledger or Bronze inventory."""
    return work.join(done.select(*keys).distinct(), keys, "left_anti")
