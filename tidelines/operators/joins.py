"""Joining measurements of the same panel."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_panels(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str] = ("date", "stationID"),
    how: str = "left",
    fill: Iterable[str] = ("lat", "lon"),
) -> DataFrame:
    """Join two panels; columns present on both sides are taken from the left.

    For a full join, ``fill`` names shared columns that fall back to the right side where the left has no
    row.
    """
    shared = [c for c in right.columns if c in left.columns and c not in on]
    if how != "full":
        return left.join(right.drop(*shared), list(on), how)
    keep = [c for c in fill if c in shared]
    other = right.drop(*[c for c in shared if c not in keep])
    for c in keep:
        other = other.withColumnRenamed(c, f"_r_{c}")
    joined = left.join(other, list(on), "full")
    own = [F.coalesce(F.col(c), F.col(f"_r_{c}")).alias(c) if c in keep else F.col(c) for c in left.columns]
    added = [c for c in right.columns if c not in left.columns]
    return joined.select(*own, *added)


def attach_group_stats(df: DataFrame, stats: DataFrame, key: str) -> DataFrame:
    """Join one stats row per group back to the rows.

    No broadcast hint: the stats grow with the number of groups. AQE broadcasts them when their measured
    size is small, and splits the skewed partitions of the sort-merge join when a group is large.
    """
    return df.join(stats, key, "left")
