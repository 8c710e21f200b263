"""Gold layer: split tables, combined tables and the manifest."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# The columns that order a Gold file, as far as a table has them.
ORDER = ("stationID", "date", "timestamp_utc")


def write_splits(df: DataFrame, path: str, split: str = "split", order: Sequence[str] = ORDER) -> None:
    """One folder per split; a reader of one split touches only that folder.

    Rows are sorted within files, so a reader of one station or span skips the rest of a file by its statistics. The
    rebalance hint gives files of even size: AQE splits a large split over several tasks and joins small ones.
    """
    keys = [c for c in order if c in df.columns]
    even = df.hint("rebalance", split).sortWithinPartitions(split, *keys)
    even.write.mode("overwrite").partitionBy(split).option("compression", "snappy").parquet(path)


def write_table(df: DataFrame, path: str, order: Sequence[str] = ORDER) -> None:
    """One table in files of even size, each sorted."""
    keys = [c for c in order if c in df.columns]
    df.hint("rebalance").sortWithinPartitions(*keys).write.mode("overwrite").option("compression", "snappy").parquet(path)


def read_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    return spark.read.parquet(path).filter(F.col("split") == split)


def manifest(
    df: DataFrame, time: str, config: Mapping[str, Any], version: str, created_at: str, split: str = "split"
) -> DataFrame:
    """One row: configuration, rows and range per split, and the column list."""
    per_split = df.groupBy(split).agg(
        F.count(F.lit(1)).alias("rows"), F.min(time).cast("string").alias("first"), F.max(time).cast("string").alias("last")
    )
    entry = F.struct("rows", "first", "last")
    merged = per_split.agg(
        *[F.first(F.when(F.col(split) == s, entry), ignorenulls=True).alias(s) for s in ("train", "val", "test")]
    )
    pairs = [F.lit(str(v)) for item in config.items() for v in item]
    return merged.select(
        F.lit(version).alias("pipeline_version"),
        F.lit(created_at).alias("created_at"),
        (F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")).alias("config"),
        F.struct("train", "val", "test").alias("splits"),
        F.struct(
            F.lit(len(df.columns)).alias("total_count"),
            F.lit(sum(c.endswith("_norm") for c in df.columns)).alias("normalized_count"),
            F.array(*[F.lit(c) for c in df.columns]).alias("columns"),
        ).alias("features"),
    )


def write_manifest(row: DataFrame, path: str) -> None:
    row.write.mode("overwrite").json(path)
