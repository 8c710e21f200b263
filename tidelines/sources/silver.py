"""Partitioned Parquet tables of the Silver layer and their schema generations."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelines.operators.clean import union_all
from tidelines.schemas import (
    AIR_QUALITY_SILVER,
    LONG_POLLUTANTS,
    SHORT_TO_LONG,
    STATIONS,
    WEATHER_SILVER,
)
from tidelines.session import staged
from tidelines.sources.files import has_files, ranged
from tidelines.sources.footers import accept, parquet_types, read_row_groups


def _reader(spark: SparkSession, schema: T.StructType):
    """A file whose types differ from ``schema``, or that is broken, is an error and never skipped."""
    return spark.read.schema(schema).option("pathGlobFilter", "*.parquet")


def read_weather(spark: SparkSession, path: str) -> DataFrame:
    """Weather scan. Columns an older file lacks are null; values are widened to double.

    A missing folder is an error, as is a folder without any Parquet file.
    """
    wide = T.StructType(
        [T.StructField(f.name, T.DoubleType() if isinstance(f.dataType, T.FloatType) else f.dataType) for f in WEATHER_SILVER]
    )
    if has_files(spark, path) is False:
        raise FileNotFoundError(f"{path} holds no Parquet file")
    return _reader(spark, _with_partitions(wide)).parquet(path).select(*WEATHER_SILVER.names)


def _with_partitions(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType())])


def read_optional_air_quality(spark: SparkSession, path: str, losses: str | None = None) -> DataFrame | None:
    """Air-quality scan, or None when the folder is missing or empty."""
    return read_air_quality(spark, [Generation(path)], losses=losses) if has_files(spark, path) else None


@dataclass(frozen=True)
class Generation:
    """Files of one folder.

    ``ingestion``: how the ingestion time is stored (timestamp, timestamp_ntz or string); None looks at every file,
    so the folder may mix what several versions of the loader wrote.
    ``nanos``: ``timestamp_utc`` is stored in nanoseconds (also found out if ``ingestion`` is None); see
    ``allow_nanoseconds``.
    """

    path: str
    ingestion: str | None = None
    nanos: bool = False


def allow_nanoseconds(spark: SparkSession) -> None:
    """Let Spark read nanosecond timestamps as integers, which Generation(nanos=True) then converts."""
    spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")


def _stored(ingestion: str, nanos: bool) -> T.StructType:
    """Columns of one class of files as they are stored, under every name a pollutant has had."""
    kinds = {"timestamp": T.TimestampType(), "timestamp_ntz": T.TimestampNTZType(), "string": T.StringType()}
    fields = []
    for f in AIR_QUALITY_SILVER.fields:
        kind = f.dataType
        if f.name == "ingestion_timestamp_utc":
            kind = T.LongType() if ingestion.endswith("_nanos") else kinds[ingestion]
        if f.name == "timestamp_utc" and nanos:
            kind = T.LongType()
        fields.append(T.StructField(f.name, kind))
    return T.StructType([*fields, *(T.StructField(short, T.DoubleType()) for short in SHORT_TO_LONG)])


def _scan(spark: SparkSession, paths: list[str], ingestion: str, nanos: bool, base: str | None = None) -> DataFrame:
    if nanos or ingestion.endswith("_nanos"):
        allow_nanoseconds(spark)
    reader = _reader(spark, _with_partitions(_stored(ingestion, nanos)))
    return (reader.option("basePath", base) if base else reader).parquet(*paths)


def _partition(name: str) -> Column:
    return F.regexp_extract("file_path", f"/{name}=([0-9]+)/", 1).try_cast("int").alias(name)


def _apart(spark: SparkSession, generation: Generation, kinds: DataFrame, ingestion: str, nanos: bool, years: list[int] | None) -> DataFrame:
    """The rows of one class of files among others in the same folders, read row group by row group."""
    files = kinds.filter((F.col("ingestion") == ingestion) & (F.col("nanos") == F.lit(nanos)) & ~F.col("bad"))
    if years is not None:
        files = files.filter(_partition("year").isin(years))
    if not ranged(spark, generation.path):
        # Storage that tasks cannot open: Spark reads the files by name, which the driver must hold.
        return _scan(spark, sorted(r["file_path"] for r in files.select("file_path").collect()), ingestion, nanos, generation.path)
    rows = read_row_groups(files, _stored(ingestion, nanos))
    return rows.select(*_stored(ingestion, nanos).names, _partition("year"), _partition("month"))


def read_generations(spark: SparkSession, generation: Generation, losses: str | None = None, years: Iterable[int] | None = None) -> list[DataFrame]:
    """Scans of one folder, one for each combination of stored types, with every known column name.

    Types come from the footers. A folder of files of one kind is read as that folder; where kinds are mixed, or a file is
    broken, tasks read the row groups of each kind. So the driver holds the names of folders at most, and none if all
    files are of one kind. Broken files are an error, or are left out and written to the report ``losses``.
    """
    if generation.ingestion is not None:
        return [_scan(spark, [generation.path], generation.ingestion, generation.nanos)]
    wanted = None if years is None else list(years)
    found = staged(parquet_types(spark, generation.path, ["ingestion_timestamp_utc", "timestamp_utc"]), "footers")
    broken = found.filter("error IS NOT NULL").select("file_path", F.col("error").alias("reason"), F.lit(None).cast("long").alias("documents"))
    accept(broken, losses)
    ingestion = F.coalesce("ingestion_timestamp_utc", F.lit("timestamp")).alias("ingestion")
    nanos = F.coalesce(F.col("timestamp_utc").endswith("_nanos"), F.lit(False)).alias("nanos")
    kinds = found.select("file_path", "folder", "groups", F.col("error").isNotNull().alias("bad"), ingestion, nanos)
    alike = F.count_distinct("bad", "ingestion", "nanos") == 1
    one = kinds.agg(alike.alias("alike"), F.max("ingestion").alias("ingestion"), F.max("nanos").alias("nanos"), F.max("bad").alias("bad")).first()
    if one["alike"] and not one["bad"]:
        return [_scan(spark, [generation.path], one["ingestion"], one["nanos"])]
    folders = staged(kinds.groupBy("folder").agg((alike & ~F.max("bad")).alias("alike")), "folders")
    mixed = staged(kinds.join(folders.filter("NOT alike"), "folder", "left_semi"), "mixed")
    whole = kinds.join(folders.filter("alike"), "folder", "left_semi").groupBy("ingestion", "nanos").agg(F.collect_set("folder").alias("folders"))
    scans = [_scan(spark, sorted(r["folders"]), r["ingestion"], r["nanos"], generation.path) for r in whole.orderBy("ingestion", "nanos").collect()]
    apart = mixed.filter("NOT bad").select("ingestion", "nanos").distinct().orderBy("ingestion", "nanos").collect()
    return scans + [_apart(spark, generation, mixed, r["ingestion"], r["nanos"], wanted) for r in apart]


def _utc(df: DataFrame, col: str) -> Column:
    kind = df.schema[col].dataType
    if isinstance(kind, T.LongType):
        # Integer division keeps the microsecond.
        return F.timestamp_micros(F.expr(f"`{col}` div 1000"))
    if isinstance(kind, T.StringType):
        return F.col(col).try_cast("timestamp")
    return F.col(col).cast("timestamp")


def reconcile(df: DataFrame) -> DataFrame:
    """Canonical air-quality columns of any generation: long names, doubles, UTC timestamps."""
    have = set(df.columns)
    long_to_short = {long: short for short, long in SHORT_TO_LONG.items()}

    def column(f: T.StructField) -> Column:
        if isinstance(f.dataType, T.TimestampType) and f.name in have:
            return _utc(df, f.name)
        names = [n for n in (f.name, long_to_short.get(f.name)) if n in have]
        if not names:
            return F.lit(None)
        return F.coalesce(*[F.col(n).cast(f.dataType) for n in names])

    return df.select(*[column(f).cast(f.dataType).alias(f.name) for f in AIR_QUALITY_SILVER.fields])


def read_air_quality(
    spark: SparkSession,
    generations: Sequence[Generation],
    years: Iterable[int] | None = None,
    losses: str | None = None,
) -> DataFrame:
    """Union of all generations in canonical form. ``years`` prunes the year= folders.

    Files that cannot be read are an error, unless ``losses`` names a folder for the report about them. The result is
    not sorted: operators order within their own windows.
    """
    if not generations:
        raise ValueError("at least one folder of air-quality files is needed")
    frames = []
    for generation in generations:
        for df in read_generations(spark, generation, losses, years):
            if years is not None:
                df = df.filter(F.col("year").isin(list(years)))
            frames.append(reconcile(df))
    return union_all(*frames) if frames else spark.createDataFrame([], AIR_QUALITY_SILVER)


def to_short_names(df: DataFrame) -> DataFrame:
    """Canonical columns under the short pollutant names the daily job uses."""
    return df.withColumnsRenamed({long: short for short, long in SHORT_TO_LONG.items()})


def read_stations(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STATIONS).parquet(path)


def write_silver(df: DataFrame, path: str, time: str = "timestamp_utc", mode: str = "append") -> None:
    """Hive-partitioned snappy Parquet; year and month come from each row's own time.

    The rebalance hint gives files of even size: AQE splits a month that is too large for one task and
    joins small ones. Rows are sorted within files, so row
    groups can be skipped by station and time. Spark's commit protocol publishes the files only when the job succeeds.
    """
    # Formatting a time costs more than taking its parts; years of other than four digits are left to it.
    year = F.year(time)
    written = F.when(year.between(1000, 9999), year.cast("string")).otherwise(F.date_format(time, "yyyy"))
    keyed = df.withColumns({"year": written, "month": F.lpad(F.month(time).cast("string"), 2, "0")})
    (
        keyed.hint("rebalance", "year", "month")
        .sortWithinPartitions("year", "month", *[c for c in ("stationID", time) if c in df.columns])
        .write.mode(mode)
        .partitionBy("year", "month")
        .option("compression", "snappy")
        .option("parquet.enable.dictionary#record_hash", "false")  # no hash comes twice
        .parquet(path)
    )


__all__ = [
    "LONG_POLLUTANTS",
    "Generation",
    "allow_nanoseconds",
    "read_air_quality",
    "read_generations",
    "read_optional_air_quality",
    "read_stations",
    "read_weather",
    "reconcile",
    "to_short_names",
    "write_silver",
]
