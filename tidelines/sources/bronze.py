"""Raw JSON documents: one object of parallel hourly arrays per station and period."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelines.functions.records import any_time, epoch_millis, parse_time, record_hash_v1, record_hash_v2
from tidelines.functions.wind import kmh_to_ms
from tidelines.operators.clean import conform
from tidelines.schemas import (
    AIR_QUALITY_ALIASES,
    AIR_QUALITY_BRONZE,
    AIR_QUALITY_SILVER,
    AIR_QUALITY_SILVER_V1,
    AIR_QUALITY_VARIABLES,
    CORRUPT,
    SHORT_TO_LONG,
    WEATHER_BRONZE,
    WEATHER_SILVER,
    WEATHER_VARIABLES,
)
from tidelines.sources.files import read_lines

# batch_<date>_<batch>_<station>.json.gz and batch_<date>_<station number>.json.gz.
STATION_IN_NAME = r"batch_\d{8}_[^_/]+_(.+)\.json(?:\.gz)?$"
NUMBER_IN_NAME = r"batch_\d{8}_(\d{4})\.json(?:\.gz)?$"
#: Documents in a written file at most: a gzip file is unpacked by one task, whatever its size.
DOCUMENTS = 25_000


def read_bronze(spark: SparkSession, path: str, schema: T.StructType = AIR_QUALITY_BRONZE, skip_broken: bool = False) -> DataFrame:
    """Scan Bronze files. Malformed documents keep their text in ``_corrupt``.

    A file that cannot be unpacked fails the job; with ``skip_broken`` its documents up to the fault are read, and
    ``losses`` tells which files these are.
    """
    return (
        spark.read.schema(schema)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.json*")
        .option("ignoreCorruptFiles", str(skip_broken).lower())
        .json(path)
        .select("*", F.col("_metadata.file_path").alias("file_path"))
    )


def parse_bronze(df: DataFrame, text: str, schema: T.StructType = AIR_QUALITY_BRONZE) -> DataFrame:
    """The same documents from a text column (a message stream or a table of responses)."""
    parsed = F.from_json(text, schema, {"columnNameOfCorruptRecord": CORRUPT, "mode": "PERMISSIVE"})
    return df.withColumn("_doc", parsed).select(*df.columns, "_doc.*")


def scan_documents(spark: SparkSession, path: str, schema: T.StructType = AIR_QUALITY_BRONZE, only: DataFrame | None = None) -> DataFrame:
    """All documents of a folder and what is lost, in one pass: beside the columns of ``read_bronze`` a row has a null
    ``reason``, unless it stands for a file that could not be unpacked to its end. The whole documents before such a
    fault are among the rows. ``only`` (path) limits the files."""
    texts = read_lines(spark, path, "*.json*", only).withColumn("text", F.col("text").cast("string"))
    return parse_bronze(texts, "text", schema).drop("text")


def losses_of(documents: DataFrame) -> DataFrame:
    """Broken or cut files (reason) and the number of malformed documents per file, from ``scan_documents``."""
    broken = documents.filter("reason IS NOT NULL").select("file_path", "reason", F.lit(None).cast("long").alias("documents"))
    malformed = documents.filter(F.col(CORRUPT).isNotNull()).groupBy("file_path").agg(F.count(F.lit(1)).alias("documents"))
    return broken.unionByName(malformed.select("file_path", F.lit("malformed documents").alias("reason"), "documents"))


def losses(spark: SparkSession, path: str, schema: T.StructType = AIR_QUALITY_BRONZE) -> DataFrame:
    """What a load would lose, per file."""
    return losses_of(scan_documents(spark, path, schema).select("file_path", "reason", CORRUPT))


def station_from_path(path: str = "file_path") -> Column:
    """Station id in a file name, null when the name carries none."""
    return F.nullif(F.regexp_extract(path, STATION_IN_NAME, 1), F.lit(""))


def with_station(docs: DataFrame, numbered: DataFrame | None = None) -> DataFrame:
    """Fill ``stationID`` from the document, the file name, or a table (number, stationID) of numbered names."""
    named = docs.withColumn("stationID", F.coalesce("stationID", station_from_path()))
    if numbered is None:
        return named
    number = F.nullif(F.regexp_extract("file_path", NUMBER_IN_NAME, 1), F.lit("")).cast("int")
    table = numbered.select(F.col("number").alias("_number"), F.col("stationID").alias("_station"))
    joined = named.withColumn("_no", number).join(table, F.col("_no") == F.col("_number"), "left")
    return joined.withColumn("stationID", F.coalesce("stationID", "_station")).select(*named.columns)


def unnest_hourly(
    docs: DataFrame, arrays: dict[str, Column], keep: list[str], parse: Callable[[Column], Column] | None = None
) -> DataFrame:
    """One row per entry of ``hourly.time``; shorter or missing arrays give null.

    Values beyond the last time are dropped. With ``parse`` each row also has its ``timestamp_utc``. It is read within the
    array: a filter on a column made after the explosion would be pushed below it and read each text twice.
    """
    empty = F.array().cast("array<double>")
    stamps = {} if parse is None else {"timestamp_utc": F.transform("hourly.time", parse)}
    flat = docs.select(
        *keep,
        F.col("hourly.time").alias("time_text"),
        *[a.alias(name) for name, a in stamps.items()],
        *[F.coalesce(a, empty).alias(name) for name, a in arrays.items()],
    )
    rows = flat.filter(F.size("time_text") > 0).select(*keep, F.inline(F.arrays_zip("time_text", *stamps, *arrays)))
    return rows.filter(F.col("time_text").isNotNull())


def air_quality_arrays(suffix: str = "_ugm3") -> dict[str, Column]:
    """Pollutant arrays under their long names, falling back to the short names of some responses."""
    out = {}
    for v in AIR_QUALITY_VARIABLES:
        array = F.col(f"hourly.{v}")
        if v in AIR_QUALITY_ALIASES:
            array = F.coalesce(array, F.col(f"hourly.{AIR_QUALITY_ALIASES[v]}"))
        out[v + suffix] = array
    return out


def _located(rows: DataFrame, stations: DataFrame | None) -> DataFrame:
    """Use the station's own position; the position in the response is that of the model grid cell."""
    grid = rows.withColumnsRenamed({"latitude": "grid_lat", "longitude": "grid_lon"})
    if stations is None:
        return grid.withColumns({"lat": F.col("grid_lat"), "lon": F.col("grid_lon")})
    # No hint: AQE broadcasts the station table when its measured size allows it.
    return grid.join(stations.select("stationID", "lat", "lon"), "stationID", "left")


def air_quality_silver(
    docs: DataFrame,
    *,
    data_source: str,
    load_id: str,
    ingested_at: str,
    pipeline_version: str = "2.0.0",
    stations: DataFrame | None = None,
    generation: int = 2,
) -> DataFrame:
    """Silver air-quality rows of Bronze documents.

    Generation 2 writes long names, doubles and the md5 record hash; generation 1 short names, floats and
    the sha256 hash. Rows whose time cannot be read are dropped.
    """
    at = parse_time if generation == 2 else any_time
    rows = unnest_hourly(docs, air_quality_arrays(), ["stationID", "latitude", "longitude"], at)
    timed = _located(rows, stations).filter(F.col("timestamp_utc").isNotNull())
    if generation == 2:
        digest, schema, names = (
            record_hash_v2(F.col("stationID"), F.col("time_text"), F.col("pm2_5_ugm3")),
            AIR_QUALITY_SILVER,
            {},
        )
    else:
        digest, schema, names = (
            record_hash_v1(F.col("stationID"), F.col("timestamp_utc")),
            AIR_QUALITY_SILVER_V1,
            {long: short for short, long in SHORT_TO_LONG.items()},
        )
    full = _with_provenance(timed, digest, data_source, load_id, ingested_at, pipeline_version)
    return conform(full.withColumnsRenamed(names), schema)


def weather_silver(
    docs: DataFrame,
    *,
    data_source: str,
    load_id: str,
    ingested_at: str,
    pipeline_version: str = "1.0.1",
    stations: DataFrame | None = None,
) -> DataFrame:
    """Silver weather rows of Bronze documents; only the wind components are converted from km/h."""
    arrays = {name: F.col(f"hourly.{v}") for v, name in WEATHER_VARIABLES.items()}
    rows = unnest_hourly(docs, arrays, ["stationID", "latitude", "longitude"], any_time)
    timed = rows.withColumns(
        {
            "u10_ms": kmh_to_ms(F.col("u10_ms")),
            "v10_ms": kmh_to_ms(F.col("v10_ms")),
        }
    )
    located = _located(timed, stations).filter(F.col("timestamp_utc").isNotNull())
    digest = record_hash_v1(F.col("stationID"), F.col("timestamp_utc"))
    full = _with_provenance(located, digest, data_source, load_id, ingested_at, pipeline_version)
    return conform(full, WEATHER_SILVER)


def _with_provenance(
    rows: DataFrame, digest: Column, data_source: str, load_id: str, ingested_at: str, pipeline_version: str
) -> DataFrame:
    return rows.withColumns(
        {
            "timestamp_unix_ms": epoch_millis(F.col("timestamp_utc")),
            "data_source": F.lit(data_source),
            "ingestion_timestamp_utc": F.lit(ingested_at).cast("timestamp"),
            "load_id": F.lit(load_id),
            "pipeline_version": F.lit(pipeline_version),
            "record_hash": digest,
        }
    )


def write_bronze(docs: DataFrame, path: str, mode: str = "append") -> None:
    """Gzipped JSON documents in year=/month= folders taken from each document's first time, ``DOCUMENTS`` a file."""
    first = F.get(F.col("hourly.time"), 0)
    keyed = docs.withColumns({"year": F.substring(first, 1, 4), "month": F.substring(first, 6, 2)})
    files = keyed.write.mode(mode).partitionBy("year", "month").option("maxRecordsPerFile", DOCUMENTS)
    files.option("compression", "gzip").json(path)


def check_documents(docs: DataFrame, min_hours: int = 2000, extreme: float = 200.0) -> DataFrame:
    """Six checks per weather document, as boolean columns.

    A corrupt document fails only ``corrupt``, one without wind components only ``missing_uv``. Null values
    inside the arrays count as NaN.
    """
    u, v, times = F.col("hourly.wind_u_component_10m"), F.col("hourly.wind_v_component_10m"), F.col("hourly.time")
    corrupt = F.col(CORRUPT).isNotNull()
    missing = ~corrupt & (u.isNull() | v.isNull())
    sound = ~corrupt & ~missing
    stamps = F.array_sort(F.transform(times, lambda t: any_time(t)))
    steps = F.zip_with(
        F.slice(stamps, 2, F.greatest(F.size(stamps) - 1, F.lit(0))),
        F.slice(stamps, 1, F.greatest(F.size(stamps) - 1, F.lit(0))),
        lambda b, a: F.unix_seconds(b) - F.unix_seconds(a),
    )
    # A time that cannot be read makes a null step, which is a gap as well.
    gap = F.exists(steps, lambda s: F.coalesce(s != 3600, F.lit(True)))
    void = lambda a: F.exists(a, lambda x: x.isNull() | F.isnan(x))
    big = lambda a: F.exists(a, lambda x: F.coalesce((F.abs(x) > extreme) & ~F.isnan(x), F.lit(False)))
    yes = lambda c: F.coalesce(sound & c, F.lit(False))
    return docs.withColumns(
        {
            "corrupt": corrupt,
            "missing_uv": missing,
            "bad_length": yes(F.coalesce(F.size(times), F.lit(0)) < min_hours),
            "time_gap": yes(gap),
            "nan": yes(void(u) | void(v)),
            "extreme": yes(big(u) | big(v)),
        }
    )


CHECKS = ["corrupt", "missing_uv", "bad_length", "time_gap", "nan", "extreme"]


def check_summary(checked: DataFrame) -> DataFrame:
    """Failed documents per check, and all documents."""
    wide = checked.agg(F.count(F.lit(1)).alias("documents"), *[F.count_if(c).alias(c) for c in CHECKS])
    cells = [F.struct(F.lit(c).alias("check"), F.col(c).alias("failed"), "documents") for c in CHECKS]
    return wide.select(F.inline(F.array(*cells)))


def has_wind_components(docs: DataFrame) -> DataFrame:
    """Documents that already carry u and v (the ledger of a backfill)."""
    return docs.filter(F.col("hourly.wind_u_component_10m").isNotNull())


__all__ = [
    "AIR_QUALITY_BRONZE",
    "WEATHER_BRONZE",
    "air_quality_silver",
    "check_documents",
    "check_summary",
    "has_wind_components",
    "losses",
    "losses_of",
    "parse_bronze",
    "read_bronze",
    "scan_documents",
    "station_from_path",
    "unnest_hourly",
    "weather_silver",
    "with_station",
    "write_bronze",
]
