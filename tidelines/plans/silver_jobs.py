"""Bronze to Silver, backfill planning and quality reports."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelines.operators.planning import periods, remaining, work_list
from tidelines.operators.quality import column_profile, station_coverage, temporal_coverage
from tidelines.schemas import AIR_QUALITY_BRONZE, CORRUPT, WEATHER_BRONZE
from tidelines.session import settings, staged
from tidelines.sources import bronze, inventory, silver
from tidelines.sources.files import list_files
from tidelines.sources.footers import accept
from tidelines.sources.ledger import Ledger


#: Bytes that a task of a load reads at most, where each file is taken for 4 MB more than it has. Spark's 128 MB would be
#: too much for one: packed documents grow to many times their size, as text and again as rows.
SHARE = 24 << 20


def _shares(spark: SparkSession) -> dict[str, str]:
    """The setting for it, unless the session already has a smaller one."""
    own = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return {"spark.sql.files.maxPartitionBytes": str(min(own, SHARE))}


def _sound_documents(
    spark: SparkSession, source: str, schema: T.StructType, losses: str | None, numbered: DataFrame | None, only: DataFrame | None
) -> DataFrame:
    """Well-formed documents with their station. Losses are an error, or go to the report ``losses``.

    Bronze is read once: its documents are stored in the shared folder, where losses are counted before any row is loaded.
    """
    docs = staged(bronze.scan_documents(spark, source, schema, only), "documents", bronze.DOCUMENTS)
    accept(bronze.losses_of(docs), losses)
    sound = docs.filter(F.col("reason").isNull() & F.col(CORRUPT).isNull()).drop("reason")
    return bronze.with_station(sound, numbered)


def _load(
    spark: SparkSession,
    source: str,
    target: str,
    schema: T.StructType,
    to_rows: Callable[[DataFrame], DataFrame],
    load_id: str,
    losses: str | None,
    numbered: DataFrame | None,
    ledger: str | None,
) -> None:
    """Append the documents of ``source`` to ``target``; with a ledger only those of files no complete load has read,
    after removing what an interrupted load has left."""
    if ledger is None:
        with settings(spark, _shares(spark)):
            silver.write_silver(to_rows(_sound_documents(spark, source, schema, losses, numbered, None)), target)
        return
    book = Ledger(ledger)
    book.withdraw(spark, target)
    # Written once: files that arrive while the load runs belong to the next one.
    files = staged(book.pending(spark, list_files(spark, source, "*.json*").select("path", "length")), "pending")
    if files.isEmpty():
        return
    with settings(spark, _shares(spark)):
        docs = _sound_documents(spark, source, schema, losses, numbered, files)
        book.begin(spark, load_id)
        silver.write_silver(to_rows(docs), target)
    book.commit(spark, load_id, files)


def run_bronze_to_silver(
    spark: SparkSession,
    source: str,
    target: str,
    *,
    data_source: str,
    load_id: str,
    ingested_at: str,
    stations: DataFrame | None = None,
    checksums: str | None = None,
    losses: str | None = None,
    ledger: str | None = None,
) -> DataFrame:
    """Load Bronze air-quality documents into Silver and return the Silver table.

    Broken files and malformed documents end the job before it writes, unless ``losses`` names a folder: then they are
    left out and listed there, with their numbers. With ``ledger`` (a folder) the job can be repeated: files it has loaded
    are passed over, and rows of a load that was interrupted are removed first.
    """
    names = {"data_source": data_source, "load_id": load_id, "ingested_at": ingested_at, "stations": stations}
    _load(spark, source, target, AIR_QUALITY_BRONZE, lambda docs: bronze.air_quality_silver(docs, **names), load_id, losses, None, ledger)
    if checksums:
        inventory.write_checksums(spark, target, checksums)
    return silver.read_air_quality(spark, [silver.Generation(target)])


def run_weather_to_silver(
    spark: SparkSession,
    source: str,
    target: str,
    *,
    data_source: str,
    load_id: str,
    ingested_at: str,
    stations: DataFrame | None = None,
    numbered: DataFrame | None = None,
    losses: str | None = None,
    ledger: str | None = None,
) -> DataFrame:
    """Load Bronze weather documents into Silver and return the Silver table; ``numbered`` (number, stationID) names
    the stations of numbered files. ``losses`` and ``ledger`` as for air quality."""
    names = {"data_source": data_source, "load_id": load_id, "ingested_at": ingested_at, "stations": stations}
    _load(spark, source, target, WEATHER_BRONZE, lambda docs: bronze.weather_silver(docs, **names), load_id, losses, numbered, ledger)
    return silver.read_weather(spark, target)


def done_periods(spark: SparkSession, path: str, numbered: DataFrame | None = None) -> DataFrame:
    """stationID and start of the weather documents that already carry wind components."""
    docs = bronze.has_wind_components(bronze.with_station(bronze.read_bronze(spark, path, WEATHER_BRONZE), numbered))
    return docs.select("stationID", F.to_date(F.substring(F.get(F.col("hourly.time"), 0), 1, 10)).alias("start"))


def backfill_plan(
    stations: DataFrame, done: DataFrame, start: str, end: str, months: int = 3, entity: str = "stationID"
) -> DataFrame:
    """Station periods between two dates that ``done`` (entity, start) does not list yet."""
    chunks = periods(F.lit(start).cast("date"), F.lit(end).cast("date"), months)
    return remaining(work_list(stations, chunks, entity), done, [entity, "start"])


def quality_report(df: DataFrame) -> dict[str, DataFrame]:
    """Profile, temporal coverage and station coverage of a table."""
    return {
        "profile": column_profile(df),
        "temporal": temporal_coverage(df),
        "stations": station_coverage(df),
    }


def quality_metrics(df: DataFrame) -> DataFrame:
    """The same report as one long table of (section, item, metric, value)."""
    report = quality_report(df)

    def long(frame: DataFrame, section: str, item) -> DataFrame:
        metrics = [c for c, t in frame.dtypes if t in ("int", "bigint", "double")]
        cells = F.array(
            *[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics]
        )
        return frame.select(F.lit(section).alias("section"), item.alias("item"), F.inline(cells))

    return (
        long(report["profile"], "profile", F.col("column"))
        .unionByName(long(report["temporal"], "temporal", F.lit("date")))
        .unionByName(long(report["stations"], "stations", F.lit("stationID")))
    )
