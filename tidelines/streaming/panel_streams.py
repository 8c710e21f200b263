"""Structured Streaming counterparts of the ingest, deduplication, daily and feature steps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidelines.operators.windows import RowFeatures, add_features
from tidelines.panel import MAX_ROWS, Panel, as_micros
from tidelines.schemas import AIR_QUALITY_BRONZE, CORRUPT
from tidelines.session import staged
from tidelines.sources import bronze
from tidelines.sources.files import complete_folders, remove_folders


def read_stream(
    spark: SparkSession, path: str, schema: T.StructType, glob: str = "*.parquet", files_per_trigger: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def read_bronze_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Bronze documents as they arrive. Malformed ones are left out and counted: the query's progress has the metrics
    ``bronze_documents`` (documents, malformed). A file that cannot be unpacked stops the query."""
    reader = (
        spark.readStream.schema(AIR_QUALITY_BRONZE)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.json*")
    )
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    docs = reader.json(path).select("*", F.col("_metadata.file_path").alias("file_path"))
    counts = [F.count(F.lit(1)).alias("documents"), F.count_if(F.col(CORRUPT).isNotNull()).alias("malformed")]
    return bronze.with_station(docs.observe("bronze_documents", *counts).filter(F.col(CORRUPT).isNull()))


def append_parquet(
    stream: DataFrame, target: str, checkpoint: str, partition_by: Sequence[str] = (), available_now: bool = True
) -> StreamingQuery:
    """Checkpointed exactly-once append to Parquet."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(target)


def bronze_to_silver(stream: DataFrame, *, data_source: str, load_id: str, ingested_at: str) -> DataFrame:
    """Silver rows with their partition columns; a stateless transformation."""
    rows = bronze.air_quality_silver(stream, data_source=data_source, load_id=load_id, ingested_at=ingested_at)
    return rows.withColumns(
        {"year": F.date_format("timestamp_utc", "yyyy"), "month": F.date_format("timestamp_utc", "MM")}
    )


def dedupe(stream: DataFrame, panel: Panel, delay: str = "1 day") -> DataFrame:
    """First arrival per entity and time. State is kept only as long as the watermark delay."""
    return stream.withWatermark(panel.time, delay).dropDuplicatesWithinWatermark([panel.entity, panel.time])


def daily_means(stream: DataFrame, panel: Panel, cols: Sequence[str], delay: str = "2 days") -> DataFrame:
    """Tumbling daily mean, minimum and maximum per entity, and the last time of each; rows later than the watermark are
    dropped."""
    aggs = [F.count(F.lit(1)).alias("rows"), F.max(panel.time).alias("last_time")]
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}_mean"), F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max")]
    days = stream.withWatermark(panel.time, delay).groupBy(F.window(panel.time, "1 day").alias("_w"), panel.entity)
    return days.agg(*aggs).select(
        F.to_date("_w.start").alias("date"), panel.entity, "rows", "last_time", *[f"{c}_{s}" for c in cols for s in ("mean", "min", "max")]
    )


def keep_days(stream: DataFrame, target: str, checkpoint: str, keys: Sequence[str], delay: str = "2 days") -> StreamingQuery:
    """Keep a table of days (``daily_means``): finished ones once and for all, and beside them those still open.

    Days that end ``delay`` or more before the newest time seen get no more rows: from the next batch on, the stream's
    watermark (give it the same delay) drops what would belong to them. They move to ``closed``, a folder for each day up
    to which days are closed. All others stand in ``open``, which each batch writes anew from the batch before and then
    removes what is older. So the number of files follows the number of days, not that of batches. A repeated batch
    replaces what it wrote before. ``read_days`` reads both.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        updates = batch.withColumn("_batch", F.lit(number))
        before = _newest_open(spark, target, number)
        rows = updates
        if before is not None:
            rows = spark.read.schema(updates.schema).parquet(f"{target}/open/batch={before}").unionByName(updates)
        newest = Window.partitionBy(*keys).orderBy(F.col("_batch").desc())
        latest = staged(rows.withColumn("_rn", F.row_number().over(newest)).filter("_rn = 1").drop("_rn"), "days")
        # The newest time seen is that of a day still kept here: its own day cannot have been closed before it.
        until = latest.agg((F.max("last_time") - F.expr(f"INTERVAL {delay}")).alias("t")).select(F.to_date("t").alias("until")).first()["until"]
        done = F.lit(False) if until is None else F.col("date") < F.lit(until)
        closed = latest.filter(done).drop("_batch")
        if not closed.isEmpty():
            closed.hint("rebalance").write.mode("overwrite").parquet(f"{target}/closed/until={until}")
        latest.filter(~done).hint("rebalance").write.mode("overwrite").parquet(f"{target}/open/batch={number}")
        # The batch before is kept: it is what a repeated batch starts from.
        remove_folders(spark, f"{target}/open", lambda name: name.startswith("batch=") and int(name[6:]) < (number if before is None else before))

    return (
        stream.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
        .trigger(availableNow=True)
        .start()
    )


def _newest_open(spark: SparkSession, target: str, below: int | None = None) -> int | None:
    """The last complete batch of open days, before batch ``below``."""
    numbers = [int(name[6:]) for name in complete_folders(spark, f"{target}/open") if name.startswith("batch=")]
    return max((n for n in numbers if below is None or n < below), default=None)


def read_days(spark: SparkSession, target: str) -> DataFrame:
    """All days of ``keep_days``, with ``closed``."""
    number = _newest_open(spark, target)
    open_days = spark.read.parquet(f"{target}/open/batch={number}").drop("_batch")
    if not complete_folders(spark, f"{target}/closed"):
        return open_days.withColumn("closed", F.lit(False))
    finished = spark.read.schema(open_days.schema).parquet(f"{target}/closed").select(*open_days.columns)
    return finished.withColumn("closed", F.lit(True)).unionByName(open_days.withColumn("closed", F.lit(False)))


def latest_updates(spark: SparkSession, target: str, keys: Sequence[str]) -> DataFrame:
    """Last update per key of a folder to which every batch has written its rows."""
    newest = Window.partitionBy(*keys).orderBy(F.col("batch").desc())
    log = spark.read.parquet(target)
    return log.withColumn("_rn", F.row_number().over(newest)).filter(F.col("_rn") == 1).drop("_rn", "batch")


def incremental_features(
    stream: DataFrame,
    panel: Panel,
    features: Sequence[RowFeatures],
    target: str,
    checkpoint: str,
    history: str,
    late_rows: int = 168,
    max_rows: int = MAX_ROWS,
) -> StreamingQuery:
    """Look-back features (lags, rolling) of rows that arrive in any order.

    A late row changes the rows after it: every batch writes the features of its own rows and, again, of the rows that
    look back at one of them. ``latest_updates`` (keys: entity, time, ties) gives the table, equal to that of one batch
    over all rows. What a batch starts from is the ring: the last rows per entity, as many as features look back and
    ``late_rows`` more. Only for an entity whose new rows reach further back than its ring are all its rows read, from the
    history that every batch adds to. A repeated batch replaces what it wrote. Rows equal in entity, time and ties are one
    row. Rings before the last one may be deleted at any time.
    """
    if any(f.ahead for f in features):
        raise ValueError("Features that look ahead cannot be computed on arrival")
    back = max((f.back for f in features), default=0)
    columns = stream.columns
    stored = T.StructType([*stream.schema.fields])
    ringed = T.StructType([*stored.fields, T.StructField("_seen", T.LongType())])
    entity = F.col(panel.entity)
    keep = max(1, back) + late_rows
    # Times alone, which can be compared in a hash aggregate; a null comes first. Rows of equal time do not count as
    # earlier, so where ties matter the history is read.
    at = F.coalesce(as_micros(panel.time), F.lit(-(1 << 63)))

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{history}/rows/batch={number}")
        new = spark.read.schema(stored).parquet(f"{history}/rows/batch={number}")
        ring = spark.createDataFrame([], ringed)
        if number > 0:
            ring = spark.read.schema(ringed).parquet(f"{history}/ring/batch={number - 1}")
        first = new.groupBy(entity.alias("_entity")).agg(F.min(at).alias("_first"), F.count(F.lit(1)).alias("_new_rows"))
        # One row per entity of the batch; the ring is read once for all that is asked of it.
        reach = staged(
            first.join(ring, F.col("_entity").eqNullSafe(entity), "left")
            .groupBy("_entity")
            .agg(
                F.first("_new_rows").alias("_new_rows"),
                F.count_if(F.col("_seen").isNotNull() & (at < F.col("_first"))).alias("_before"),
                F.count("_seen").alias("_held"),
                F.coalesce(F.max("_seen"), F.lit(0)).alias("_seen_before"),
            ),
            "reach",
        )
        is_deep = (F.col("_before") < back) & (F.col("_held") < F.col("_seen_before"))
        seen = F.col("_seen_before") + F.col("_new_rows")
        found = reach.agg(F.coalesce(F.max(is_deep), F.lit(False)).alias("deep"), F.max(seen).alias("largest")).first()
        deep = reach.filter(is_deep).select("_entity")
        base = ring.join(reach.filter(~is_deep), entity.eqNullSafe(F.col("_entity")), "left_semi").select(*columns)
        if found["deep"]:
            log = spark.read.schema(T.StructType([*stored.fields, T.StructField("batch", T.IntegerType())])).parquet(f"{history}/rows")
            earlier = log.filter(F.col("batch") < number).join(deep, entity.eqNullSafe(F.col("_entity")), "left_semi")
            base = base.unionByName(earlier.select(*columns))
        both = new.withColumn("_new", F.lit(True)).unionByName(base.withColumn("_new", F.lit(False)))
        fitted = panel
        if (found["largest"] or 0) > max_rows:
            both = staged(both.dropDuplicates([*panel.keys(), *panel.order]), "rows")
            fitted = panel.fit(both, max_rows)
        else:
            # No entity is large: copies are dropped and windows computed on one exchange.
            both = both.repartition(entity).dropDuplicates([*panel.keys(), *panel.order])
        # A row is written if it is new, or looks back at one that is; the last rows make the next ring.
        fresh = (("_touched", f"max(`_new`) OVER ({{w}} ROWS BETWEEN {back} PRECEDING AND CURRENT ROW)"),)
        if fitted.slices is None:
            place = (("_from_last", "count(1) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) - row_number() OVER ({w})"),)
            out = add_features(both, fitted, *features, RowFeatures((fresh,), ("_touched",), back), RowFeatures((place,), ("_from_last",)))
            out = staged(out.filter(F.col("_touched") | (F.col("_from_last") < keep)), "features")
            tail = out.filter(F.col("_from_last") < keep)
            out = out.drop("_from_last")
        else:
            out = add_features(both, fitted, *features, RowFeatures((fresh,), ("_touched",), back))
            order = F.row_number().over(panel.reverse_window())
            tail = both.withColumn("_rn", order).filter(F.col("_rn") <= keep)
        out.filter("_touched").drop("_new", "_touched").write.mode("overwrite").parquet(f"{target}/batch={number}")
        total = reach.select("_entity", seen.alias("_seen"))
        named = tail.select(*columns).join(total, entity.eqNullSafe(F.col("_entity"))).select(*columns, "_seen")
        rest = ring.join(reach, entity.eqNullSafe(F.col("_entity")), "left_anti")
        rest.unionByName(named).write.mode("overwrite").parquet(f"{history}/ring/batch={number}")

    return (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(write)
        .trigger(availableNow=True)
        .start()
    )
