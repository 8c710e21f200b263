"""Helpers shared by the text operators: reading columns, cutting Arrow batches, staging and hash keys."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 2 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """doc_id and text alone, so that no other column of the input can clash; a null text is the empty one."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))


def slices(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into pieces of about SLICE_BYTES of ``column`` (one row at least), which bounds memory."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.binary_length(batch.column(column)).to_pylist()
        start, held = 0, 0
        for i, size in enumerate(sizes):
            if held and held + (size or 0) > SLICE_BYTES:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size or 0
        yield batch.slice(start)


def map_slices(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str, column: str = "text") -> DataFrame:
    """mapInArrow over bounded slices. ``make`` runs once in each task and returns the function of a slice."""

    def run(batches):
        step = make()
        for part in slices(batches, column):
            yield step(part)

    return df.mapInArrow(run, schema)


def staged(df: DataFrame, name: str, rows_per_file: int = 0) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage with files that outlive an executor.
    ``rows_per_file``, unless 0, is the most that a file holds.

    Shuffle files of the job that wrote it are no longer needed; Spark drops them when the driver collects garbage,
    which a driver with little to do would put off for long."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.option("maxRecordsPerFile", rows_per_file).parquet(path)
    del df
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(schema).parquet(path)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it; a local session without it gets one of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    import tempfile

    folder = tempfile.mkdtemp(prefix="tidelines-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def keep_rows(docs: DataFrame, make: Callable[[], Callable[[list[str]], list[bool]]]) -> DataFrame:
    """The rows of ``docs``, all columns, whose texts a function keeps; nothing is shuffled."""

    def run(batches):
        keep = make()
        for part in slices(batches):
            wanted = keep([t or "" for t in part.column("text").to_pylist()])
            yield part.filter(pa.array(wanted, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def whole_rows(docs: DataFrame) -> DataFrame:
    """row (all columns of ``docs``), id and own (the digest of the text, a null as the empty one), whose names no
    column of ``docs`` can clash with."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return docs.select(row, F.col("doc_id").alias("id"), F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("own"))
