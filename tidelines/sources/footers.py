"""What stored Parquet files hold, read from their footers alone, and losses by file.

A look reads the last bytes of a file and its footer, whatever the size of the file; what comes back is one short row
per file. Row groups can then be read one by one from tasks, for folders that mix what several loaders stored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelines.sources.files import has_files, map_files, open_uri, ranged

LOSSES = "file_path string, reason string, documents long"


class LostData(RuntimeError):
    """Files or documents that a job could not read."""


def _kind(kind: pa.DataType | None) -> str | None:
    if kind is None:
        return None
    if pa.types.is_timestamp(kind):
        return ("timestamp" if kind.tz else "timestamp_ntz") + ("_nanos" if kind.unit == "ns" else "")
    return "string" if pa.types.is_string(kind) or pa.types.is_large_string(kind) else str(kind)


def parquet_types(spark: SparkSession, path: str, columns: list[str], glob: str = "*.parquet") -> DataFrame:
    """file_path, folder, ``error`` (null for sound files), the number of row ``groups`` and the physical kind of each of
    ``columns``."""

    def run(name: str, file: pa.NativeFile) -> Iterator[pa.RecordBatch]:
        error, found, groups = None, {}, 0
        try:
            stored = pq.ParquetFile(file)
            schema, groups = stored.schema_arrow, stored.num_row_groups
            leaves = [stored.schema.column(k) for k in range(len(stored.schema))]
            old = {c.path for c in leaves if c.physical_type == "INT96"}  # Spark's own form of a time in UTC
            found = {c: "timestamp" if c in old else _kind(schema.field(c).type) for c in columns if c in schema.names}
        except (pa.ArrowInvalid, OSError) as e:
            error = str(e)[:200]
        texts = [pa.array([v], pa.string()) for v in [name, error, *(found.get(c) for c in columns)]]
        yield pa.RecordBatch.from_arrays([*texts, pa.array([groups], pa.int32())], names=["file_path", "error", *columns, "groups"])

    fields = [T.StructField(c, T.StringType()) for c in ["file_path", "error", *columns]]
    schema = T.StructType([*fields, T.StructField("groups", T.IntegerType())])
    kinds = map_files(spark, path, glob, run, schema)
    return kinds.withColumn("folder", F.regexp_replace("file_path", "/[^/]*$", ""))


_ARROW = {
    T.StringType: pa.string(),
    T.DoubleType: pa.float64(),
    T.LongType: pa.int64(),
    T.TimestampType: pa.timestamp("us", tz="UTC"),
    T.TimestampNTZType: pa.timestamp("us"),
}


def _as(column: pa.Array, kind: T.DataType) -> pa.Array:
    want = _ARROW[type(kind)]
    if pa.types.is_timestamp(column.type):
        if pa.types.is_int64(want):
            return column.view(pa.int64())  # nanoseconds, which the reader turns into times
        if pa.types.is_timestamp(want):
            return column.cast(pa.timestamp("us", tz=column.type.tz), safe=False).cast(pa.int64()).cast(want)
    return column.cast(want)


def read_row_groups(files: DataFrame, schema: T.StructType) -> DataFrame:
    """file_path and the columns of ``schema`` of Parquet files (file_path, groups), null where a file lacks one.

    Each row group is a unit of work of its own, dealt out over all tasks, so one large file does not wait for one task,
    and no list of files passes through the driver.
    """
    wanted = [(f.name, f.dataType) for f in schema.fields]
    units = files.filter("groups > 0").select("file_path", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("number"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, number in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with open_uri(name) as file:
                    stored = pq.ParquetFile(file, coerce_int96_timestamp_unit="us")
                    have = [c for c, _ in wanted if c in stored.schema_arrow.names]
                    for part in stored.iter_batches(8192, [number], have):
                        columns = [_as(part.column(c), k) if c in have else pa.nulls(part.num_rows, _ARROW[type(k)]) for c, k in wanted]
                        names = pa.array([name] * part.num_rows, pa.string())
                        yield pa.RecordBatch.from_arrays([names, *columns], names=["file_path", *(c for c, _ in wanted)])

    out = T.StructType([T.StructField("file_path", T.StringType()), *schema.fields])
    return units.repartition("file_path", "number").mapInArrow(run, out)


def accept(losses: DataFrame, report: str | None) -> bool:
    """Write a report of losses, or raise an error that names some of them. False if there are none."""
    if report is not None:
        losses.write.mode("append").parquet(report)
        return not losses.sparkSession.read.schema(LOSSES).parquet(report).isEmpty()
    some = losses.limit(5).collect()
    if some:
        named = "; ".join(f"{r['file_path']}: {r['reason']}" for r in some)
        raise LostData(f"{losses.count()} losses, for example {named}. Give a report path to go on without them.")
    return False


__all__ = ["LOSSES", "LostData", "accept", "has_files", "parquet_types", "ranged", "read_row_groups"]
