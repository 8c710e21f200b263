"""File inventory and checksums of a layer."""

from __future__ import annotations

import re
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelines.sources.files import digests, list_files

def layer_inventory(spark: SparkSession, layers: Mapping[str, str], glob: str = "*") -> DataFrame:
    """Per layer: existence, files, bytes and folders that hold files."""
    names = spark.createDataFrame([(n,) for n in layers], "layer string")
    tagged = [list_files(spark, p, glob).withColumn("layer", F.lit(n)) for n, p in layers.items()]
    files = reduce(DataFrame.unionByName, tagged)
    folder = F.regexp_replace("path", "/[^/]*$", "")
    sums = files.groupBy("layer").agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), F.countDistinct(folder).alias("folders")
    )
    zero = F.lit(0).cast("bigint")
    return names.join(sums, "layer", "left").select(
        "layer",
        F.col("files").isNotNull().alias("exists"),
        F.coalesce("files", zero).alias("files"),
        F.coalesce("bytes", zero).alias("bytes"),
        F.coalesce("folders", zero).alias("folders"),
    )


def _relative(file_path: Column, root: str) -> Column:
    """Path of a file below the layer's folder; names alone repeat across partitions."""
    folder = re.sub(r"^[a-z0-9]+:(//[^/]*)?", "", root).rstrip("/")
    return F.regexp_extract(file_path, rf"\Q{folder}\E/+(.*)$", 1)


def checksums(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    """md5 per file, of any size: a task reads its files a block at a time."""
    return digests(spark, path, glob).select(_relative(F.col("path"), path).alias("name"), "md5")


def write_checksums(spark: SparkSession, path: str, target: str) -> None:
    """Checksum lines ``hash  name`` of a layer, as text."""
    lines = checksums(spark, path).select(F.concat_ws("  ", "md5", "name").alias("value"))
    lines.write.mode("overwrite").text(target)


def _lines(text: DataFrame) -> DataFrame:
    parts = F.split("value", r"\s+", 2)
    return text.filter(F.length(F.trim("value")) > 0).withColumns({"md5": parts[0], "name": F.trim(parts[1])})


def read_checksums(spark: SparkSession, path: str) -> DataFrame:
    """A checksum table written by ``write_checksums``."""
    return _lines(spark.read.text(path)).select("name", "md5")


def read_sidecars(spark: SparkSession, path: str, glob: str = "*.md5") -> DataFrame:
    """Checksums stored next to the files they belong to."""
    text = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob).text(path)
    located = _lines(text.select("value", _relative(F.col("_metadata.file_path"), path).alias("side")))
    folder = F.regexp_replace("side", "[^/]*$", "")
    return located.select(F.concat(folder, "name").alias("name"), "md5")


def verify_checksums(spark: SparkSession, path: str, recorded: DataFrame) -> DataFrame:
    """Per file: ok, mismatch, unrecorded (no checksum) or missing (no file)."""
    actual, wanted = checksums(spark, path).alias("a"), recorded.alias("r")
    joined = actual.join(wanted, F.col("a.name") == F.col("r.name"), "full")
    status = (
        F.when(F.col("r.md5").isNull(), "unrecorded")
        .when(F.col("a.md5").isNull(), "missing")
        .when(F.col("a.md5") == F.col("r.md5"), "ok")
        .otherwise("mismatch")
    )
    return joined.select(F.coalesce("a.name", "r.name").alias("name"), status.alias("status"))
