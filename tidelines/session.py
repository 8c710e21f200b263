"""Session construction and shared scratch storage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL_SCRATCH: dict[str, str] = {}


def build_session(app: str = "tidelines", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators assume: UTC, AQE, skew-join splitting.

    ``master`` is only for local runs; on a cluster it comes from spark-submit.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.parquet.compression.codec", "snappy")
        # Wide feature tables generate methods the JVM would not compile; beyond this size Spark splits them.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings of the session for what runs within the block; afterwards they are what they were."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared ``spark.checkpoint.dir`` of the session.

    Every executor must see the folder, so the cluster's setting is used whenever there is one. Only a
    session without it (a local test) gets a temporary folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        if app not in _LOCAL_SCRATCH:
            _LOCAL_SCRATCH[app] = tempfile.mkdtemp(prefix="tidelines-")
        base = _LOCAL_SCRATCH[app]
    return f"{base.rstrip('/')}/tidelines/{purpose}-{uuid.uuid4().hex}"


def staged(df: DataFrame, purpose: str, per_file: int = 0) -> DataFrame:
    """Write ``df`` once to shared storage and read it back.

    Used where one expensive frame feeds several actions (fitting, splitting, writing): it is computed
    once, later reads are column-pruned, and a lost executor costs a re-read instead of a recompute.
    ``per_file`` bounds the rows of a file (0: no bound), for rows that are small in files and grow into many.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    df.write.option("maxRecordsPerFile", per_file).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
