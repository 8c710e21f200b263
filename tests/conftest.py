from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidelines import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tidelines-tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.python.sql.dataFrameDebugging.enabled": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture
def series(spark):
    """A one-station panel from a list of values, one row per hour."""
    from pyspark.sql import functions as F

    def build(values, station="a", start="2024-01-01 00:00:00"):
        rows = [(station, i, None if v is None else float(v)) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, "stationID string, i int, x double")
        at = F.lit(start).cast("timestamp") + F.make_dt_interval(hours=F.col("i"))
        return df.withColumn("timestamp_utc", at)

    return build


def column(df, name, order="i"):
    return [r[name] for r in df.orderBy(order).collect()]
