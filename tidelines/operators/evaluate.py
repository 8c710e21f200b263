"""Forecast evaluation: persistence baseline, error metrics and their breakdowns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelines.functions.calendar import season
from tidelines.operators.windows import add_features, lags, leads
from tidelines.panel import Panel


def persistence_forecast(df: DataFrame, panel: Panel, target: str, horizons: Sequence[int]) -> DataFrame:
    """Long frame of actual and predicted values: every horizon is predicted by the previous row's value.

    Lag and leads share one window; the horizons are unpivoted from the same row, without a join.
    """
    features = [lags([target], [1], "_predicted"), leads([target], horizons, "_actual_{k}")]
    wide = add_features(df, panel, *features)
    cells = F.array(
        *[F.struct(F.lit(h).alias("horizon"), F.col(f"_actual_{h}").alias("actual")) for h in horizons]
    )
    return (
        wide.select(*df.columns, F.col("_predicted").alias("predicted"), F.inline(cells))
        .filter(F.col("predicted").isNotNull() & F.col("actual").isNotNull())
        .withColumn("model", F.lit("persistence"))
    )


def error_metrics(
    df: DataFrame, by: Sequence[str] = ("model", "horizon"), mae_weight: float = 0.7, rmse_weight: float = 0.3
) -> DataFrame:
    """MAE, RMSE, bias, R2 and the weighted loss per group, from sums of one aggregate."""
    error = F.col("predicted") - F.col("actual")
    base = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(error).alias("bias"),
        F.sum(error * error).alias("_sse"),
        (F.var_pop("actual") * F.count(F.lit(1))).alias("_sst"),
    )
    return base.select(
        *by,
        "n",
        "mae",
        "rmse",
        "bias",
        (1 - F.try_divide("_sse", "_sst")).alias("r2"),
        (F.col("mae") * mae_weight + F.col("rmse") * rmse_weight).alias("loss"),
    )


def value_band(value: Column, edges: Sequence[float]) -> Column:
    """Index of the band a value falls in: 0 below the first edge, one more per edge reached."""
    band = F.lit(0)
    for edge in edges:
        band = band + (value >= edge).cast("int")
    return band


def banded_metrics(df: DataFrame, edges: Sequence[float], by: Sequence[str] = ("model", "horizon")) -> DataFrame:
    """Error metrics per band of the actual value; the last band holds the extreme rows."""
    return error_metrics(df.withColumn("band", value_band(F.col("actual"), edges)), [*by, "band"])


def seasonal_metrics(df: DataFrame, time: str, by: Sequence[str] = ("model", "horizon")) -> DataFrame:
    """Error metrics per meteorological season."""
    return error_metrics(df.withColumn("season", season(F.col(time))), [*by, "season"])
