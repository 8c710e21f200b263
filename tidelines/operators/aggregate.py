"""Coarser time steps, per-entity statistics and the numbers behind the documented charts.

Everything is a partial-then-final aggregate, so large groups are combined before the shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelines.functions.wind import wind_direction
from tidelines.operators.rank import rows_at_ranks
from tidelines.operators.windows import RowFeatures, add_features, lags
from tidelines.panel import Panel, count_not_above
from tidelines.session import staged

# Pollutant columns and their daily names.
POLLUTANTS = ["pm2_5_ugm3", "pm10_ugm3", "no2_ugm3", "o3_ugm3", "so2_ugm3", "co_ugm3"]
POLLUTANT_MEANS = ["pm2_5_mean", "pm10_mean", "no2_mean", "o3_mean", "so2_mean", "co_mean"]


# Value ranges of grouped quantiles that may be broadcast (a few dozen bytes each).
MAX_BROADCAST_RANGES = 100_000
# Cells of equal width, and of equal row numbers, that one pass of a quantile search cuts a range into.
CELLS = 1024
SKETCH_CELLS = 64
# Rows of one value range that may be put in order in one place.
MAX_ORDERED = 50_000


def _date(time: str, shift_hours: float) -> Column:
    at = F.col(time)
    if shift_hours:
        at = F.timestamp_micros(F.unix_micros(at.cast("timestamp")) + F.lit(int(shift_hours * 3_600_000_000)))
    return F.to_date(at).alias("date")


def _earliest(cols: Sequence[str], time: str, ties: Sequence[str]) -> Column:
    """Values of the earliest row, compared once for all columns."""
    return F.min_by(F.struct(*cols), F.struct(F.col(time), *[F.col(t) for t in ties])).alias("_earliest")


def daily_weather(
    df: DataFrame,
    entity: str = "stationID",
    time: str = "timestamp_utc",
    ties: Sequence[str] = ("record_hash",),
    shift_hours: float = 0,
    wind_mean: str = "degrees",
) -> DataFrame:
    """Daily weather per entity.

    ``first`` values are those of the earliest row. ``wind_mean="vector"`` averages the wind as a vector
    instead of averaging degrees; ``shift_hours`` moves the day boundary.
    """
    ties = [t for t in ties if t in df.columns]
    direction = F.avg("wind_dir_deg")
    if wind_mean == "vector":
        angle = F.radians("wind_dir_deg")
        u, v = F.avg(-F.col("wind_ms") * F.sin(angle)), F.avg(-F.col("wind_ms") * F.cos(angle))
        direction = wind_direction(u, v)
    days = df.groupBy(_date(time, shift_hours), entity).agg(
        _earliest(["lat", "lon", "load_id"], time, ties),
        F.avg("temp_c").alias("temp_2m_mean"),
        F.min("temp_c").alias("temp_2m_min"),
        F.max("temp_c").alias("temp_2m_max"),
        F.avg("humidity_pct").alias("rh_2m_mean"),
        F.avg("pressure_hpa").alias("pressure_mean"),
        # A day without any reading sums to 0, as the rest of the daily table expects.
        F.coalesce(F.sum("precipitation_mm"), F.lit(0.0)).alias("precip_sum"),
        F.avg("wind_ms").alias("wind_speed_mean"),
        direction.alias("wind_direction_mean"),
        F.avg("shortwave_radiation_wm2").alias("radiation_mean"),
        F.avg("cloud_cover_pct").alias("cloud_cover_mean"),
    )
    values = [c for c in days.columns if c not in ("date", entity, "_earliest")]
    return days.select("date", entity, "_earliest.lat", "_earliest.lon", *values, "_earliest.load_id")


def daily_air_quality(
    df: DataFrame,
    entity: str = "stationID",
    time: str = "timestamp_utc",
    ties: Sequence[str] = ("record_hash",),
    shift_hours: float = 0,
) -> DataFrame:
    """Daily pollutant means per entity."""
    ties = [t for t in ties if t in df.columns]
    days = df.groupBy(_date(time, shift_hours), entity).agg(
        _earliest(["lat", "lon"], time, ties),
        *[F.avg(c).alias(out) for c, out in zip(POLLUTANTS, POLLUTANT_MEANS)],
    )
    return days.select("date", entity, "_earliest.lat", "_earliest.lon", *POLLUTANT_MEANS)


def station_aggregates(df: DataFrame, entity: str = "stationID", train_only: str | None = None) -> DataFrame:
    """Long-run level per entity; ``train_only`` names a split column to restrict the fit to its train rows."""
    if train_only is not None:
        df = df.filter(F.col(train_only) == "train")
    return df.groupBy(entity).agg(
        F.avg("pm2_5_ugm3").alias("station_pm25_mean"),
        F.stddev_samp("pm2_5_ugm3").alias("station_pm25_std"),
        F.avg("pm10_ugm3").alias("station_pm10_mean"),
    )


def yearly_counts(df: DataFrame, time: str) -> DataFrame:
    return df.groupBy(F.year(time).alias("year")).agg(F.count(F.lit(1)).alias("rows"))


def global_summary(df: DataFrame, col: str) -> DataFrame:
    """Mean, std, min, max, null count and null percentage of one column."""
    nulls = F.count_if(F.col(col).isNull())
    return df.agg(
        F.avg(col).alias("mean"),
        F.stddev_samp(col).alias("std"),
        F.min(col).alias("min"),
        F.max(col).alias("max"),
        nulls.alias("null_count"),
        F.try_divide(nulls * 100, F.count(F.lit(1))).alias("null_pct"),
    )


def distinct_counts(df: DataFrame, cols: Iterable[str], approximate: bool = False) -> DataFrame:
    """Distinct values per column; null counts as one value."""
    exprs = []
    for c in cols:
        base = F.approx_count_distinct(c) if approximate else F.countDistinct(c)
        exprs.append((base + F.coalesce(F.max(F.col(c).isNull().cast("int")), F.lit(0))).alias(f"n_{c}"))
    return df.agg(*exprs)


def monthly_average(df: DataFrame, col: str, time: str, entity: str) -> DataFrame:
    return df.groupBy(F.year(time).alias("year"), F.month(time).alias("month")).agg(
        F.avg(col).alias("mean"), F.stddev_samp(col).alias("std"), F.countDistinct(entity).alias("stations")
    )


def station_ranking(df: DataFrame, col: str, entity: str) -> DataFrame:
    """Entities by descending mean."""
    stats = df.groupBy(entity).agg(F.avg(col).alias("mean"), F.max(col).alias("max"))
    return stats.orderBy(F.col("mean").desc(), entity)


def top_entities(df: DataFrame, col: str, entity: str, k: int) -> DataFrame:
    """The first ``k`` of the ranking: a top-k report, without a full sort."""
    return station_ranking(df, col, entity).limit(k)


def seasonal_profile(df: DataFrame, col: str, time: str) -> DataFrame:
    """Mean and one standard deviation either side, per calendar month."""
    mean, std = F.avg(col), F.stddev_samp(col)
    return df.groupBy(F.month(time).alias("month")).agg(
        mean.alias("mean"), (mean - std).alias("lower"), (mean + std).alias("upper")
    )


def year_over_year(df: DataFrame, col: str, time: str) -> DataFrame:
    """One row per year, one column per month."""
    keyed = df.select(F.year(time).alias("year"), F.month(time).alias("month"), F.col(col))
    return keyed.groupBy("year").pivot("month", list(range(1, 13))).agg(F.avg(col))


def _corr(a: str, b: str, over: str = "") -> str:
    """Correlation of the pairs without nulls; unlike ``corr`` it is null, not an error, without spread."""
    x = f"CASE WHEN `{b}` IS NOT NULL THEN `{a}` END"
    y = f"CASE WHEN `{a}` IS NOT NULL THEN `{b}` END"
    return f"try_divide(covar_pop({x}, {y}){over}, stddev_pop({x}){over} * stddev_pop({y}){over})"


def correlations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every column pair in long form, from a single pass.

    A column without spread has no correlation (null).
    """
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    wide = df.selectExpr(*[f"{_corr(a, b)} AS `{i}`" for i, (a, b) in enumerate(pairs)])
    cells = F.array(
        *[
            F.struct(F.lit(a).alias("left"), F.lit(b).alias("right"), F.col(f"{i}").alias("corr"))
            for i, (a, b) in enumerate(pairs)
        ]
    )
    return wide.select(F.inline(cells))


def lag_correlations(df: DataFrame, panel: Panel, target: str, col: str, steps: Sequence[int]) -> DataFrame:
    """Correlation of the target with a column some rows earlier."""
    lagged = add_features(df, panel, lags([col], steps, "_lag_{k}"))
    wide = lagged.selectExpr(*[f"{_corr(target, f'_lag_{k}')} AS `{k}`" for k in steps])
    return wide.select(
        F.inline(F.array(*[F.struct(F.lit(k).alias("lag"), F.col(f"{k}").alias("corr")) for k in steps]))
    )


def rolling_correlation(
    df: DataFrame, panel: Panel, left: str, right: str, window: int, name: str = "rolling_corr"
) -> DataFrame:
    """Correlation over the last ``window`` rows of an entity, null until the frame is full of pairs."""
    over = f" OVER ({{w}} ROWS BETWEEN {window - 1} PRECEDING AND CURRENT ROW)"
    text = f"CASE WHEN count(`{left}` + `{right}`){over} = {window} THEN {_corr(left, right, over)} END"
    return add_features(df, panel, RowFeatures((((name, text),),), (name,), back=window - 1))


def histogram(df: DataFrame, col: str, lo: float, hi: float, bins: int) -> DataFrame:
    """Equal-width counts in [lo, hi); bins 0 and bins+1 hold what lies outside."""
    bucket = F.width_bucket(F.col(col), F.lit(float(lo)), F.lit(float(hi)), F.lit(bins))
    return df.filter(F.col(col).isNotNull()).groupBy(bucket.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def wind_rose(df: DataFrame, speed: str, direction: str, sectors: int = 16) -> DataFrame:
    """Count and mean speed per direction sector, sector 0 centred on north."""
    width = 360.0 / sectors
    sector = F.pmod(F.floor((F.col(direction) + width / 2) / width), F.lit(sectors)).cast("int")
    return (
        df.filter(F.col(direction).isNotNull())
        .groupBy(sector.alias("sector"))
        .agg(F.count(F.lit(1)).alias("n"), F.avg(speed).alias("mean_speed"))
    )


def monthly_wind_vector(df: DataFrame, u: str, v: str, time: str) -> DataFrame:
    return df.groupBy(F.year(time).alias("year"), F.month(time).alias("month")).agg(
        F.avg(u).alias("mean_u"), F.avg(v).alias("mean_v")
    )


def global_quantiles(df: DataFrame, col: str, probs: Sequence[float]) -> DataFrame:
    """Exact interpolated quantiles of the whole table, as rows (prob, value), null for an empty table.

    The order statistics on both sides of each quantile are found by counting (rows_at_ranks).
    """
    data = df.filter(F.col(col).isNotNull()).select(F.col(col).cast("double").alias("x"))

    def neighbours(total: int) -> list[int]:
        at = [p * (total - 1) for p in probs]
        return [r + 1 for a in at for r in (math.floor(a), math.ceil(a))]

    total, rows = rows_at_ranks(data, ["x"], neighbours)
    out = []
    for i, p in enumerate(probs):
        low, high = rows[2 * i], rows[2 * i + 1]
        part = p * (total - 1) % 1
        out.append((float(p), low.x + (high.x - low.x) * part if low is not None and high is not None else None))
    return df.sparkSession.createDataFrame(out, "prob double, value double")


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float], by: Sequence[str]) -> DataFrame:
    """Exact interpolated quantiles per group, as rows (by..., prob, value).

    Counting passes narrow the value range that holds each wanted order statistic, until every range has at most
    MAX_ORDERED rows or a single value; only then are the values inside put in order. Passes by cells of equal width
    take turns with passes by cells of about equal row numbers, whose borders come from a mergeable quantile sketch and
    whose rows are counted exactly; so neither far outliers nor repeated values keep a range large. No group's values
    are gathered in one place, whatever its share of the rows.
    """
    by = list(by)
    group = F.struct(*[F.col(c) for c in by])
    data = df.filter(F.col(col).isNotNull()).select(group.alias("g"), F.col(col).cast("double").alias("x"))
    bounds = staged(
        data.groupBy("g").agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.count(F.lit(1)).alias("n")), "quantiles"
    )
    # With few groups the value ranges are broadcast, so the rows themselves are never shuffled; with many
    # they are joined on the group, and AQE splits a group that is too large for one task.
    small = bounds.count() * len(probs) <= MAX_BROADCAST_RANGES
    ranks = F.array(*[F.lit(float(p)) for p in probs])
    position = F.col("prob") * (F.col("n") - 1)
    # ``wanted``: per group and rank, the value range that holds it, the rows in and below the range, and the passes
    # that have left it as it was. One pass of either kind without effect ends the search: what is left is ordered.
    wanted = bounds.select("g", "lo", "hi", "n", F.explode(ranks).alias("prob")).select(
        "g", "lo", "hi", F.explode(F.array(F.floor(position), F.ceil(position))).alias("rank"), F.col("n").alias("rows")
    ).distinct().selectExpr("*", "0L AS base", "0 AS idle")
    large = (F.col("lo") < F.col("hi")) & (F.col("rows") > MAX_ORDERED) & (F.col("idle") < 2)
    by_width = True
    while not wanted.filter(large).isEmpty():
        narrowed = _narrowed(data, wanted.filter(large), small, by_width)
        # A few rows per group; stored, so that the next pass does not repeat this one's scan.
        wanted = staged(narrowed.unionByName(wanted.filter(~large)), "quantiles")
        by_width = not by_width
    spans = wanted.select("g", "lo", "hi").distinct()
    values = _within_spans(data, spans, small).groupBy("g", F.col("lo").alias("span"), "x").agg(
        F.count(F.lit(1)).alias("rows")
    )
    below = Window.partitionBy("g", "span").orderBy("x").rowsBetween(Window.unboundedPreceding, -1)
    values = values.withColumn("before", F.coalesce(F.sum("rows").over(below), F.lit(0)))
    inside = F.col("w.rank") - F.col("w.base")
    stats = (
        wanted.alias("w")
        .join(
            values.alias("v"),
            F.col("w.g").eqNullSafe(F.col("v.g"))
            & (F.col("w.lo") == F.col("v.span"))
            & (inside >= F.col("v.before"))
            & (inside < F.col("v.before") + F.col("v.rows")),
        )
        .select("w.g", "w.rank", "v.x")
    )
    points = bounds.select(F.col("g").alias("group"), "n", F.explode(ranks).alias("prob"))
    located = points.join(
        stats, F.col("group").eqNullSafe(F.col("g")) & F.col("rank").isin(F.floor(position), F.ceil(position))
    )
    low, high = F.min_by("x", "rank"), F.max_by("x", "rank")
    part = F.first(position - F.floor(position))
    out = located.groupBy("group", "prob").agg((low + (high - low) * part).alias("value"))
    return out.select(*[F.col("group")[c].alias(c) for c in by], "prob", "value")


def _narrowed(data: DataFrame, wanted: DataFrame, small: bool, by_width: bool) -> DataFrame:
    """``wanted`` with each range replaced by the cell of it that holds the rank."""
    inside = _within_spans(data, wanted.select("g", "lo", "hi").distinct(), small)
    x, lo = F.col("x"), F.col("lo")
    if by_width:
        width = (F.col("hi") - lo) / CELLS
        # Widths beyond doubles, or without a value, give one cell.
        cell = F.coalesce(F.least(F.floor(F.try_divide(x - lo, width)), F.lit(CELLS - 1)), F.lit(0))
    else:
        shares = [k / SKETCH_CELLS for k in range(SKETCH_CELLS + 1)]
        sketch = F.percentile_approx("x", shares, 20 * SKETCH_CELLS)
        borders = inside.groupBy("g", F.col("lo").alias("span")).agg(F.array_sort(sketch).alias("borders"))
        borders = F.broadcast(borders) if small else borders
        inside = inside.withColumnRenamed("g", "_g").join(borders, F.col("_g").eqNullSafe(F.col("g")) & (lo == F.col("span"))).drop("_g", "span")
        below = count_not_above(F.col("borders"), x, (SKETCH_CELLS + 1).bit_length())
        # Values equal to a border have a cell of their own: it needs no further pass, however many they are.
        beyond = (x > F.coalesce(F.get("borders", below - 1), x)).cast("long")
        cell = below.cast("long") * 2 + beyond
    counts = inside.groupBy("g", lo.alias("span"), cell.alias("cell")).agg(
        F.count(F.lit(1)).alias("cell_rows"), F.min("x").alias("cell_lo"), F.max("x").alias("cell_hi")
    )
    order = Window.partitionBy("g", "span").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("before", F.coalesce(F.sum("cell_rows").over(order), F.lit(0)))
    first = F.col("w.base") + F.col("c.before")
    hit = (F.col("w.rank") >= first) & (F.col("w.rank") < first + F.col("c.cell_rows"))
    return (
        wanted.alias("w")
        .join(counts.alias("c"), F.col("w.g").eqNullSafe(F.col("c.g")) & (F.col("w.lo") == F.col("c.span")) & hit)
        .select(
            "w.g",
            F.col("c.cell_lo").alias("lo"),
            F.col("c.cell_hi").alias("hi"),
            "w.rank",
            F.col("c.cell_rows").alias("rows"),
            first.alias("base"),
            F.when(F.col("c.cell_rows") < F.col("w.rows"), 0).otherwise(F.col("w.idle") + 1).alias("idle"),
        )
    )


def _within_spans(data: DataFrame, spans: DataFrame, small: bool) -> DataFrame:
    """Rows that fall in one of their group's value ranges; ranges of a group never overlap."""
    s = spans.select(F.col("g").alias("_g"), "lo", "hi")
    on = F.col("g").eqNullSafe(F.col("_g")) & F.col("x").between(F.col("lo"), F.col("hi"))
    return data.join(F.broadcast(s) if small else s, on).drop("_g")
