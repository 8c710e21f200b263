"""Reports kept per month: a new month is measured alone, and the report of the whole table is merged from what is stored.

Everything stored can be merged: counts, sums, minima and maxima are exact, distinct values are HyperLogLog sketches of
2^SKETCH_BITS registers (a standard error of about 0.8 per cent at 14 bits; few hundred values or less are exact). A month
holds whole days, so distinct days add up exactly.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SKETCH_BITS = 14
_SKETCHED = (T.StringType, T.IntegerType, T.LongType, T.BinaryType)


def _next_month(first: date) -> date:
    return date(first.year + first.month // 12, first.month % 12 + 1, 1)


def _in_months(time: str, months: Iterable[date]) -> Column:
    """Ranges of times, which reach the scan's row-group statistics."""
    inside = F.lit(False)
    for m in months:
        first = m.replace(day=1)
        inside = inside | ((F.col(time) >= F.lit(first).cast("timestamp")) & (F.col(time) < F.lit(_next_month(first)).cast("timestamp")))
    return inside


def month_report(df: DataFrame, time: str, cols: Sequence[str]) -> DataFrame:
    """month (yyyy-MM, null for rows without a time), column, rows, nulls, days, first_day, last_day, and per column low,
    high, total (of numbers; null for others) and sketch (of texts and whole numbers; dates and doubles have none).

    All columns are measured in one aggregate per month. Sums are sums of doubles."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    numeric = {c for c in cols if isinstance(kinds[c], T.NumericType)}
    day = F.to_date(time)
    exprs: list[Column] = [F.count(F.lit(1)).alias("rows"), F.min("_day").alias("first_day"), F.max("_day").alias("last_day")]
    for i, c in enumerate(cols):
        exprs.append(F.count_if(F.col(f"`{c}`").isNull()).alias(f"{i}_nulls"))
        if c in numeric:
            value = F.col(f"`{c}`").cast("double")
            exprs += [F.min(value).alias(f"{i}_low"), F.max(value).alias(f"{i}_high"), F.sum(value).alias(f"{i}_total")]
        if isinstance(kinds[c], _SKETCHED):
            exprs.append(F.hll_sketch_agg(f"`{c}`", F.lit(SKETCH_BITS)).alias(f"{i}_sketch"))
    dated = df.select(*[F.col(f"`{c}`") for c in cols], F.date_format(time, "yyyy-MM").alias("_month"), day.alias("_day"))
    # Days are few: they are collapsed map-side and joined to the measures, one row per month.
    days = dated.groupBy("_month", "_day").agg(F.lit(1)).groupBy("_month").agg(F.count("_day").alias("days"))
    wide = dated.groupBy("_month").agg(*exprs).join(days.withColumnRenamed("_month", "_m"), F.col("_month").eqNullSafe(F.col("_m")))

    def cell(i: int, c: str) -> Column:
        has = lambda name, kind, there: (F.col(f"{i}_{name}") if there else F.lit(None).cast(kind)).alias(name)
        numbers = [has(n, "double", c in numeric) for n in ("low", "high", "total")]
        return F.struct(F.lit(c).alias("column"), F.col(f"{i}_nulls").alias("nulls"), *numbers, has("sketch", "binary", isinstance(kinds[c], _SKETCHED)))

    cells = F.inline(F.array(*[cell(i, c) for i, c in enumerate(cols)]))
    return wide.select(F.col("_month").alias("month"), "rows", "days", "first_day", "last_day", cells)


def store_report(df: DataFrame, path: str, time: str, cols: Sequence[str], months: Iterable[date] | None = None) -> None:
    """Measure ``months`` (any day of each; all if not given) and replace what is stored of them. Other months are neither
    read nor touched. A month without rows keeps what is stored."""
    if months is not None:
        df = df.filter(_in_months(time, months))
    report = month_report(df, time, cols)
    # A row per month and column: the shuffle by month keeps one file in each folder.
    out = report.repartition("month").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    out.partitionBy("month").parquet(path)


def stored_report(spark: SparkSession, path: str) -> DataFrame:
    schema = "rows long, days long, first_day date, last_day date, column string, nulls long, low double, high double, total double, sketch binary, month string"
    return spark.read.schema(schema).parquet(path)


def merged_profile(stored: DataFrame) -> DataFrame:
    """Per column over all stored months: rows, null_count, null_pct, min, max, mean and approx_distinct (null values not
    counted; null for columns without a sketch)."""
    known = F.sum(F.col("rows") - F.col("nulls"))
    return stored.groupBy("column").agg(
        F.sum("rows").alias("rows"),
        F.sum("nulls").alias("null_count"),
        F.round(F.try_divide(F.sum("nulls") * 100.0, F.sum("rows")), 2).alias("null_pct"),
        F.min("low").alias("min"),
        F.max("high").alias("max"),
        F.try_divide(F.sum("total"), known).alias("mean"),
        F.when(F.count("sketch") > 0, F.hll_sketch_estimate(F.hll_union_agg("sketch"))).alias("approx_distinct"),
    )


def merged_coverage(stored: DataFrame) -> DataFrame:
    """First and last date, distinct and expected days, and missing days, over all stored months."""
    months = stored.groupBy("month").agg(F.max("days").alias("days"), F.min("first_day").alias("low"), F.max("last_day").alias("high"))
    spans = months.agg(F.min("low").alias("min_date"), F.max("high").alias("max_date"), F.coalesce(F.sum("days"), F.lit(0)).alias("unique_dates"))
    expected = F.coalesce(F.datediff("max_date", "min_date") + 1, F.lit(0)).cast("long")
    return spans.withColumn("expected_days", expected).withColumn("missing_days", F.col("expected_days") - F.col("unique_dates"))
