"""Column profiles, coverage, rule checks and schema presence; each one is a single pass."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NUMERIC = (T.DoubleType, T.FloatType, T.LongType, T.IntegerType)


def _stacked(wide: DataFrame, rows: Iterable[Column]) -> DataFrame:
    return wide.select(F.inline(F.array(*rows)))


def column_profile(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per column: type, null count and percentage, and min/max/mean of numeric columns.

    All columns are measured in one aggregate; the one-row result (one per group with ``by``) is then
    turned into long form.
    """
    fields = [f for f in df.schema.fields if f.name not in by]
    exprs: list[Column] = [F.count(F.lit(1)).alias("_rows")]
    for i, f in enumerate(fields):
        exprs.append(F.count_if(F.col(f.name).isNull()).alias(f"{i}_nulls"))
        if isinstance(f.dataType, _NUMERIC):
            value = F.col(f.name).cast("double")
            # Sums of large integers (epoch times) leave the exact range of a double.
            whole = isinstance(f.dataType, (T.LongType, T.IntegerType))
            mean = F.avg(F.col(f.name).cast("decimal(26,6)") if whole else value).cast("double")
            exprs += [F.min(value).alias(f"{i}_min"), F.max(value).alias(f"{i}_max"), mean.alias(f"{i}_mean")]
    wide = df.groupBy(*by).agg(*exprs)
    missing = F.lit(None).cast("double")

    def row(i: int, f: T.StructField) -> Column:
        numeric = isinstance(f.dataType, _NUMERIC)
        pct = F.coalesce(F.try_divide(F.col(f"{i}_nulls") * 100.0, F.col("_rows")), F.lit(0.0))
        return F.struct(
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("dtype"),
            F.col(f"{i}_nulls").alias("null_count"),
            F.round(pct, 2).alias("null_pct"),
            (F.col(f"{i}_min") if numeric else missing).alias("min"),
            (F.col(f"{i}_max") if numeric else missing).alias("max"),
            (F.col(f"{i}_mean") if numeric else missing).alias("mean"),
        )

    cells = F.array(*[row(i, f) for i, f in enumerate(fields)])
    return wide.select(*by, F.inline(cells))


def date_column(df: DataFrame) -> Column:
    """The date of a row: ``date``, else the day of ``timestamp_utc`` or ``timestamp``."""
    for name in ("date", "timestamp_utc", "timestamp"):
        if name in df.columns:
            return F.to_date(name)
    raise ValueError(f"no column tells the date of a row: {df.columns}")


def temporal_coverage(df: DataFrame) -> DataFrame:
    """First and last date, distinct and expected days, missing days and coverage in percent."""
    # Distinct days are few, so they are collapsed map-side before the single-row aggregate.
    days = df.select(date_column(df).alias("date")).groupBy("date").count()
    unique = F.count("date") + F.max(F.col("date").isNull().cast("int"))
    spans = days.agg(F.min("date").alias("min_date"), F.max("date").alias("max_date"), unique.alias("unique_dates"))
    expected = F.coalesce(F.datediff("max_date", "min_date") + 1, F.lit(0))
    return spans.withColumn("expected_days", expected).select(
        "min_date",
        "max_date",
        "unique_dates",
        "expected_days",
        F.when(F.col("expected_days") > 0, F.col("expected_days") - F.col("unique_dates"))
        .otherwise(0)
        .alias("missing_days"),
        F.round(
            F.coalesce(F.try_divide(F.col("unique_dates") * 100.0, F.col("expected_days")), F.lit(0.0)), 2
        ).alias("coverage_pct"),
    )


def training_span(df: DataFrame, split: str, date: str, min_days: int = 5 * 365) -> DataFrame:
    """Days covered by the train rows, and whether they reach the required span (five years)."""
    days = F.datediff(F.max(date), F.min(date)) + 1
    return df.filter(F.col(split) == "train").agg(days.alias("days"), (days >= min_days).alias("sufficient"))


def station_coverage(df: DataFrame, entity: str | None = None) -> DataFrame:
    """Distinct entities, rows and whole rows per entity."""
    if entity is None:
        entity = next(c for c in ("stationID", "station_id") if c in df.columns)
    per = df.groupBy(entity).agg(F.count(F.lit(1)).alias("n"))
    total = per.agg(F.count(F.lit(1)).alias("unique_stations"), F.coalesce(F.sum("n"), F.lit(0)).alias("total_records"))
    average = F.coalesce(F.floor(F.try_divide("total_records", "unique_stations")), F.lit(0))
    return total.withColumn("avg_records_per_station", average)


def entity_spans(df: DataFrame, entity: str, time: str) -> DataFrame:
    """First and last time and row count per entity (data of a coverage chart)."""
    return df.groupBy(entity).agg(
        F.min(time).alias("first_seen"), F.max(time).alias("last_seen"), F.count(F.lit(1)).alias("rows")
    )


def coverage_intervals(df: DataFrame, entity: str, time: str, max_gap: str = "1 hour", slice_unit: str = "month") -> DataFrame:
    """The unbroken spans of each entity: started, ended, rows, times, and the seconds until the next one (null for the
    last). A span goes on as long as the step to the next time is at most ``max_gap``.

    Equal times are counted together first, then spans are found within slices of time (``slice_unit``), so that a
    large entity is divided over tasks; only the spans, not the rows, are put together across slices. Rows without a
    time are left out; a null entity is one of its own.
    """
    at = F.col(time).cast("timestamp")
    seen = df.filter(at.isNotNull()).groupBy(F.col(entity).alias("_entity"), at.alias("_at")).agg(F.count(F.lit(1)).alias("_n"))
    # A session ends its gap after its last event, which is no longer part of it; one microsecond makes "at most".
    session = F.session_window("_at", f"{max_gap} 1 microsecond")
    parts = seen.groupBy(session, F.col("_entity"), F.date_trunc(slice_unit, "_at").alias("_slice")).agg(
        F.min("_at").alias("_from"), F.max("_at").alias("_to"), F.sum("_n").alias("_rows"), F.count(F.lit(1)).alias("_times")
    )
    order = Window.partitionBy("_entity").orderBy("_from")
    apart = F.col("_from") > F.lag("_to").over(order) + F.expr(f"INTERVAL {max_gap}")
    numbered = parts.withColumn("_new", F.coalesce(apart, F.lit(True)).cast("int")).withColumn("_no", F.sum("_new").over(order))
    spans = numbered.groupBy("_entity", "_no").agg(
        F.min("_from").alias("started"), F.max("_to").alias("ended"), F.sum("_rows").alias("rows"), F.sum("_times").alias("times")
    )
    following = F.lead("started").over(Window.partitionBy("_entity").orderBy("started"))
    gap = (F.unix_micros(following) - F.unix_micros("ended")) / 1_000_000
    return spans.select(F.col("_entity").alias(entity), "started", "ended", "rows", "times", gap.alias("gap_seconds"))


def split_inspection(df: DataFrame, split: str, date: str, entity: str, target: str) -> DataFrame:
    """Per split: rows, date range, entities, and whether any target value is present."""
    normalised = len([c for c in df.columns if c.endswith("_norm")])
    return df.groupBy(split).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(date).alias("first"),
        F.max(date).alias("last"),
        F.countDistinct(entity).alias("stations"),
        (F.count(target) > 0).alias("target_available"),
        F.lit(len(df.columns)).alias("columns"),
        F.lit(normalised).alias("normalised"),
    )


def load_verification(df: DataFrame, entity: str, time: str, target: str) -> DataFrame:
    """After a load: files, rows, range, entities and share of present targets."""
    tagged = df.select(F.col("_metadata.file_path").alias("_file"), entity, time, target)
    return tagged.agg(
        F.countDistinct("_file").alias("files"),
        F.count(F.lit(1)).alias("rows"),
        F.min(time).alias("first"),
        F.max(time).alias("last"),
        F.countDistinct(entity).alias("stations"),
        F.try_divide(F.count(target) * 100.0, F.count(F.lit(1))).alias("available_pct"),
    )


# Column groups by name, first match wins.
GROUP_RULES: list[tuple[str, str]] = [
    ("normalised", "_norm"),
    ("target", "target_"),
    ("lag", "lag"),
    ("rolling", "rolling"),
    ("change", "_diff_"),
    ("change", "_change_"),
    ("station", "station_"),
    ("hotspot", "hotspot"),
    ("hotspot", "transboundary"),
    ("calendar", "_sin"),
    ("calendar", "_cos"),
    ("calendar", "is_"),
]
CALENDAR_NAMES = {"year", "month", "day", "hour", "weekday", "day_of_week", "day_of_year"}


def column_group(name: str) -> str:
    if name in CALENDAR_NAMES:
        return "calendar"
    return next((group for group, part in GROUP_RULES if part in name), "original")


def group_completeness(df: DataFrame) -> DataFrame:
    """Share of present values per group of columns."""
    profile = column_profile(df)
    groups = F.create_map(*[F.lit(v) for c in df.columns for v in (c, column_group(c))])
    return profile.groupBy(groups[F.col("column")].alias("group")).agg(
        F.count(F.lit(1)).alias("columns"), (100 - F.avg("null_pct")).alias("complete_pct")
    )


@dataclass(frozen=True)
class Rule:
    """A closed range for a column; a null bound is open, and null values pass unless required."""

    column: str
    low: float | None = None
    high: float | None = None
    required: bool = False

    @property
    def name(self) -> str:
        return f"{self.column}_range"

    def broken(self) -> Column:
        c = F.col(self.column)
        tests = []
        if self.low is not None:
            tests.append(c < self.low)
        if self.high is not None:
            tests.append(c > self.high)
        if self.required:
            tests.append(c.isNull())
        return F.coalesce(reduce(Column.__or__, tests, F.lit(False)), F.lit(False))


# Accepted ranges of weather and air-quality rows.
WEATHER_RULES = [
    Rule("lat", -90, 90, required=True),
    Rule("lon", -180, 180, required=True),
    Rule("temp_c", -50, 60),
    Rule("humidity_pct", 0, 100),
    Rule("pressure_hpa", 800, 1100),
    Rule("precipitation_mm", 0, None),
    Rule("wind_ms", 0, None),
    Rule("wind_dir_deg", 0, 360),
    Rule("shortwave_radiation_wm2", 0, None),
    Rule("cloud_cover_pct", 0, 100),
]
AIR_QUALITY_RULES = [
    Rule("lat", -90, 90, required=True),
    Rule("lon", -180, 180, required=True),
    Rule("pm2_5_ugm3", 0, 1000),
    Rule("pm10_ugm3", 0, 1000),
    Rule("no2_ugm3", 0, None),
    Rule("o3_ugm3", 0, None),
    Rule("so2_ugm3", 0, None),
    Rule("co_ugm3", 0, None),
]


def tag_violations(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``violations``: the names of the rules a row breaks."""
    names = F.array(*[F.when(r.broken(), F.lit(r.name)) for r in rules])
    return df.withColumn("violations", F.array_compact(names))


def quarantine(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """Valid rows and rejected rows (the latter with their violations)."""
    tagged = tag_violations(df, rules)
    valid = tagged.filter(F.size("violations") == 0).drop("violations")
    return valid, tagged.filter(F.size("violations") > 0)


def rule_violations(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Broken rows per rule, counted in one pass."""
    wide = df.agg(*[F.count_if(r.broken()).alias(r.name) for r in rules])
    return _stacked(wide, [F.struct(F.lit(r.name).alias("rule"), F.col(r.name).alias("violations")) for r in rules])


def partition_presence(df: DataFrame, by: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Per partition and declared column: present values. Zero means the column is absent or all null."""
    wide = df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), *[F.count(c).alias(f"n_{c}") for c in cols])
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"n_{c}").alias("present")) for c in cols])
    return wide.select(*by, "rows", F.inline(cells))


def schema_diff(df: DataFrame, schema: T.StructType) -> Mapping[str, list[str]]:
    """Declared columns that are missing, undeclared columns, and columns of another type."""
    have = {f.name: f.dataType for f in df.schema.fields}
    want = {f.name: f.dataType for f in schema.fields}
    return {
        "missing": [c for c in want if c not in have],
        "extra": [c for c in have if c not in want],
        "wrong_type": [c for c in want if c in have and have[c] != want[c]],
    }
