from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tidelines.operators.quality import temporal_coverage
from tidelines.operators.reports import merged_coverage, merged_profile, store_report, stored_report

COLS = ["station", "x", "k", "odd.name"]


def table(spark, days, per_day=50):
    rows = spark.range(days * per_day)
    at = F.timestamp_seconds(F.lit(1_704_067_200) + F.floor(F.col("id") / per_day) * 86_400)
    return rows.select(
        F.concat(F.lit("s"), F.col("id") % 37).alias("station"),
        F.when(F.col("id") % 7 > 0, F.col("id") * 0.5).alias("x"),
        (F.col("id") % 1999).alias("k"),
        F.lit(None).cast("string").alias("odd.name"),
        F.when(F.col("id") % 1000 != 3, at).alias("t"),
    )


def test_a_new_month_is_measured_alone(spark, tmp_path):
    path, whole = str(tmp_path / "report"), table(spark, 90)
    march = F.col("t") >= "2024-03-01"
    store_report(whole.filter(~march | F.col("t").isNull()), path, "t", COLS)
    before = {r.column: r.rows for r in merged_profile(stored_report(spark, path)).collect()}
    # The source holds nothing but March now: what is stored of other months must not be read again.
    for _ in range(2):
        store_report(whole.filter(march), path, "t", COLS, months=[date(2024, 3, 17)])
    stored = stored_report(spark, path)
    got = {r.column: r for r in merged_profile(stored).collect()}
    want = whole.agg(*[f(c) for c in ("x", "k") for f in (F.min, F.max, F.avg, F.count)]).first()
    n = whole.count()
    assert before["x"] < n and {r.rows for r in got.values()} == {n}
    for c, at in (("x", 0), ("k", 4)):
        assert (got[c].min, got[c].max, got[c].null_count) == (want[at], want[at + 1], n - want[at + 3])
        assert abs(got[c].mean - want[at + 2]) < 1e-9
    assert got["station"].approx_distinct == 37 and got["x"].approx_distinct is None
    assert abs(got["k"].approx_distinct - 1999) <= 0.03 * 1999
    assert got["odd.name"].null_pct == 100 and got["odd.name"].approx_distinct == 0
    plain = temporal_coverage(whole.filter("t IS NOT NULL").withColumnRenamed("t", "timestamp")).first()
    cover = merged_coverage(stored).first()
    assert all(cover[c] == plain[c] for c in ("min_date", "max_date", "unique_dates", "expected_days", "missing_days"))


def test_reports_of_an_empty_table(spark, tmp_path):
    path = str(tmp_path / "report")
    store_report(table(spark, 3).limit(0), path, "t", COLS)
    assert merged_profile(stored_report(spark, path)).count() == 0
    assert merged_coverage(stored_report(spark, path)).first().unique_dates == 0
