from datetime import datetime

import pytest
from pyspark.sql import functions as F

from stridewise.functions import exprs


def _eval(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_duration_valid_forms(spark):
    vals = ["00:36:52", "1:02:03", "36:52", "5:07", "1800", "1800.5", "00:01:47.7", "0:00:00"]
    assert _eval(spark, vals, exprs.duration_to_seconds) == [2212.0, 3723.0, 2212.0, 307.0, 1800.0, 1800.5, 107.7, 0.0]


def test_duration_invalid_forms(spark):
    vals = [None, "", "abc", "1:2:3:4", "xx:10", "10:yy", "--"]
    assert _eval(spark, vals, exprs.duration_to_seconds) == [None] * 7


def test_european_dates_never_swap(spark):
    vals = ["11.07.2025 16:58", "22.08.2025 07:15", "01.02.2025 00:00", "3.4.2025 6:05"]
    assert _eval(spark, vals, exprs.parse_eu_datetime) == [
        datetime(2025, 7, 11, 16, 58), datetime(2025, 8, 22, 7, 15), datetime(2025, 2, 1, 0, 0), datetime(2025, 4, 3, 6, 5)]


def test_european_dates_bad_text(spark):
    vals = ["31.02.2025 10:00", "2025-07-11 16:58", "nonsense", None, "11.07.2025"]
    assert _eval(spark, vals, exprs.parse_eu_datetime) == [None] * 5


def test_offset_is_dropped_not_converted(spark):
    vals = ["2025-08-20 18:29:00 +0200", "2025-08-20 18:29:00 -0500", "2025-08-20 18:29:00+05:30",
            "2025-08-20 18:29:00Z", "2025-08-20 18:29:00", "bad", None]
    wall = datetime(2025, 8, 20, 18, 29)
    assert _eval(spark, vals, exprs.strip_utc_offset) == [wall] * 5 + [None, None]


def test_wall_clock_kept_in_dst_gap(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Zurich")
    try:
        assert _eval(spark, ["30.03.2025 02:30"], exprs.parse_eu_datetime) == [datetime(2025, 3, 30, 2, 30)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_numeric_coercion(spark):
    vals = ["12", "12.5", "1,234", "--", "", "nan", None, " 7 "]
    assert _eval(spark, vals, exprs.to_double) == [12.0, 12.5, None, None, None, None, None, 7.0]


def test_clip_keeps_null(spark):
    assert _eval(spark, [None, 10.0, 100.0, 5000.0], lambda c: exprs.clip(c, 50, 3000), "double") == [None, 50.0, 100.0, 3000.0]


def test_round_half_even(spark):
    assert _eval(spark, [0.5, 1.5, 2.5, 2.500001], lambda c: F.bround(c, 0), "double") == [0.0, 2.0, 2.0, 3.0]


@pytest.mark.parametrize("value,status", [(1.0, "✅"), (0.95, "✅"), (0.94, "⚠️"), (0.85, "⚠️"), (0.84, "❌"), (0.0, "❌")])
def test_status_limits(spark, value, status):
    assert _eval(spark, [value], exprs.status_indicator, "double") == [status]


def test_percent_text(spark):
    vals = [0.8765, 1.0, 0.0, 0.12345, 0.5, 0.9999]
    assert _eval(spark, vals, exprs.percent_text, "double") == [f"{v * 100:.1f}%" for v in vals]


def test_distance_bins(spark):
    vals = [4.99, 5.0, 9.99, 10.0, 100.0, 50.0, -1.0, None]
    got = _eval(spark, vals, lambda c: exprs.distance_bin(c, (0, 5, 10, 15, 25, 50)), "double")
    assert got == [0.0, 5.0, 5.0, 10.0, None, None, 0.0, None]


def test_date_imputation(spark):
    df = spark.createDataFrame([(None, datetime(2025, 8, 22)), (datetime(2025, 8, 1, 7), datetime(2025, 8, 22))],
                               "d timestamp_ntz, e timestamp_ntz")
    got = [r[0] for r in df.select(exprs.impute_date("d", "e")).collect()]
    assert got == [datetime(2025, 8, 22, 12), datetime(2025, 8, 1, 7)]


def test_changed_counts_nulls(spark):
    df = spark.createDataFrame([(100.0, 100.0), (200.0, 250.0), (None, None), (1.0, None)], "a double, b double")
    assert df.where(exprs.changed("a", "b")).count() == 3


def test_type_letters_are_no_numbers_and_short_minutes_are_minutes(spark):
    from stridewise.functions import exprs

    df = spark.createDataFrame([("12d",), ("1.5F",), ("12",), (" 7.5 ",), ("1e3",)], "x string")
    got = df.select(exprs.to_double("x").alias("a"), exprs.duration_to_seconds("x").alias("b")).collect()
    assert [r.a for r in got] == [None, None, 12.0, 7.5, 1000.0] and [r.b for r in got][:3] == [None, None, 12.0]
    date = spark.createDataFrame([("1.2.2025 7:5",), ("1.2.2025 7:",)], "x string").select(exprs.parse_eu_datetime("x").cast("string").alias("d")).collect()
    assert [r.d for r in date] == ["2025-02-01 07:05:00", None]
