import pytest

from stridewise.operators import quality


def _metrics(df, config):
    long = quality.quality_long(quality.assess_quality(df, config), [])
    return {(r.category, r.metric): r.value for r in long.collect()}


def test_completeness_half(make_runs, config):
    m = _metrics(make_runs(calories=[400.0, None]), config)
    assert m[("completeness", "calories")] == 0.5 and m[("completeness", "date")] == 1.0


def test_validity_half(make_runs, config):
    m = _metrics(make_runs(distance_km=[5.0, 100.0], duration_sec=[1800.0, 1800.0]), config)
    assert m[("validity", "distance")] == 0.5


def test_consistency_half(make_runs, config):
    m = _metrics(make_runs(avg_heart_rate=[150.0, 150.0], max_heart_rate=[170.0, 140.0]), config)
    assert m[("consistency", "hr_max_vs_avg")] == 0.5


def test_uniqueness_half(make_runs, config):
    m = _metrics(make_runs(n=2), config)
    assert m[("uniqueness", "workouts")] == 0.5


def test_provenance_not_measured(make_runs, config, spark):
    from pyspark.sql import functions as F
    df = make_runs(n=2).withColumns({"calories_imputed": F.lit(False), "imputation_level": F.lit(None).cast("string")})
    m = _metrics(df, config)
    assert ("completeness", "imputation_level") not in m and ("completeness", "calories") in m


def test_report_shape(make_runs, config):
    rep = quality.quality_report(quality.assess_quality(make_runs(n=1), config), config)
    assert rep.columns == ["ord", "category", "metric", "value", "status"]
    assert rep.count() == 9 + 4 + 1 + 1


def test_comparison_table_mismatch_raises(spark, make_runs, config):
    summary = spark.createDataFrame([("a", 10, 8, 2, 0.8)], "source string, initial_rows long, final_rows long, total_removed long, retention_rate double")
    wide = quality.assess_quality(make_runs(source=["b"]), config, by=["source"])
    with pytest.raises(ValueError):
        quality.comparison_table(summary, wide, ["a"])


def test_comparison_table(spark, make_runs, config):
    summary = spark.createDataFrame([("garmin", 10, 8, 2, 0.8)], "source string, initial_rows long, final_rows long, total_removed long, retention_rate double")
    wide = quality.assess_quality(make_runs(n=1), config, by=["source"])
    rows = quality.comparison_table(summary, wide, ["garmin"]).collect()
    assert [r.Metrik for r in rows] == list(quality.COMPARISON_ROWS)
    assert [r.garmin for r in rows][:4] == ["10", "8", "2", "80.0%"]
