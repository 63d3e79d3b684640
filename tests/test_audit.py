"""Counts of the steps: by aggregate, observed, and of lazily run user steps."""

import logging
from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from stridewise.plans import audit
from stridewise.plans import pipeline as pl
from stridewise.plans.run import run_pipeline


def sample(make_runs):
    return make_runs(
        date=[None, *[datetime(2025, 8, i) for i in range(1, 9)]],
        distance_km=[5.0, 5.0, None, 99.0, 6.0, 7.0, 8.0, 9.0, 10.0],
        duration_sec=[1800.0, 1800.0, 1800.0, 1800.0, 2000.0, 2400.0, 2900.0, 3300.0, 3500.0],
        avg_heart_rate=[150.0, 150.0, 150.0, 150.0, 0.0, 160.0, 172.0, 150.0, 150.0],
        max_heart_rate=[170.0, 170.0, 170.0, 170.0, 170.0, 150.0, 170.0, 301.0, None],
        calories=[300.0, 9000.0, 300.0, 300.0, None, -1.0, 400.0, 450.0, 500.0],
    )


def test_figures_of_every_family(make_runs, config):
    annotated = pl.annotate_runs(sample(make_runs), config, audit=True)
    got = {r.figure: r.value for r in audit.figures_long(pl.step_report(annotated, cfg=config)).collect()}
    assert got == {
        "dates_imputed": 1, "fail_distance": 1, "fail_duration": 0, "fail_pace": 1, "hr_inverted": 2, "hr_tolerated": 1, "hr_conflict": 1,
        "avg_hr_null_before": 2, "avg_hr_null_after": 0, "max_hr_null_before": 3, "max_hr_null_after": 0,
        "calories_bad": 2, "calories_null_after": 0, "winsorised_absolute": 1, "winsorised_ratio": got["winsorised_ratio"],
    }
    assert got["winsorised_ratio"] >= 1


def test_observed_equals_aggregated_and_marks_change_nothing(make_runs, config):
    strict = replace(config, distance_max=9.5)
    df = sample(make_runs).withColumn("source", F.when(F.col("distance_km") > 6.5, "apple").otherwise("garmin"))
    plain = pl.clean_runs(df, strict)
    annotated = pl.annotate_runs(df, strict, audit=True)
    want = {(r["source"], r["step_no"]): r.asDict() for r in pl.step_report(annotated, cfg=strict).collect()}
    watched, seen = audit.observe_counts(annotated, ["garmin", "apple"], "source", strict)
    kept = pl.write_table(pl.kept_rows(watched, strict), "test-observed")
    got = {(r["source"], r["step_no"]): r for r in pl.observed_report(seen.get, ["garmin", "apple"])}
    assert got == want and len(got) == 16
    assert sorted(kept.collect(), key=str) == sorted(plain.data.collect(), key=str)
    assert [r.asDict() for r in pl.step_report(annotated, cfg=strict).drop("figures").orderBy("source", "step_no").collect()] == \
        [r.asDict() for r in plain.report.orderBy("source", "step_no").collect()]


def test_run_gives_import_numbers_and_figures(spark, garmin_glob, apple_glob):
    result = run_pipeline(spark, garmin_glob, apple_glob)
    assert result.imports["Garmin"] == {"files": 1, "workouts": 5, "with_distance": 5, "with_duration": 5}
    assert result.imports["Apple"] == {"files": 1, "workouts": 3, "with_distance": 3, "with_duration": 3}
    for rows in result.reports.values():
        assert {f for r in rows for f in r["figures"]} == {f for names in audit.FIGURES.values() for f in names}
    lazy = run_pipeline(spark, garmin_glob, apple_glob, materialize=False)
    assert lazy.reports == result.reports


def three_steps(config):
    def best(d, cfg):
        return d.join(d.groupBy("source").agg(F.max("distance_km").alias("m")), "source").where("distance_km < m").drop("m")

    p = pl.CleaningPipeline("x", config)
    p.add_step(pl.Step("Short", lambda d, c: d.where("distance_km < 10")))
    p.add_step(pl.Step("Not the longest", best))
    p.add_step(pl.Step("Tagged", lambda d, c: (d.withColumn("tag", F.lit(1)), {"own": 7})))
    return p


def test_user_steps_run_as_one_plan(spark, make_runs, config, monkeypatch):
    def never(self, df):
        raise AssertionError("steps ran one by one")

    monkeypatch.setattr(pl.CleaningPipeline, "_one_by_one", never)
    writes = []
    monkeypatch.setattr(pl, "write_table", lambda df, name, real=pl.write_table: (writes.append(name), real(df, name))[1])
    data, report = three_steps(config).run(make_runs(distance_km=[5.0, 6.0, 7.0, 12.0]))
    assert [(r.step, r.rows_before, r.rows_after, r.figures) for r in report.collect()] == [
        ("Short", 4, 3, {}), ("Not the longest", 3, 2, {}), ("Tagged", 2, 2, {"own": 7.0})]
    assert sorted(r.distance_km for r in data.collect()) == [5.0, 6.0] and writes == ["steps"]


def test_a_data_error_skips_its_step_only(make_runs, config, caplog):
    p = three_steps(config)
    p.steps.insert(1, pl.Step("Divides", lambda d, c: d.withColumn("q", F.lit(1) / (F.col("distance_km") - 5.0))))
    with caplog.at_level(logging.WARNING):
        data, report = p.run(make_runs(distance_km=[5.0, 6.0, 7.0, 12.0]))
    assert [r.step for r in report.collect()] == ["Short", "Not the longest", "Tagged"] and data.count() == 2
    assert "'Divides' skipped" in caplog.text
    p.steps[1] = replace(p.steps[1], is_critical=True)
    with pytest.raises(Exception, match="(?i)divi"):
        p.run(make_runs(distance_km=[5.0, 6.0, 7.0, 12.0]))


def test_limits_and_empty_frames_are_counted_right(make_runs, config):
    p = three_steps(config).add_step(pl.Step("One", lambda d, c: d.limit(1)))
    _, report = p.run(make_runs(distance_km=[5.0, 6.0, 7.0, 12.0]))
    assert [(r.rows_before, r.rows_after) for r in report.collect()] == [(4, 3), (3, 2), (2, 2), (2, 1)]
    _, report = three_steps(config).run(make_runs(distance_km=[20.0, 30.0]))
    assert [(r.rows_before, r.rows_after) for r in report.collect()] == [(2, 0), (0, 0), (0, 0)]
    p = three_steps(config)
    p.steps[0] = replace(p.steps[0], is_critical=True)
    with pytest.raises(ValueError, match="removed all data"):
        p.run(make_runs(distance_km=[20.0, 30.0]))


def test_tasks_that_ran_anew_lead_to_plain_counts(make_runs, config, monkeypatch):
    monkeypatch.setattr(pl, "_tasks_ran_anew", lambda sc, tag: True)
    _, report = three_steps(config).run(make_runs(distance_km=[5.0, 6.0, 7.0, 12.0]))
    assert [(r.rows_before, r.rows_after) for r in report.collect()] == [(4, 3), (3, 2), (2, 2)]
