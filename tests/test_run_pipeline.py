import os
import tempfile
from dataclasses import replace

import pytest

from stridewise.config import FINAL_SCHEMA
from stridewise.plans.job import build_parser, main
from stridewise.plans.run import run_pipeline

GARMIN_RUNS, APPLE_RUNS = 4, 2


@pytest.fixture(scope="module")
def result(spark, garmin_glob, apple_glob):
    return run_pipeline(spark, garmin_glob, apple_glob)


def test_row_counts(result):
    counts = {r.source: r["count"] for r in result.data.groupBy("source").count().collect()}
    assert counts == {"garmin": GARMIN_RUNS, "apple": APPLE_RUNS}


def test_reports_and_summaries(result):
    assert set(result.reports) == set(result.summaries) == set(result.qualities) == {"Garmin", "Apple"}
    assert result.summaries["Garmin"]["final_rows"] == GARMIN_RUNS
    assert len(result.reports["Garmin"]) == 8
    assert result.qualities["Apple"]["validity"]["pace"] == 1.0


def test_schema_and_order(result):
    assert result.data.schema.simpleString() == FINAL_SCHEMA.simpleString().replace("source:string", "source:string")
    dates = [r.date for r in result.data.collect()]
    assert dates == sorted(dates)


def test_units_and_types(result):
    rows = {round(r.distance_km, 2): r for r in result.data.collect()}
    assert rows[5.1].duration_sec == 1920.0            # minutes detected and converted
    assert rows[6.0].duration_sec == 2212.0            # 00:36:52
    assert abs(rows[5.1].pace_min_per_km - 1920 / 60 / 5.1) < 1e-12


def test_frozen(result):
    with pytest.raises(Exception):
        result.data = None


def test_missing_source_is_skipped(spark, apple_glob):
    r = run_pipeline(spark, "/nonexistent/*/Activities.csv", apple_glob)
    assert set(r.summaries) == {"Apple"} and r.data.count() == APPLE_RUNS


def test_no_data_raises(spark):
    with pytest.raises(ValueError):
        run_pipeline(spark, "/nonexistent/a/*.csv", "/nonexistent/b/*.xml")


def test_writes_outputs(spark, garmin_glob, apple_glob):
    out = tempfile.mkdtemp(prefix="run-")
    r = run_pipeline(spark, garmin_glob, apple_glob, output_dir=out)
    assert os.path.isdir(r.outputs["parquet"]) and os.path.isdir(r.outputs["csv"])
    assert spark.read.parquet(r.outputs["parquet"]).count() == GARMIN_RUNS + APPLE_RUNS


def test_config_override(spark, garmin_glob, apple_glob):
    from stridewise.config import CleaningConfig
    r = run_pipeline(spark, garmin_glob, apple_glob, config=replace(CleaningConfig(), distance_max=6.0))
    assert r.data.where("distance_km > 6").count() == 0


def test_cli(spark, capsys, garmin_glob, apple_glob):
    assert build_parser().parse_args([]).dry_run is False
    assert main(["--garmin", garmin_glob, "--apple", apple_glob, "--dry-run", "--quiet"], spark=spark) == 0
    printed = capsys.readouterr().out
    assert "nowhere (dry run)" in printed and "Plausibility Checks" in printed
    assert main(["--garmin", "/nonexistent/*.csv", "--apple", "/nonexistent/*.xml", "--quiet"], spark=spark) == 1


def test_of_copies_the_first_in_the_files_stays(spark, tmp_path):
    """Copies differ in calories: the measured one that stands first wins over a missing one, whatever the values."""
    head = "Activity Type;Date;Distance;Calories;Time;Avg HR;Max HR\n"
    rows = [("01.02.2025 07:05", "6.0", "300"), ("01.02.2025 07:05", "6.0", ""), ("03.02.2025 07:05", "7.0", ""), ("03.02.2025 07:05", "7.0", "350"),
            ("05.02.2025 07:05", "8.0", "480"), ("05.02.2025 07:05", "8.0", "440")]
    folder = tmp_path / "2025-03-01"
    folder.mkdir()
    text = head + "".join(f"Running;{d};{km};{kcal};00:40:00;150;170\n" for d, km, kcal in rows)
    (folder / "Activities.csv").write_text(text, encoding="latin-1")
    data = run_pipeline(spark, f"{tmp_path}/*/Activities.csv", "/nonexistent/*/Export.xml").data
    got = {r.distance_km: (r.calories, r.calories_imputed) for r in data.collect()}
    assert got[6.0] == (300.0, False) and got[8.0] == (480.0, False) and got[7.0][1] is True
    assert "_position" not in data.columns
