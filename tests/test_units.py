"""Declared units of XML records, heuristics for the others."""

from datetime import datetime

import pytest

from stridewise.config import CleaningConfig
from stridewise.operators.typing import clean_apple_typing
from stridewise.plans.run import prepare_apple
from stridewise.sources.exports import import_apple_workouts

FIELDS = "source string, export_date string, activity_type string, date string, duration string, distance string, calories string, duration_unit string, distance_unit string, calories_unit string"


@pytest.fixture
def typed(spark):
    def run(*rows):
        data = [("apple", "2025-08-22", "Running", f"2025-08-{i + 1:02d} 07:00:00 +0200", *r) for i, r in enumerate(rows)]
        out = clean_apple_typing(spark.createDataFrame(data, FIELDS)).orderBy("date").collect()
        return [(r["duration_sec"], r["distance_km"], r["calories"]) for r in out]
    return run


def test_each_record_by_its_own_units(typed):
    assert typed(("30", "5000", "418.4", "min", "m", "kJ"), ("1800", "5", "400", " s ", "km", "kcal"), ("0.5", "10", "300", "hr", "mi", "Cal")) == [
        (1800.0, 5.0, pytest.approx(100.0)), (1800.0, 5.0, 400.0), (1800.0, pytest.approx(16.09344), 300.0)]


def test_heuristics_judge_only_records_without_a_unit(typed):
    # 7000 m are declared: they do not turn the undeclared 7 into metres; the undeclared median of 30 means minutes
    assert typed(("1800", "7000", "1", "s", "m", ""), ("30", "7", "2", "", "", ""), ("40", "8", "3", None, None, None)) == [
        (1800.0, 7.0, 1.0), (1800.0, 7.0, 2.0), (2400.0, 8.0, 3.0)]


def test_an_unknown_unit_is_as_good_as_none(typed):
    assert typed(("30", "9000", "1", "fortnight", "parsec", "eV"), ("40", "8000", "", "", "", "")) == [(1800.0, 9.0, 1.0), (2400.0, 8.0, None)]


def test_missing_values_stay_missing(typed):
    assert typed(("", "--", None, "min", "km", "kcal")) == [(None, None, None)]


def test_import_takes_the_unit_of_the_last_statistic(spark, tmp_path):
    (tmp_path / "2025-08-22").mkdir()
    (tmp_path / "2025-08-22" / "Export.xml").write_text("""<HealthData>
 <Workout workoutActivityType="HKWorkoutActivityTypeRunning" duration="0.5" durationUnit="hr" startDate="2025-08-01 07:00:00 +0200">
  <WorkoutStatistics type="HKQuantityTypeIdentifierDistanceWalkingRunning" sum="1" unit="km"/>
  <WorkoutStatistics type="HKQuantityTypeIdentifierDistanceWalkingRunning" sum="5000" unit="m"/>
  <WorkoutStatistics type="HKQuantityTypeIdentifierHeartRate" average="152" maximum="171" unit="count/min"/>
 </Workout>
 <Workout workoutActivityType="HKWorkoutActivityTypeRunning" duration="1800" startDate="2025-08-02 07:00:00 +0200"/>
</HealthData>""")
    pattern = str(tmp_path / "*" / "Export.xml")
    got = import_apple_workouts(spark, pattern, units=True).orderBy("date").collect()
    assert [(r["duration_unit"], r["distance_unit"], r["calories_unit"]) for r in got] == [("hr", "m", ""), ("", "", "")]
    assert "duration_unit" not in import_apple_workouts(spark, pattern).columns
    runs = prepare_apple(spark, pattern, CleaningConfig(declared_units=True)).orderBy("date").collect()
    assert [(r["date"], r["duration_sec"], r["distance_km"]) for r in runs] == [(datetime(2025, 8, 1, 7), 1800.0, 5.0), (datetime(2025, 8, 2, 7), 1800.0, None)]
