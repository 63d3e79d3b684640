import os
import tempfile
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from stridewise.sources import exports


def test_garmin_import_latin1_and_renames(spark, garmin_glob):
    df = exports.import_garmin_activities(spark, garmin_glob)
    assert df.count() == 5
    assert {"activity_type", "date", "distance_km", "calories", "duration", "avg_heart_rate", "max_heart_rate",
            "source", "export_date", "Title"} <= set(df.columns)
    titles = {r.Title for r in df.select("Title").collect()}
    assert "Lauf Zürich" in titles
    assert {r.export_date for r in df.select("export_date").distinct().collect()} == {"2025-08-22"}


def test_garmin_layouts_union_by_name(spark):
    root = tempfile.mkdtemp(prefix="garmin-")
    for day, header, row in [("2025-08-01", "Activity Type;Date;Time", "Running;01.08.2025 07:00;00:30:00"),
                             ("2025-08-02", "Date;Activity Type;Distance", "02.08.2025 07:00;Running;5.0")]:
        os.makedirs(f"{root}/{day}")
        with open(f"{root}/{day}/Activities.csv", "w", encoding="latin-1") as fh:
            fh.write(header + "\n" + row + "\n")
    df = exports.import_garmin_activities(spark, f"{root}/*/Activities.csv")
    rows = {r.export_date: r for r in df.collect()}
    assert rows["2025-08-01"].duration == "00:30:00" and rows["2025-08-01"].distance_km is None
    assert rows["2025-08-02"].distance_km == "5.0" and rows["2025-08-02"].activity_type == "Running"


def test_missing_glob_is_empty(spark):
    assert exports.import_garmin_activities(spark, "/nonexistent/*/Activities.csv").count() == 0
    assert exports.import_apple_workouts(spark, "/nonexistent/*/Export.xml").count() == 0


def test_apple_import(spark, apple_glob):
    df = exports.import_apple_workouts(spark, apple_glob)
    rows = sorted(df.collect(), key=lambda r: r.date)
    assert len(rows) == 3
    assert [r.activity_type for r in rows] == ["Running", "Walking", "Running"]
    walk = rows[1]
    assert walk.avg_heart_rate == "" and walk.distance == "2.0"
    assert rows[0].export_date == "2025-08-22" and rows[0].duration == "32.0"


def test_apple_edge_cases(spark):
    root = tempfile.mkdtemp(prefix="apple-")
    os.makedirs(f"{root}/2025-09-01")
    xml = """<?xml version="1.0" encoding="UTF-8"?>
<HealthData>
 <Workout workoutActivityType="HKWorkoutActivityTypeRunning" duration="" startDate="2025-08-30 07:00:00 +0100">
  <WorkoutStatistics type="HKQuantityTypeIdentifierDistanceWalkingRunning" sum="4.0"/>
  <WorkoutStatistics type="HKQuantityTypeIdentifierDistanceWalkingRunning" sum="4.5"/>
 </Workout>
 <Workout workoutActivityType="HKWorkoutActivityTypeRunning" duration="30" startDate="2025-08-31 07:00:00 +0200"/>
</HealthData>
"""
    with open(f"{root}/2025-09-01/Export.xml", "w") as fh:
        fh.write(xml)
    rows = sorted(exports.import_apple_workouts(spark, f"{root}/*/Export.xml").collect(), key=lambda r: r.date)
    assert rows[0].distance == "4.5" and rows[0].duration == ""          # last statistic wins
    assert rows[1].distance == "" and rows[1].calories == ""             # no statistics at all
    stats = exports.import_statistics(exports.import_apple_workouts(spark, f"{root}/*/Export.xml")).first()
    assert (stats.workouts, stats.with_distance, stats.with_duration) == (2, 1, 1)


def test_write_and_read_back(spark, make_runs):
    out = tempfile.mkdtemp(prefix="out-")
    df = make_runs(n=3)
    paths = exports.write_outputs(df, out)
    assert set(paths) == {"parquet", "csv"}
    back = exports.read_processed(spark, out)
    assert sorted(back.collect()) == sorted(df.collect()) and back.schema == df.schema
    csv = spark.read.option("header", True).csv(paths["csv"])
    assert all(t == "string" for _, t in csv.dtypes)     # the control copy loses types
    exports.write_outputs(df.limit(1), out)               # overwrite
    assert exports.read_processed(spark, out).count() == 1


def test_read_missing_raises(spark):
    with pytest.raises(AnalysisException):
        exports.read_processed(spark, tempfile.mkdtemp(prefix="none-")).count()


def test_quotes_line_breaks_and_layouts_over_many_files(spark, tmp_path):
    """More than 64 files in two layouts; doubled quotes, separators and line breaks inside quoted titles."""
    from stridewise.sources.exports import import_garmin_activities

    for i in range(70):
        folder = tmp_path / f"2025-01-{i:03d}"
        folder.mkdir()
        extra = "Favorite;" if i % 2 else ""
        value = "false;" if i % 2 else ""
        title = '"Lauf ""schnell"";Teil\n2 Zürich"'
        text = f"Activity Type;{extra}Title;Date;Distance;Calories;Time;Avg HR;Max HR\nRunning;{value}{title};01.02.2025 07:05;{i},5;300;00:30:00;150;170\n"
        (folder / "Activities.csv").write_bytes(text.encode("latin-1"))
    rows = import_garmin_activities(spark, f"{tmp_path}/*/Activities.csv").collect()
    assert len(rows) == 70
    for r in rows:
        i = int(r.export_date[-3:])
        assert (r.Title, r.distance_km, r.duration, r.max_heart_rate) == ('Lauf "schnell";Teil\n2 Zürich', f"{i},5", "00:30:00", "170")
        assert r.Favorite == ("false" if i % 2 else None)


def test_csv_parts_in_name_order_are_in_time_order(spark, tmp_path):
    from stridewise.sources.exports import write_outputs

    df = spark.range(0, 5000, numPartitions=7).selectExpr("pmod(id * 7919, 5000) as date", "repeat('x', cast(id % 50 as int)) as t").orderBy("date")
    out = write_outputs(df, str(tmp_path))
    parts = sorted(Path(out["csv"]).glob("part-*.csv"))
    dates = [int(line.split(",")[0]) for p in parts for line in p.read_text().splitlines()[1:]]
    assert dates == list(range(5000)) and spark.read.parquet(out["parquet"]).count() == 5000


def test_a_write_that_dies_leaves_the_earlier_pair(spark, tmp_path):
    from stridewise.sources.publish import current_version

    out = str(tmp_path)
    first = exports.write_outputs(spark.range(5).toDF("date"), out)
    broken = spark.range(5).select((F.lit(1) / (F.col("id") - 3)).alias("date"))
    with pytest.raises(Exception, match="(?i)divi"):
        exports.write_outputs(broken, out)
    assert current_version(spark, out, "combined_runs")["files"] == first
    assert exports.read_processed(spark, out).count() == 5
    assert spark.read.option("header", True).csv(first["csv"]).count() == 5
    second = exports.write_outputs(spark.range(7).toDF("date"), out)
    assert os.path.isdir(first["parquet"]) and exports.read_processed(spark, out).count() == 7  # readers of the pair before may go on
    third = exports.write_outputs(spark.range(9).toDF("date"), out)
    versions = os.listdir(os.path.join(out, "combined_runs.versions"))
    assert len(versions) == 2 and not os.path.exists(first["parquet"]) and os.path.isdir(second["csv"]) and os.path.isdir(third["csv"])
    assert not [f for f in os.listdir(out) if f.endswith(".tmp")]


def test_the_record_names_both_files_or_neither(spark, tmp_path, monkeypatch):
    """The Parquet file is written, the CSV copy fails: the new Parquet file must not be read."""
    from stridewise.sources import publish

    out = str(tmp_path)
    exports.write_outputs(spark.range(2).toDF("date"), out)

    def fail(path):
        raise OSError("no room")

    with pytest.raises(OSError):
        publish.publish(spark, out, "combined_runs", {"parquet": lambda p: spark.range(3).write.parquet(p), "csv": fail}, {"parquet": "x", "csv": "y"})
    assert exports.read_processed(spark, out).count() == 2
