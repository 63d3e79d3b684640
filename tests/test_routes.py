"""GPX points, the clocks of their files, and points matched with intervals of time."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from stridewise.operators import intervals
from stridewise.operators.intervals import interval_join, interval_summary
from stridewise.sources.routes import import_route_points, named_start, route_clocks, utc_time, with_local_time, workout_routes

GPX = """<?xml version="1.0"?>
<gpx version="1.1"><!-- <trkpt lat="0" lon="0"/> --><metadata><time>2020-01-01T00:00:00Z</time></metadata><trk><trkseg>
{points}
</trkseg></trk></gpx>
"""


def point(time, lat="48.1", extra=""):
    return f'<trkpt lat="{lat}" lon="11.5"><ele>520.5</ele><time>{time}</time>{extra}</trkpt>'


@pytest.fixture
def routes(tmp_path):
    def write(**files):
        folder = tmp_path / "2025-09-19" / "workout-routes"
        folder.mkdir(parents=True)
        for name, points in files.items():
            (folder / f"{name.replace('__', '.')}.gpx").write_text(GPX.format(points="\n".join(points)))
        return str(folder / "*.gpx")
    return write


def test_points_are_read_by_ranges(spark, routes):
    start = datetime(2025, 9, 13, 12, 47, 11)
    speed = "<extensions><speed>3.25</speed><course>12</course></extensions>"
    pattern = routes(**{"route_2025-09-13_2__47pm": [point((start + timedelta(seconds=i)).isoformat() + "Z", extra=speed) for i in range(500)]})
    for size in (1 << 20, 777):
        got = import_route_points(spark, pattern, range_bytes=size).orderBy("position").collect()
        assert [r["time"] for r in got] == [start + timedelta(seconds=i) for i in range(500)]
    first = got[0]
    assert (first["lat"], first["lon"], first["elevation"], first["speed"], first["source"]) == (48.1, 11.5, 520.5, 3.25, "apple")
    assert first["export_date"] == datetime(2025, 9, 19) and first["named_start"] == datetime(2025, 9, 13, 14, 47)


def test_missing_and_bad_values_keep_the_point(spark, routes):
    pattern = routes(other=['<trkpt lat="x" lon="11.5"/>', point("soon"), point("2025-09-13T12:00:00+02:00")])
    got = import_route_points(spark, pattern).orderBy("position").collect()
    assert [(r["lat"], r["time"], r["elevation"], r["named_start"]) for r in got] == [
        (None, None, None, None), (48.1, None, 520.5, None), (48.1, datetime(2025, 9, 13, 10), 520.5, None)]


def test_no_file_is_an_empty_frame(spark, tmp_path):
    none = import_route_points(spark, str(tmp_path / "*.gpx"))
    assert with_local_time(none).count() == 0 and route_clocks(none).count() == 0


@pytest.mark.parametrize(("path", "want"), [
    ("route_2025-09-13_12.05am.gpx", datetime(2025, 9, 13, 0, 5)),
    ("route_2025-09-13_12.05pm.gpx", datetime(2025, 9, 13, 12, 5)),
    ("a/route_2024-01-01_1.00am/route_2025-09-13_11.59pm.gpx", datetime(2025, 9, 13, 23, 59)),
    ("route_2025-09-13_13.05pm.gpx", None), ("route_2025-02-30_1.05pm.gpx", None), ("track.gpx", None), (None, None),
])
def test_named_start(spark, path, want):
    assert spark.createDataFrame([(path,)], "p string").select(named_start(F.col("p"))).first()[0] == want


@pytest.mark.parametrize(("text", "want"), [
    ("2025-09-13T12:00:00Z", datetime(2025, 9, 13, 12)), ("2025-09-13T12:00:00", datetime(2025, 9, 13, 12)),
    ("2025-09-13T12:00:00.5-03:30", datetime(2025, 9, 13, 15, 30, 0, 500000)), ("2025-09-13T12:00:00+0545", datetime(2025, 9, 13, 6, 15)),
    ("2025-09-13", datetime(2025, 9, 13)), ("", None), (None, None), ("noon", None),
])
def test_utc_time(spark, text, want):
    assert spark.createDataFrame([(text,)], "t string").select(utc_time(F.col("t"))).first()[0] == want


def test_clocks_come_from_names(spark, routes):
    pattern = routes(**{
        "route_2025-09-13_2__47pm": [point("2025-09-13T12:47:11Z"), point("2025-09-13T13:00:00Z")],
        "route_2025-01-01_5__45am": [point("2025-01-01T00:00:30Z")],
        "route_2025-01-02_9__17pm": [point("2025-01-03T00:47:59Z")],
        "route_2025-01-04_9__20am": [point("2025-01-04T09:13:00Z")],
        "unnamed": [point("2025-01-04T09:13:00Z")],
    })
    points = import_route_points(spark, pattern)
    got = {r["route"].rsplit("/", 1)[1]: (r["offset_minutes"], r["name_agrees"], r["n_points"]) for r in route_clocks(points).collect()}
    assert got["route_2025-09-13_2.47pm.gpx"] == (120, True, 2)
    assert got["route_2025-01-01_5.45am.gpx"] == (345, True, 1)
    assert got["route_2025-01-02_9.17pm.gpx"] == (-210, True, 1)
    assert got["route_2025-01-04_9.20am.gpx"][1] is False
    assert got["unnamed.gpx"] == (None, None, 1)
    local = {(r["time"], r["local_time"]) for r in with_local_time(points).collect()}
    assert (datetime(2025, 9, 13, 13), datetime(2025, 9, 13, 15)) in local and (datetime(2025, 1, 4, 9, 13), None) in local


def test_workouts_get_their_points(spark, make_runs, routes):
    pattern = routes(**{"route_2025-09-13_2__47pm": [point("2025-09-13T12:47:11Z"), point("2025-09-13T13:17:10Z"), point("2025-09-13T13:17:11Z")]})
    runs = make_runs(date=[datetime(2025, 9, 13, 14, 47, 11), datetime(2025, 9, 13, 14, 47, 11)], duration_sec=[1800.0, float("nan")], source="apple")
    got = workout_routes(with_local_time(import_route_points(spark, pattern)), runs).collect()
    assert sorted(r["time"] for r in got) == [datetime(2025, 9, 13, 12, 47, 11), datetime(2025, 9, 13, 13, 17, 10)]
    assert {r["duration_sec"] for r in got} == {1800.0} and {r["point_export_date"] for r in got} == {datetime(2025, 9, 19)}


def frames(spark, points, intervals):
    return (spark.createDataFrame(points, "k string, at timestamp_ntz, p int"),
            spark.createDataFrame(intervals, "k string, b timestamp_ntz, e timestamp_ntz, i int"))


def brute(points, intervals):
    return sorted((i, p) for k, b, e, i in intervals for g, at, p in points if k == g and None not in (b, e, at) and b <= at < e)


@pytest.mark.parametrize("bucket_rows", [3, 50, 1_000_000])
def test_interval_join_equals_brute_force(spark, bucket_rows):
    rng = random.Random(5)
    zero = datetime(1969, 12, 31, 20)

    def moment():
        return zero + timedelta(seconds=rng.choice([rng.randrange(600), rng.randrange(40_000)]))

    keys = ["a", "a", "a", "b", None]
    points = [(rng.choice(keys), rng.choice([moment(), moment(), None]), i) for i in range(300)] + [("a", zero, 7)] * 20
    intervals = []
    for i in range(120):
        b = moment()
        length = timedelta(microseconds=rng.choice([0, -5, 1, 10**6, 4**10, 4**11 + 1, 10**9, 10**14]))
        intervals.append((rng.choice(keys), rng.choice([b, b, b, None]), b + length, i))
    intervals += intervals[:10]
    p, i = frames(spark, points, intervals)
    got = interval_join(p, i, "at", "b", "e", ["k"], bucket_rows=bucket_rows)
    assert got.columns == ["k", "b", "e", "i", "at", "p"]
    assert sorted((r["i"], r["p"]) for r in got.collect()) == brute(points, intervals)


def test_interval_join_without_groups(spark):
    zero = datetime(2025, 1, 1)
    points = [("x", zero + timedelta(hours=h), h) for h in range(48)]
    intervals = [("y", zero, zero + timedelta(days=1), 1), ("y", zero, zero + timedelta(days=3000), 2)]
    p, i = frames(spark, points, intervals)
    got = interval_join(p.drop("k"), i, "at", "b", "e", bucket_rows=5)
    assert sorted((r["i"], r["p"]) for r in got.collect()) == [(1, h) for h in range(24)] + [(2, h) for h in range(48)]


def test_interval_join_of_empty_tables_and_clashes(spark):
    p, i = frames(spark, [("a", datetime(2025, 1, 1), 1)], [("a", datetime(2025, 1, 1), datetime(2025, 1, 2), 1)])
    assert interval_join(p, i, "at", "b", "e", ["k"]).count() == 1
    assert interval_join(p.limit(0), i, "at", "b", "e", ["k"]).count() == 0
    assert interval_join(p, i.limit(0), "at", "b", "e", ["k"]).count() == 0
    with pytest.raises(ValueError, match="both sides"):
        interval_join(p, i, "at", "b", "e")


def test_interval_join_is_an_equi_join(spark):
    p, i = frames(spark, [("a", datetime(2025, 1, 1), 1)], [("a", datetime(2025, 1, 1), datetime(2025, 1, 2), 1)])
    plan = interval_join(p, i, "at", "b", "e", ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("bucket_rows", [3, 50, 1_000_000])
def test_interval_summary_equals_grouped_pairs(spark, bucket_rows):
    rng = random.Random(6)
    zero = datetime(1969, 12, 31, 20)

    def moment():
        return zero + timedelta(seconds=rng.choice([rng.randrange(600), rng.randrange(40_000)]), microseconds=rng.randrange(3))

    keys = ["a", "a", "a", "b", None]
    points = [(rng.choice(keys), rng.choice([moment(), moment(), None]), rng.choice([None, i, 7])) for i in range(400)] + [("a", zero, None)] * 20
    intervals = []
    for i in range(120):
        b = moment()
        intervals.append((rng.choice(keys), rng.choice([b, b, b, None]), b + timedelta(microseconds=rng.choice([0, -5, 1, 4**11 + 1, 10**9, 10**14])), rng.choice([i, 5, None])))
    intervals += intervals[:10]
    p, i = frames(spark, points, intervals)
    p = p.withColumn("x", F.when(F.col("p") % 11 == 0, F.lit(float("nan"))).otherwise(F.col("p") / 2))
    asked = {"n": ("count", None), "n_p": ("count", "p"), "least": ("min", "p"), "most": ("max", "x"), "first": ("min", "at"), "last": ("max", "at")}
    got = interval_summary(p, i, "at", "b", "e", ["i", "k"], asked, ["k"], bucket_rows=bucket_rows)
    want = interval_join(p, i, "at", "b", "e", ["k"]).groupBy("i", "k").agg(
        F.count(F.lit(1)).alias("n"), F.count("p").alias("n_p"), F.min("p").alias("least"), F.max("x").alias("most"), F.min("at").alias("first"), F.max("at").alias("last"))
    assert got.columns == want.columns and [f.dataType for f in got.schema] == [f.dataType for f in want.schema]
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert interval_summary(p.limit(0), i, "at", "b", "e", ["i"], asked, ["k"]).count() == 0
    assert interval_summary(p, i.limit(0), "at", "b", "e", ["i"], asked, ["k"]).count() == 0


def test_summaries_write_out_no_pairs(spark):
    """Two thousand intervals over the same two thousand points: four million pairs, of which no plan node makes rows."""
    zero = datetime(2025, 1, 1)
    p, i = frames(spark, [("a", zero + timedelta(seconds=s), s) for s in range(2000)], [("a", zero, zero + timedelta(hours=1), n) for n in range(2000)])
    got = interval_summary(p, i, "at", "b", "e", ["i"], {"n": ("count", None), "most": ("max", "p")}, ["k"])
    assert {tuple(r)[1:] for r in got.collect()} == {(2000, 1999)} and got.count() == 2000
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "SortMergeJoin" not in plan


def test_summary_cells_follow_crowded_points(spark):
    """Points within a minute and one years away: cells as narrow as the crowd asks for, not as the whole time does."""
    p = spark.range(20_000).select((F.col("id") * 3000).alias("_t"), F.lit("a").alias("k"))
    far = spark.createDataFrame([(10**15, "a")], "_t long, k string")
    wide = p.withColumn("_t", F.col("_t") * 1_000_000)
    assert intervals._summary_level(p.unionByName(far), ["k"], 800) <= 12 < intervals._summary_level(wide, ["k"], 800)
