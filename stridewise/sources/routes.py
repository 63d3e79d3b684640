"""GPX routes: the points of all tracks, their wall-clock times, and the workouts that they belong to."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stridewise.operators.intervals import interval_join, interval_summary, micros
from stridewise.operators.joins import lookup_join
from stridewise.sources.ranges import RANGE_BYTES, list_files, read_xml_elements

POINT_SCHEMA = T.StructType([
    T.StructField("_lat", T.StringType()),
    T.StructField("_lon", T.StringType()),
    T.StructField("ele", T.StringType()),
    T.StructField("time", T.StringType()),
    T.StructField("extensions", T.StructType([T.StructField("speed", T.StringType())])),
])

#: The start in a file's name, as in ``route_2025-09-13_2.47pm``; the last one of the path counts.
NAMED_START = r".*route_(\d{4}-\d{2}-\d{2})_(\d{1,2})\.(\d{2})(am|pm)"
#: Offsets of clocks from UTC come in quarters of an hour.
QUARTER = 15 * 60 * 1_000_000
_MINUTE = 60_000_000


def utc_time(c: Column) -> Column:
    """ISO text with ``Z``, an offset or nothing (UTC) to the zone-less UTC time; bad text gives null."""
    text = F.trim(c)
    offset = F.regexp_extract(text, r"T.*([+-]\d{2}:?\d{2})$", 1)
    minutes = F.when(offset == "", 0).otherwise(
        F.concat(F.substring(offset, 1, 1), F.lit("1")).try_cast("int")
        * (F.substring(offset, 2, 2).try_cast("int") * 60 + F.regexp_extract(offset, r"(\d{2})$", 1).try_cast("int")))
    wall = F.regexp_replace(text, r"(Z|[+-]\d{2}:?\d{2})$", "").try_cast("timestamp_ntz")
    return wall - F.make_dt_interval(F.lit(0), F.lit(0), minutes)


def named_start(path: Column) -> Column:
    """The wall-clock start that a file's name tells (12-hour clock, to the minute); null if it tells none."""
    def part(i: int) -> Column:
        return F.regexp_extract(path, NAMED_START, i)

    hour = part(2).try_cast("int") % 12 + F.when(part(4) == "pm", 12).otherwise(0)
    clock = F.concat(part(1), F.lit(" "), F.lpad(hour.cast("string"), 2, "0"), F.lit(":"), part(3), F.lit(":00"))
    return F.when(path.rlike(NAMED_START) & part(2).try_cast("int").between(1, 12), clock.try_cast("timestamp_ntz"))


def import_route_points(spark: SparkSession, pattern: str, source: str = "apple", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """One row per ``<trkpt>`` of all GPX files matching ``pattern``, read by byte ranges.

    ``source``, ``export_date`` (the last folder that is a date, else null), ``route`` (the file), ``position`` (the byte at which the point starts:
    the order of a route's points), ``named_start``, ``time`` (UTC, zone-less), ``lat``, ``lon``, ``elevation``, ``speed``.
    Values that are missing or no numbers are null; points stay whatever is missing. No file: an empty frame.
    """
    elements = read_xml_elements(spark, list_files(spark, pattern), "trkpt", range_bytes)
    p = elements.select(F.from_xml("record", POINT_SCHEMA).alias("p"), "file", "start")
    folder = F.regexp_extract("file", r".*/(\d{4}-\d{2}-\d{2})/", 1)
    return p.select(
        F.lit(source).alias("source"), folder.try_cast("timestamp_ntz").alias("export_date"), F.col("file").alias("route"),
        F.col("start").alias("position"), named_start(F.col("file")).alias("named_start"), utc_time(F.col("p.time")).alias("time"),
        *[F.trim(f"p.{c}").try_cast("double").alias(n)
          for c, n in [("_lat", "lat"), ("_lon", "lon"), ("ele", "elevation"), ("extensions.speed", "speed")]],
    )


def route_clocks(points: DataFrame) -> DataFrame:
    """One row per route: first and last point, count, and the clock that its name implies.

    Names tell wall-clock time, points UTC. ``offset_minutes`` is the difference to the first point, rounded to a quarter of an
    hour; ``name_agrees`` tells whether what is left is at most two minutes and the offset that of a clock on earth (-12 to +14 hours).
    Without a named start or a point with a time both are null.
    """
    seen = points.groupBy("route", "named_start").agg(
        F.min("time").alias("first_point"), F.max("time").alias("last_point"), F.count(F.lit(1)).alias("n_points"))
    apart = micros("named_start") - micros("first_point")
    quarters = F.floor((apart + F.lit(QUARTER // 2)) / F.lit(QUARTER))
    left = F.abs(apart - quarters * QUARTER)
    return seen.withColumns({
        "offset_minutes": (quarters * 15).cast("int"),
        "name_agrees": (left <= 2 * _MINUTE) & (quarters * 15).between(-12 * 60, 14 * 60),
    })


def with_local_time(points: DataFrame) -> DataFrame:
    """``points`` with ``local_time``: the wall-clock time of workouts, from the offset of the point's route.

    Null where the route's name tells no start or disagrees with its first point by other than a clock's offset.
    """
    clocks = route_clocks(points).where("name_agrees").select("route", "offset_minutes")
    shifted = lookup_join(points, clocks, ["route"])
    local = F.col("time") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("offset_minutes"))
    return shifted.withColumn("local_time", local).drop("offset_minutes")


def workout_routes(points: DataFrame, workouts: DataFrame, time: str = "local_time", begin: str = "date", seconds: str = "duration_sec",
                   by: Sequence[str] = ("source",), keys: Sequence[str] = (),
                   summary: Mapping[str, tuple[str, str | None]] | None = None) -> DataFrame:
    """Points with the workout that was going on: the 1:n join over date and time of day.

    A workout lasts ``seconds`` from ``begin``; one without either has no points. Points in the spans of
    several workouts come once for each. Columns of ``points`` whose names ``workouts`` has too get ``point_`` before them.
    See :func:`stridewise.operators.intervals.interval_join` for the plan.
    With ``summary`` the pairs are grouped by ``keys``, columns of ``workouts``, and only what is asked of each group comes back:
    see :func:`stridewise.operators.intervals.interval_summary`, which does not write out the pairs.
    """
    points = points.withColumnsRenamed({c: f"point_{c}" for c in points.columns if c in workouts.columns and c not in by})
    time = time if time in points.columns else f"point_{time}"
    stop = F.timestamp_add("MICROSECOND", F.floor(F.col(seconds) * 1_000_000).cast("long"), F.col(begin))
    workouts = workouts.withColumn("_stop", stop)
    if summary is not None:
        return interval_summary(points, workouts, time, begin, "_stop", keys, summary, by)
    return interval_join(points, workouts, time, begin, "_stop", by).drop("_stop")
