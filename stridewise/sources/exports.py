"""Export readers (delimited text, XML) and the Parquet/CSV sinks."""

from __future__ import annotations

import csv
import os
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stridewise.sources.publish import current_version, publish
from stridewise.sources.ranges import RANGE_BYTES, first_records, list_files, read_text_records, read_xml_elements

# Vendor column names of the delimited export and their core names.
GARMIN_RENAMES = {
    "Activity Type": "activity_type",
    "Date": "date",
    "Distance": "distance_km",
    "Calories": "calories",
    "Time": "duration",
    "Avg HR": "avg_heart_rate",
    "Max HR": "max_heart_rate",
}

# XML statistic identifiers and the activity prefix.
DISTANCE_TYPES = ("HKQuantityTypeIdentifierDistanceWalkingRunning", "HKQuantityTypeIdentifierDistanceCycling")
ENERGY_TYPE = "HKQuantityTypeIdentifierActiveEnergyBurned"
HEART_RATE_TYPE = "HKQuantityTypeIdentifierHeartRate"
ACTIVITY_PREFIX = "HKWorkoutActivityType"

WORKOUT_SCHEMA = T.StructType([
    T.StructField("_workoutActivityType", T.StringType()),
    T.StructField("_duration", T.StringType()),
    T.StructField("_startDate", T.StringType()),
    T.StructField("WorkoutStatistics", T.ArrayType(T.StructType([
        T.StructField("_type", T.StringType()),
        T.StructField("_sum", T.StringType()),
        T.StructField("_average", T.StringType()),
        T.StructField("_maximum", T.StringType()),
    ]))),
])

# The same elements with the units that they state.
UNIT_WORKOUT_SCHEMA = T.StructType([
    *[f for f in WORKOUT_SCHEMA.fields if f.name != "WorkoutStatistics"],
    T.StructField("_durationUnit", T.StringType()),
    T.StructField("WorkoutStatistics", T.ArrayType(T.StructType([
        *WORKOUT_SCHEMA["WorkoutStatistics"].dataType.elementType.fields,
        T.StructField("_unit", T.StringType()),
    ]))),
])


@dataclass(frozen=True)
class CsvDialect:
    sep: str = ";"
    encoding: str = "ISO-8859-1"
    quote: str = '"'
    #: Quoted values may hold line breaks (quotes then come in pairs); False: every line is a record, whatever its quotes.
    multi_line: bool = True


GARMIN_DIALECT = CsvDialect()


def export_folder(path_col: str = "_metadata.file_path") -> F.Column:
    """Name of the folder holding the file (the export date by convention); empty text if the path names none."""
    path = F.col(path_col)
    # a regular expression would try every place of the path, for every row
    return F.when(~F.contains(path, F.lit("/")) | path.endswith("/"), "").otherwise(F.substring_index(F.substring_index(path, "/", -2), "/", 1))


#: Where a row was read: file, byte at which its record starts, 0. Rows of one export compare by it in file order.
POSITION = "_position"
POSITION_TYPE = "struct<file: string, start: bigint, row: bigint>"


def _position() -> F.Column:
    return F.struct(F.col("file"), F.col("start"), F.lit(0).cast("long").alias("row"))


def header_names(header: str, dialect: CsvDialect) -> list[str]:
    """Column names of a header line; nameless columns are ``_c`` and their place, repeated names get their place behind them."""
    names = next(csv.reader([header], delimiter=dialect.sep, quotechar=dialect.quote), [])
    lowered = [n.lower() for n in names]
    return [f"_c{i}" if not n else f"{n}{i}" if lowered.count(n.lower()) > 1 else n for i, n in enumerate(names)]


def import_garmin_activities(spark: SparkSession, pattern: str, dialect: CsvDialect = GARMIN_DIALECT,
                             source: str = "garmin", position: bool = False, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """All delimited exports matching ``pattern``, all values as text, vendor names renamed.

    Files are grouped by header line: one read per layout, layouts unioned by name. A file is read in ranges
    of ``range_bytes`` by as many tasks, line breaks inside quoted values included; headers are read from the files' starts alone.
    ``source`` and ``export_date`` (the parent folder) are added, and with ``position`` the row's place (:data:`POSITION`). No file: an empty frame.
    """
    files = list_files(spark, pattern)
    if not files:
        return spark.createDataFrame([], "source string, export_date string")
    quote = dialect.quote if dialect.multi_line else ""
    layouts: dict[str, list[tuple[str, int]]] = defaultdict(list)
    headers = first_records(spark, files, quote, dialect.encoding)
    for f, size in files:
        layouts[headers[f].removeprefix("\ufeff")].append((f, size))
    options = {"sep": dialect.sep, "quote": dialect.quote, "escape": dialect.quote, "mode": "PERMISSIVE"}
    frames = []
    for header, layout_files in layouts.items():
        names = header_names(header, dialect)
        if not names:
            continue
        records = read_text_records(spark, layout_files, quote, range_bytes, dialect.encoding)
        fields = F.from_csv("record", ", ".join(f"c{i} string" for i in range(len(names))), options)
        raw = records.where((F.col("start") > 0) & (F.trim("record") != "")).withColumn("_f", fields).select(
            *[F.col(f"_f.c{i}").alias(GARMIN_RENAMES.get(n, n)) for i, n in enumerate(names)],
            F.lit(source).alias("source"), export_folder("file").alias("export_date"), *([_position().alias(POSITION)] if position else []),
        )
        frames.append(raw)
    if not frames:
        return spark.createDataFrame([], "source string, export_date string")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def _last_stat(stats: F.Column, types: Sequence[str], field: str) -> F.Column:
    """Field of the last statistic of one of ``types`` (last match wins), empty text if none."""
    hits = F.filter(stats, lambda s: s["_type"].isin(*types))
    return F.coalesce(F.try_element_at(hits, F.lit(-1))[field], F.lit(""))


def workouts_from_xml_frame(raw: DataFrame, export_date: F.Column, source: str = "apple",
                            extra: Sequence[str] = (), units: bool = False) -> DataFrame:
    """Flatten parsed ``Workout`` rows into the neutral import columns (all text); ``extra`` pass through.

    With ``units`` (rows of :data:`UNIT_WORKOUT_SCHEMA`) also ``duration_unit``, ``distance_unit`` and ``calories_unit``: what the
    workout and the statistics its values come from state, empty text if nothing.
    """
    st = F.coalesce(F.col("WorkoutStatistics"), F.array().cast(raw.schema["WorkoutStatistics"].dataType))
    stated = [
        F.coalesce(F.col("_durationUnit"), F.lit("")).alias("duration_unit"),
        _last_stat(st, DISTANCE_TYPES, "_unit").alias("distance_unit"),
        _last_stat(st, [ENERGY_TYPE], "_unit").alias("calories_unit"),
    ] if units else []
    return raw.select(
        F.lit(source).alias("source"),
        export_date.alias("export_date"),
        F.replace(F.coalesce(F.col("_workoutActivityType"), F.lit("")), F.lit(ACTIVITY_PREFIX), F.lit("")).alias("activity_type"),
        F.coalesce(F.col("_startDate"), F.lit("")).alias("date"),
        F.coalesce(F.col("_duration"), F.lit("")).alias("duration"),
        _last_stat(st, DISTANCE_TYPES, "_sum").alias("distance"),
        _last_stat(st, [ENERGY_TYPE], "_sum").alias("calories"),
        _last_stat(st, [HEART_RATE_TYPE], "_average").alias("avg_heart_rate"),
        _last_stat(st, [HEART_RATE_TYPE], "_maximum").alias("max_heart_rate"),
        *stated,
        *extra,
    )


def import_apple_workouts(spark: SparkSession, pattern: str, source: str = "apple", schema: T.StructType | None = None,
                          extra: Sequence[str] = (), position: bool = False, range_bytes: int = RANGE_BYTES, units: bool = False) -> DataFrame:
    """One row per ``<Workout>`` of all XML exports matching ``pattern``.

    A file is read in ranges of ``range_bytes`` by as many tasks: each seeks to the next ``<Workout`` and gives the elements
    that start in its range, whose text Spark parses with the explicit schema, which leaves out all that the import does
    not use. With ``units`` the declared units come too (:func:`workouts_from_xml_frame`). No file: an empty frame.
    """
    schema = schema or (UNIT_WORKOUT_SCHEMA if units else WORKOUT_SCHEMA)
    elements = read_xml_elements(spark, list_files(spark, pattern), "Workout", range_bytes)
    raw = elements.select(F.from_xml("record", schema).alias("_w"), "file", *([_position().alias(POSITION)] if position else []))
    raw = raw.select("_w.*", F.col("file").alias("_file"), *([POSITION] if position else []))
    return workouts_from_xml_frame(raw, export_folder("_file"), source, [*extra, *([POSITION] if position else [])], units)


def import_statistics(df: DataFrame, distance: str = "distance", duration: str = "duration", file_col: str | None = None) -> DataFrame:
    """Rows, non-empty distance, non-empty duration (and files) of an import, one row."""
    aggs = [
        F.count(F.lit(1)).alias("workouts"),
        F.count_if(F.coalesce(F.col(distance), F.lit("")) != "").alias("with_distance"),
        F.count_if(F.coalesce(F.col(duration), F.lit("")) != "").alias("with_duration"),
    ]
    if file_col:
        aggs.append(F.count_distinct(file_col).alias("files"))
    return df.agg(*aggs)


OUTPUT_BASENAME = "combined_runs"


def write_outputs(df: DataFrame, output_dir: str, basename: str = OUTPUT_BASENAME, csv_single_file: bool = False) -> dict[str, str]:
    """Parquet (the typed result) and CSV (the control copy, header, text), published together under ``output_dir``.

    Both are written from the frame held once, in its order: part files in name order hold the rows in time order.
    (Read back, Parquet files are packed into tasks by size, which would lose it.) They become current in
    one step (:mod:`stridewise.sources.publish`); a write that dies leaves the earlier pair readable.
    """
    held = df.persist(StorageLevel.MEMORY_AND_DISK)

    def csv_copy(path: str) -> None:
        (held.coalesce(1) if csv_single_file else held).write.option("header", True).csv(path)

    try:
        return publish(df.sparkSession, output_dir, basename, {"parquet": lambda path: held.write.parquet(path), "csv": csv_copy},
                       {"parquet": f"{basename}.parquet", "csv": f"{basename}.csv"})
    finally:
        held.unpersist()


def read_processed(spark: SparkSession, output_dir: str, basename: str = OUTPUT_BASENAME) -> DataFrame:
    """The Parquet file published last; a missing output raises ``AnalysisException``."""
    record = current_version(spark, output_dir, basename)
    return spark.read.parquet(record["files"]["parquet"] if record else os.path.join(output_dir, f"{basename}.parquet"))
