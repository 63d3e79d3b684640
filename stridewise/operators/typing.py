"""Per-source typing: activity filter, core columns, units, types.

Unit heuristics decide for a whole scope (by default the source frame, as
the reference does; ``scope`` may name a column such as ``export_date`` to
decide per export instead). The decision is an aggregate per scope joined
back (size-checked broadcast), so it never forces the data through one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stridewise.config import (
    APPLE_RUN_KEYWORD,
    CORE_COLUMNS,
    CORE_TYPES,
    GARMIN_RUN_KEYWORD,
    NUMERIC_COLUMNS,
    RAW_CORE_COLUMNS,
    CleaningConfig,
)
from stridewise.functions import exprs
from stridewise.operators.joins import lookup_join, materialize_small
from stridewise.operators.quantiles import exact_median


def filter_activity(df: DataFrame, keyword: str, col: str = "activity_type", skip_if_missing: bool = True) -> DataFrame:
    """Rows whose activity contains ``keyword`` (case-insensitive); null is dropped.

    A frame without the column is returned unchanged when ``skip_if_missing``.
    """
    if col not in df.columns:
        if skip_if_missing:
            return df
        raise KeyError(col)
    return df.where(F.lower(F.col(col)).contains(keyword.lower()))


def filter_running_garmin(df: DataFrame) -> DataFrame:
    return filter_activity(df, GARMIN_RUN_KEYWORD, skip_if_missing=True)


def filter_running_apple(df: DataFrame) -> DataFrame:
    return filter_activity(df, APPLE_RUN_KEYWORD, skip_if_missing=False)


def reduce_to_columns(df: DataFrame, columns: Sequence[str] = RAW_CORE_COLUMNS, types: dict | None = None) -> DataFrame:
    """Exactly ``columns`` in this order; missing ones are added as null."""
    types = types or {}
    present = set(df.columns)
    return df.select(*[
        F.col(c) if c in present else F.lit(None).cast(types.get(c, "string")).alias(c) for c in columns
    ])


def harmonize_names(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename ``old -> new`` only where ``old`` exists and ``new`` does not."""
    present = set(df.columns)
    todo = {o: n for o, n in mapping.items() if o in present and n not in present}
    return df.withColumnsRenamed(todo) if todo else df


def _scope_cols(scope: str | Sequence[str] | None) -> list[str]:
    if scope is None:
        return []
    return [scope] if isinstance(scope, str) else list(scope)


def scale_if_max_above(df: DataFrame, col: str, threshold: float, divisor: float, scope=None) -> DataFrame:
    """Whole-scope unit fix: if the scope's maximum of ``col`` exceeds ``threshold``, divide by ``divisor``."""
    keys = _scope_cols(scope)
    stat = df.groupBy(*keys).agg((F.max(col) > F.lit(threshold)).alias("_scale"))
    stat, n = materialize_small(stat)
    j = lookup_join(df, stat, keys, null_safe=True, small_rows=n)
    return j.withColumn(col, F.when(F.coalesce(F.col("_scale"), F.lit(False)), F.col(col) / F.lit(float(divisor))).otherwise(F.col(col))).drop("_scale")


def scale_if_median_within(df: DataFrame, col: str, lo: float, hi: float, factor: float, scope=None) -> DataFrame:
    """Whole-scope unit fix: if the scope's exact median of ``col`` lies in ``[lo, hi]``, multiply by ``factor``."""
    keys = _scope_cols(scope)
    if keys:
        med = exact_median(df, keys, col, out="_med")
    else:
        med = exact_median(df.withColumn("_all", F.lit(0)), ["_all"], col, out="_med").drop("_all")
    stat = med.select(*keys, F.col("_med").between(F.lit(lo), F.lit(hi)).alias("_scale"))
    stat, n = materialize_small(stat)
    j = lookup_join(df, stat, keys, null_safe=True, small_rows=n)
    return j.withColumn(col, F.when(F.coalesce(F.col("_scale"), F.lit(False)), F.col(col) * F.lit(factor)).otherwise(F.col(col))).drop("_scale")


def clean_garmin_typing(df: DataFrame, cfg: CleaningConfig = CleaningConfig(), scope=None, extra: Sequence[str] = ()) -> DataFrame:
    """Raw core columns (text) to the typed core schema (``extra`` columns pass through).

    European dates, ``hh:mm:ss`` durations, numeric coercion (before the metre
    heuristic, so text can never break it), metres to km above the threshold.
    """
    d = df.withColumns({
        "export_date": exprs.parse_date("export_date"),
        "date": exprs.parse_eu_datetime("date"),
        "duration_sec": exprs.duration_to_seconds("duration"),
    })
    d = d.withColumns({c: exprs.to_double(c) for c in NUMERIC_COLUMNS if c != "duration_sec"})
    d = scale_if_max_above(d, "distance_km", cfg.meters_threshold, 1000.0, scope)
    return d.select(*[F.col(c).cast(CORE_TYPES[c]).alias(c) for c in CORE_COLUMNS], *extra)


# Neutral XML import names and their core names.
APPLE_RENAMES = {"distance": "distance_km", "duration": "duration_sec"}


# Names of units and their size in seconds, kilometres and kilocalories.
DURATION_UNITS = {"s": 1.0, "sec": 1.0, "min": 60.0, "h": 3600.0, "hr": 3600.0}
DISTANCE_UNITS = {"km": 1.0, "m": 0.001, "cm": 0.00001, "mi": 1.609344, "yd": 0.0009144, "ft": 0.0003048}
ENERGY_UNITS = {"kcal": 1.0, "Cal": 1.0, "cal": 0.001, "kJ": 1 / 4.184, "J": 0.001 / 4.184}
#: Column of the stated unit and the sizes of its units, by value column.
DECLARED = {
    "duration_sec": ("duration_unit", DURATION_UNITS),
    "distance_km": ("distance_unit", DISTANCE_UNITS),
    "calories": ("calories_unit", ENERGY_UNITS),
}


def split_declared(df: DataFrame, col: str, unit: str, sizes: dict[str, float], out: str) -> DataFrame:
    """Values whose record states a known unit, converted, as ``out``; ``col`` keeps only the values without one.

    Unit names compare as written (``cal`` is not ``Cal``), spaces around them aside. A unit that is unknown is as good as none.
    """
    size = F.try_element_at(F.create_map(*[F.lit(x) for kv in sizes.items() for x in kv]), F.trim(F.coalesce(F.col(unit), F.lit(""))))
    return df.withColumns({out: F.col(col) * size, col: F.when(size.isNull(), F.col(col))})


def clean_apple_typing(df: DataFrame, cfg: CleaningConfig = CleaningConfig(), scope=None, extra: Sequence[str] = ()) -> DataFrame:
    """Neutral XML import columns to the typed core schema.

    Offsets are dropped (wall-clock time kept); a median duration within the
    minute range means minutes (x 60); any distance above the threshold means
    metres (/ 1000). Missing columns become null.

    Where a column of declared units is there (``duration_unit``, ``distance_unit``, ``calories_unit``), a record that states a
    known unit is converted by it and has no part in the heuristics, which then look at, and change, the other records only.
    """
    d = harmonize_names(df, APPLE_RENAMES)
    d = d.withColumns({
        "date": exprs.strip_utc_offset("date") if "date" in d.columns else F.lit(None).cast("timestamp_ntz"),
        "export_date": exprs.parse_date("export_date") if "export_date" in d.columns else F.lit(None).cast("timestamp_ntz"),
    })
    d = d.withColumns({c: exprs.to_double(c) if c in d.columns else F.lit(None).cast("double") for c in NUMERIC_COLUMNS})
    stated = [c for c, (unit, _) in DECLARED.items() if unit in d.columns]
    for c in stated:
        d = split_declared(d, c, *DECLARED[c], out=f"_declared_{c}")
    lo, hi = cfg.minutes_median_range
    d = scale_if_median_within(d, "duration_sec", lo, hi, 60.0, scope)
    d = scale_if_max_above(d, "distance_km", cfg.meters_threshold, 1000.0, scope)
    d = d.withColumns({c: F.coalesce(F.col(f"_declared_{c}"), F.col(c)) for c in stated})
    return reduce_to_columns(d, [*CORE_COLUMNS, *extra], CORE_TYPES).select(
        *[F.col(c).cast(CORE_TYPES[c]).alias(c) for c in CORE_COLUMNS], *extra
    )
