"""Thresholds and schema presets.

``CleaningConfig`` is frozen; derive variants with :func:`dataclasses.replace`,
e.g. ``replace(CleaningConfig(), distance_max=6.0)``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must equal the reference's limits for equal results.
#   distance 0.05 .. 60 km; distance bins 0, 5, 10, 15, 25, 50 (left-closed)
#   duration 60 .. 18000 s; pace 2.3 .. 10.5 min/km; average HR 80 .. 210 bpm
#   HR consistency tolerance 3 bpm; HR values <= 0 or > 300 are errors
#   calories 50 .. 3000 kcal; 25 .. 120 kcal per km; 4 HR quantiles per source
#   metre heuristic: distance above 200 means metres
#   minute heuristic: median duration within 10 .. 200 means minutes
#   running keywords: "run" (delimited exports), "running" (XML exports)
#   quality status: >= 0.95 good, >= 0.85 warning, else bad
#   date imputation: export date + 12 hours
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class CleaningConfig:
    distance_min: float = 0.05
    distance_max: float = 60.0
    distance_bins: tuple[float, ...] = (0, 5, 10, 15, 25, 50)
    duration_min: float = 60.0
    duration_max: float = 18000.0
    pace_min: float = 2.3
    pace_max: float = 10.5
    hr_min: float = 80.0
    hr_max: float = 210.0
    hr_consistency_tolerance: float = 3.0
    hr_error_above: float = 300.0
    calories_min: float = 50.0
    calories_max: float = 3000.0
    calories_per_km_min: float = 25.0
    calories_per_km_max: float = 120.0
    hr_quantiles: int = 4
    meters_threshold: float = 200.0
    minutes_median_range: tuple[float, float] = (10.0, 200.0)
    #: XML records that state their units are converted by them; the heuristics judge the others.
    declared_units: bool = False
    date_impute_hours: int = 12
    status_good: float = 0.95
    status_warning: float = 0.85


GARMIN_RUN_KEYWORD = "run"
APPLE_RUN_KEYWORD = "running"

RAW_CORE_COLUMNS = [
    "date", "activity_type", "distance_km", "duration", "calories",
    "avg_heart_rate", "max_heart_rate", "source", "export_date",
]
CORE_COLUMNS = [
    "date", "activity_type", "distance_km", "duration_sec", "calories",
    "avg_heart_rate", "max_heart_rate", "source", "export_date",
]
NUMERIC_COLUMNS = ["distance_km", "duration_sec", "calories", "avg_heart_rate", "max_heart_rate"]
CATEGORICAL_COLUMNS = ["activity_type", "source"]
ESSENTIAL_COLUMNS = ["distance_km", "duration_sec"]
DUPLICATE_KEY_COLUMNS = ["source", "date", "distance_km", "duration_sec"]
PROVENANCE_COLUMNS = ["calories_imputed", "imputation_level"]
FEATURE_COLUMNS = ["duration_min", "pace_min_per_km"]

CORE_TYPES: dict[str, T.DataType] = {
    "date": T.TimestampNTZType(),
    "activity_type": T.StringType(),
    "distance_km": T.DoubleType(),
    "duration_sec": T.DoubleType(),
    "calories": T.DoubleType(),
    "avg_heart_rate": T.DoubleType(),
    "max_heart_rate": T.DoubleType(),
    "source": T.StringType(),
    "export_date": T.TimestampNTZType(),
}
PROVENANCE_TYPES: dict[str, T.DataType] = {
    "calories_imputed": T.BooleanType(),
    "imputation_level": T.StringType(),
}
FEATURE_TYPES: dict[str, T.DataType] = {
    "duration_min": T.DoubleType(),
    "pace_min_per_km": T.DoubleType(),
}


def struct_type(types: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in types.items()])


CORE_SCHEMA = struct_type(CORE_TYPES)
CLEANED_SCHEMA = struct_type({**CORE_TYPES, **PROVENANCE_TYPES})
FINAL_SCHEMA = struct_type({**CORE_TYPES, **PROVENANCE_TYPES, **FEATURE_TYPES})
