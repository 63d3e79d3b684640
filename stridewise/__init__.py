"""stridewise: cleaning and merging of activity records on Spark DataFrames.

Every operator is a function over DataFrames or Columns. Columns and limits
are parameters, so the operators run on any table; the workout schema of
:mod:`stridewise.config` is one preset.
"""

from stridewise.config import (
    CATEGORICAL_COLUMNS,
    CORE_COLUMNS,
    DUPLICATE_KEY_COLUMNS,
    ESSENTIAL_COLUMNS,
    NUMERIC_COLUMNS,
    PROVENANCE_COLUMNS,
    RAW_CORE_COLUMNS,
    CleaningConfig,
)
from stridewise.functions.rules import (
    hr_consistency,
    valid_distance,
    valid_duration,
    valid_heart_rate,
    valid_pace,
)
from stridewise.operators.combine import add_features, concat_sources, frames_difference
from stridewise.operators.dedupe import keep_first
from stridewise.operators.heart_rate import clean_heart_rate
from stridewise.operators.impute import impute_grouped_calories, winsorise_calories
from stridewise.operators.intervals import interval_join, interval_summary
from stridewise.operators.quality import assess_quality, comparison_table, quality_report
from stridewise.operators.quantiles import exact_median, exact_percentiles
from stridewise.operators.typing import (
    clean_apple_typing,
    clean_garmin_typing,
    filter_running_apple,
    filter_running_garmin,
    reduce_to_columns,
)
from stridewise.plans.pipeline import (
    DEFAULT_STEPS,
    CleaningPipeline,
    Step,
    build_cleaning_pipeline,
    clean_runs,
    run_summary,
    step_report,
)
from stridewise.plans.run import PipelineResult, run_pipeline
from stridewise.sources.exports import (
    import_apple_workouts,
    import_garmin_activities,
    read_processed,
    write_outputs,
)
from stridewise.sources.routes import import_route_points, route_clocks, with_local_time, workout_routes

__all__ = [
    "CATEGORICAL_COLUMNS", "CORE_COLUMNS", "DUPLICATE_KEY_COLUMNS", "ESSENTIAL_COLUMNS", "NUMERIC_COLUMNS",
    "PROVENANCE_COLUMNS", "RAW_CORE_COLUMNS", "CleaningConfig",
    "hr_consistency", "valid_distance", "valid_duration", "valid_heart_rate", "valid_pace",
    "add_features", "concat_sources", "frames_difference", "keep_first", "clean_heart_rate",
    "impute_grouped_calories", "winsorise_calories", "assess_quality", "comparison_table", "quality_report",
    "exact_median", "exact_percentiles", "clean_apple_typing", "clean_garmin_typing", "filter_running_apple",
    "filter_running_garmin", "reduce_to_columns", "DEFAULT_STEPS", "CleaningPipeline", "Step",
    "build_cleaning_pipeline", "clean_runs", "run_summary", "step_report", "PipelineResult", "run_pipeline",
    "import_apple_workouts", "import_garmin_activities", "read_processed", "write_outputs",
    "import_route_points", "route_clocks", "with_local_time", "workout_routes", "interval_join", "interval_summary",
]
