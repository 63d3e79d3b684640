"""The whole chain: import, type, clean, measure, combine, derive, write.

Both sources are cleaned in one plan (every statistic is per source), so
the data is scanned once per statistic rather than once per source.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stridewise.config import CORE_COLUMNS, RAW_CORE_COLUMNS, CleaningConfig
from stridewise.operators import combine, quality
from stridewise.operators.typing import (
    clean_apple_typing,
    clean_garmin_typing,
    filter_running_apple,
    filter_running_garmin,
    reduce_to_columns,
)
from stridewise.plans import pipeline as pl
from stridewise.plans.audit import observe_counts, observed
from stridewise.session import materialize as materialize_table
from stridewise.sources.exports import POSITION, import_apple_workouts, import_garmin_activities, write_outputs
from stridewise.sources.ranges import list_files

# Pipeline source names as in the reference's reports.
SOURCE_GARMIN = "Garmin"
SOURCE_APPLE = "Apple"
PIPELINE_SOURCE = "_pipeline_source"


@dataclass(frozen=True)
class PipelineResult:
    data: DataFrame
    reports: dict[str, list[dict]]
    summaries: dict[str, dict]
    qualities: dict[str, dict]
    outputs: dict[str, str] = field(default_factory=dict)
    imports: dict[str, dict] = field(default_factory=dict)  # source: files, workouts, with_distance, with_duration


def _import_counts(df: DataFrame, distance: str, duration: str) -> tuple[DataFrame, Observation]:
    """Rows and filled core values of an import, observed while its rows are written (before the activity filter)."""
    def filled(c: str) -> F.Column:
        return F.count_if(F.coalesce(F.col(c), F.lit("")) != "") if c in df.columns else F.count_if(F.lit(False))

    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("workouts"), filled(distance).alias("with_distance"), filled(duration).alias("with_duration")), seen


def prepare_garmin(spark: SparkSession, pattern: str, cfg: CleaningConfig, materialize: bool = True, imports: dict | None = None) -> DataFrame | None:
    """Import, keep running activities, reduce to the raw core columns, type.

    The filtered raw rows are written once, so the text is parsed once for the emptiness check, the
    unit heuristic and the cleaning that follow; ``imports`` takes the import's counts, observed in that pass.
    """
    raw = import_garmin_activities(spark, pattern, position=True)
    if "activity_type" not in raw.columns and len(raw.columns) <= 2:
        return None
    raw, seen = _import_counts(raw, "distance_km", "duration")
    core = reduce_to_columns(filter_running_garmin(raw), [*RAW_CORE_COLUMNS, POSITION])
    if materialize:
        core = materialize_table(core, "garmin-raw")
        if imports is not None:
            imports[SOURCE_GARMIN] = {"files": len(list_files(spark, pattern)), **(observed(seen) or {})}
    return clean_garmin_typing(core, cfg, extra=[POSITION])


def prepare_apple(spark: SparkSession, pattern: str, cfg: CleaningConfig, materialize: bool = True, imports: dict | None = None) -> DataFrame | None:
    """Import, keep running workouts, type; the XML is parsed once (see :func:`prepare_garmin`)."""
    files = list_files(spark, pattern)
    if not files:
        return None
    raw, seen = _import_counts(import_apple_workouts(spark, pattern, position=True, units=cfg.declared_units), "distance", "duration")
    runs = filter_running_apple(raw)
    if materialize:
        runs = materialize_table(runs, "apple-raw")
        if imports is not None:
            imports[SOURCE_APPLE] = {"files": len(files), **(observed(seen) or {})}
    return clean_apple_typing(runs, cfg, extra=[POSITION])


def _nested_quality(row: dict) -> dict:
    out: dict = {"total_rows": row["total_rows"], **{c: {} for c in quality.CATEGORIES}}
    for k, v in row.items():
        if "." in k:
            cat, metric = k.split(".", 1)
            out[cat][metric] = v
    return out


def run_pipeline(
    spark: SparkSession,
    garmin_path: str,
    apple_path: str,
    output_dir: str | None = None,
    config: CleaningConfig | None = None,
    materialize: bool = True,
) -> PipelineResult:
    """Run everything; a source without running activities is skipped, no data at all raises ``ValueError``."""
    cfg = config or CleaningConfig()
    imports: dict[str, dict] = {}
    typed = {SOURCE_GARMIN: prepare_garmin(spark, garmin_path, cfg, materialize, imports),
             SOURCE_APPLE: prepare_apple(spark, apple_path, cfg, materialize, imports)}
    present = {name: df for name, df in typed.items() if df is not None and not df.isEmpty()}
    if not present:
        raise ValueError(f"no source delivered running activities: garmin_path={garmin_path!r}, apple_path={apple_path!r}")
    order = list(present)
    tagged = [df.withColumn(PIPELINE_SOURCE, F.lit(name)) for name, df in present.items()]
    stacked = tagged[0]
    for t in tagged[1:]:
        stacked = stacked.unionByName(t)
    annotated = pl.annotate_runs(stacked, cfg, PIPELINE_SOURCE, materialize, audit=True)
    counts = None
    if materialize:
        # the report is taken while the cleaned rows are written
        watched, seen = observe_counts(annotated, order, PIPELINE_SOURCE, cfg)
        data = materialize_table(pl.kept_rows(watched, cfg).drop(POSITION), "cleaned")
        counts = observed(seen)
    else:
        data = pl.kept_rows(annotated, cfg).drop(POSITION)
    if counts:
        report_rows = pl.observed_report(counts, order, PIPELINE_SOURCE)
    else:
        report_rows = [r.asDict() for r in pl.step_report(annotated, PIPELINE_SOURCE, cfg).orderBy(PIPELINE_SOURCE, "step_no").collect()]
    pl.check_critical(report_rows, PIPELINE_SOURCE)
    reports = {name: [r for r in report_rows if r[PIPELINE_SOURCE] == name] for name in order}
    summaries = {}
    for name, steps in reports.items():
        initial, final = steps[0]["rows_before"], steps[-1]["rows_after"]
        summaries[name] = {"source": name, "initial_rows": initial, "final_rows": final,
                           "total_removed": initial - final,
                           "retention_rate": final / initial if initial > 0 else 0.0}
    measured = data.select(*CORE_COLUMNS, "calories_imputed", "imputation_level", PIPELINE_SOURCE)
    q_rows = quality.assess_quality(measured, cfg, by=[PIPELINE_SOURCE], exclude=[PIPELINE_SOURCE]).collect()
    qualities = {r[PIPELINE_SOURCE]: _nested_quality(r.asDict()) for r in q_rows}
    frames = [data.where(F.col(PIPELINE_SOURCE) == name).drop(PIPELINE_SOURCE) for name in order]
    combined = combine.add_features(combine.concat_sources(frames, "date", tie_breakers=CORE_COLUMNS))
    outputs = write_outputs(combined, output_dir) if output_dir is not None else {}
    return PipelineResult(combined, reports, summaries, qualities, outputs, imports)
