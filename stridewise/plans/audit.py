"""What the cleaning steps met and changed, counted in the pass that makes the cleaned rows.

Marks are columns that rows carry from the step that sees a case to the end of the plan. They are counted there,
per group in the aggregate of the step report, or by ``DataFrame.observe`` while the cleaned rows are written:
then the report costs no query and no scan of its own. Observed counts are taken in the writing
stage, above all shuffles, whose tasks Spark counts once each even if executors are lost.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from stridewise.config import CleaningConfig
from stridewise.functions import exprs, rules
from stridewise.operators import heart_rate as hr
from stridewise.operators import impute

DATES, HEART, CALORIES = "_dates_imputed", "_heart_marks", "_calorie_marks"
MARK_COLUMNS = (DATES, HEART, CALORIES)


def mark_dates(df: DataFrame) -> DataFrame:
    """Counts a row whose date will come from its export (added up over copies later)."""
    return df.withColumn(DATES, (F.col("date").isNull() & F.col("export_date").isNotNull()).cast("long"))


def marked_heart_rate(df: DataFrame, cfg: CleaningConfig, where: Column, group: str, method: str = "auto") -> DataFrame:
    """Step 5 as in :func:`stridewise.operators.heart_rate.clean_heart_rate`, with marks of conflicts and of gaps before the fill."""
    d = hr.null_hr_errors(df, cfg)
    m = rules.hr_consistency(cfg)
    d = d.withColumn(HEART, F.struct(m.inverted.alias("inverted"), m.tolerance.alias("tolerance"), m.conflict.alias("conflict")))
    d = hr.repair_hr_consistency(d, cfg)
    d = d.withColumn(HEART, F.col(HEART).withField("no_avg", F.col(hr.AVG).isNull()).withField("no_max", F.col(hr.MAX).isNull()))
    return hr.fill_with_group_median(d, group, [hr.AVG, hr.MAX], where, method)


def marked_calories(df: DataFrame, cfg: CleaningConfig, where: Column, group: str, frame_level0: bool, hr_method: str, cal_method: str) -> DataFrame:
    """Step 6 as in :func:`stridewise.operators.impute.impute_calories_step`, with marks of bad, missing and winsorised values."""
    raw = exprs.to_double("calories")
    d = df.withColumn(CALORIES, F.struct(F.coalesce(raw <= 0, F.lit(True)).alias("bad")))
    d = impute.impute_grouped_calories(d, cfg, where, group, frame_level0, hr_method, cal_method)
    filled = F.col("calories")
    d = d.withColumn(CALORIES, F.col(CALORIES).withField("filled", filled))
    d = impute.winsorise_calories(d, cfg)
    before = F.col(CALORIES)["filled"]
    absolute = exprs.clip(before, cfg.calories_min, cfg.calories_max)
    return d.withColumn(CALORIES, F.struct(
        F.col(CALORIES)["bad"].alias("bad"), before.isNull().alias("left_null"),
        exprs.changed(before, absolute).alias("absolute"), exprs.changed(absolute, "calories").alias("ratio"),
    ))


#: The figures of the steps, in the order of the report.
FIGURES = {
    1: ("dates_imputed",),
    4: ("fail_distance", "fail_duration", "fail_pace"),
    5: ("hr_inverted", "hr_tolerated", "hr_conflict", "avg_hr_null_before", "avg_hr_null_after", "max_hr_null_before", "max_hr_null_after"),
    6: ("calories_bad", "calories_null_after", "winsorised_absolute", "winsorised_ratio"),
}
ROW_COUNTS = ("_initial", "_dedup", "_d3", "_d4", "_d7")


def counts(cfg: CleaningConfig, figures: bool, own: Column | None = None) -> dict[str, Column]:
    """Aggregates by name: rows read, rows per key, rows that steps 3, 4 and 7 drop and, for marked rows, all figures.

    A figure counts rows that reach its step. ``own`` restricts all counts to some rows.
    """
    drop = F.col("_drop")

    def n(mask: Column) -> Column:
        return F.count_if(F.coalesce(mask if own is None else own & mask, F.lit(False)))

    def total(c: str) -> Column:
        return F.coalesce(F.sum(F.col(c) if own is None else F.when(own, F.col(c))), F.lit(0))

    out = {"_initial": total("_n_copies"), "_dedup": n(F.lit(True)), **{f"_d{k}": n(drop == k) for k in (3, 4, 7)}}
    if figures:
        at4, at5 = drop.isNull() | drop.isin(4, 7), drop.isNull() | (drop == 7)
        heart, cal = F.col(HEART), F.col(CALORIES)
        out |= {
            "dates_imputed": total(DATES),
            "fail_distance": n(at4 & ~rules.valid_distance(cfg)),
            "fail_duration": n(at4 & ~rules.valid_duration(cfg)),
            "fail_pace": n(at4 & ~rules.valid_pace(cfg)),
            "hr_inverted": n(at5 & heart["inverted"]),
            "hr_tolerated": n(at5 & heart["tolerance"]),
            "hr_conflict": n(at5 & heart["conflict"]),
            "avg_hr_null_before": n(at5 & heart["no_avg"]),
            "avg_hr_null_after": n(at5 & F.col(hr.AVG).isNull()),
            "max_hr_null_before": n(at5 & heart["no_max"]),
            "max_hr_null_after": n(at5 & F.col(hr.MAX).isNull()),
            "calories_bad": n(at5 & cal["bad"]),
            "calories_null_after": n(at5 & cal["left_null"]),
            "winsorised_absolute": n(at5 & cal["absolute"]),
            "winsorised_ratio": n(at5 & cal["ratio"]),
        }
    return out


def figures_long(report: DataFrame, group: str = "source") -> DataFrame:
    """``(group, step_no, figure, value)`` of a report with figures."""
    return report.select(group, "step_no", F.explode("figures").alias("figure", "value"))


def observe_counts(annotated: DataFrame, names: Sequence, group: str, cfg: CleaningConfig) -> tuple[DataFrame, Observation]:
    """The annotated rows and the observation of all counts for each of the named groups (a few, known to the driver).

    The counts are there once the frame has been written; see :func:`stridewise.plans.pipeline.observed_report`.
    """
    observation = Observation()
    metrics = [
        c.alias(f"{i}{label}") for i, name in enumerate(names) for label, c in counts(cfg, True, F.col(group).eqNullSafe(F.lit(name))).items()
    ]
    return annotated.observe(observation, *metrics), observation


def observed(observation: Observation, seconds: float = 5.0) -> dict | None:
    """What an action that has ended observed; None if the optimizer left the observed part out, as it proved empty."""
    future = observation._jo.future()
    until = time.monotonic() + seconds
    while not future.isCompleted():  # Spark tells of the end of a query a little later
        if time.monotonic() > until:
            return None
        time.sleep(0.05)
    try:
        return observation.get or None
    except Py4JJavaError:  # completed without values
        return None
