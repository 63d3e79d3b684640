"""Heart-rate cleaning: error nulling, consistency repair, median fill per source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridewise.config import CleaningConfig
from stridewise.functions import exprs, rules
from stridewise.operators.joins import lookup_join, materialize_small
from stridewise.operators.quantiles import exact_percentiles

AVG, MAX = "avg_heart_rate", "max_heart_rate"


def null_hr_errors(df: DataFrame, cfg: CleaningConfig = CleaningConfig(), cols=(AVG, MAX)) -> DataFrame:
    """Values ``<= 0`` or above ``cfg.hr_error_above`` become null, each column on its own."""
    return df.withColumns({c: exprs.null_outside_open_closed(c, 0.0, cfg.hr_error_above) for c in cols})


def repair_hr_consistency(df: DataFrame, cfg: CleaningConfig = CleaningConfig(), avg: str = AVG, mx: str = MAX) -> DataFrame:
    """``max < avg`` within the tolerance: max := avg; beyond it: both null."""
    m = rules.hr_consistency(cfg, avg, mx)
    return df.withColumns({
        mx: F.when(m.conflict, F.lit(None).cast("double")).when(m.tolerance, F.col(avg)).otherwise(F.col(mx)),
        avg: F.when(m.conflict, F.lit(None).cast("double")).otherwise(F.col(avg)),
    })


def median_by_group(df: DataFrame, group: str, cols: list[str], where: Column | None = None,
                    method: str = "auto") -> DataFrame:
    """Exact median of each of ``cols`` per ``group`` value, one pass.

    The columns are stacked into ``(group, column, value)`` so a single
    exact-percentile plan serves all of them. Rows with a null group are left
    out (a null group gets no median), as are rows outside ``where``.
    """
    base = df if where is None else df.where(where)
    base = base.where(F.col(group).isNotNull())
    stacked = base.select(
        F.col(group),
        F.explode(F.array(*[F.struct(F.lit(c).alias("_col"), F.col(c).cast("double").alias("_val")) for c in cols])).alias("_s"),
    ).select(group, "_s._col", "_s._val")
    med = exact_percentiles(stacked, [group, "_col"], "_val", [0.5], out="_q", method=method)
    return (
        med.groupBy(group)
        .pivot("_col", cols)
        .agg(F.first(F.col("_q")[0]))
        .select(group, *[F.col(c).alias(f"{c}_median") for c in cols])
    )


def fill_with_group_median(
    df: DataFrame, group: str, cols: list[str], where: Column | None = None, method: str = "auto"
) -> DataFrame:
    """Nulls of ``cols`` := exact median of the same ``group`` (computed over ``where`` rows)."""
    med, n = materialize_small(median_by_group(df, group, cols, where, method))
    joined = lookup_join(df, med, [group], small_rows=n)
    return joined.withColumns({c: F.coalesce(F.col(c), F.col(f"{c}_median")) for c in cols}).drop(
        *[f"{c}_median" for c in cols]
    )


def clean_heart_rate(df: DataFrame, cfg: CleaningConfig = CleaningConfig(), where: Column | None = None,
                     group: str = "source", method: str = "auto") -> DataFrame:
    """Step 5: error nulling, consistency repair, median fill per ``group``.

    ``where`` restricts the rows that feed the medians (rows still in play);
    ``method`` is the exact-percentile plan (``auto`` measures first).
    """
    df = repair_hr_consistency(null_hr_errors(df, cfg), cfg)
    return fill_with_group_median(df, group, [AVG, MAX], where, method)
