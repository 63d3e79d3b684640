"""Exploration helpers: value counts, distinct values, numeric summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stridewise.operators.quantiles import exact_percentiles


def value_counts(df: DataFrame, col: str, out: str = "count") -> DataFrame:
    """Frequency of each value (nulls left out), most frequent first."""
    return (
        df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias(out))
        .orderBy(F.col(out).desc(), F.col(col))
    )


def unique_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def describe(df: DataFrame, cols: Sequence[str], decimals: int | None = None) -> DataFrame:
    """count, mean, std (sample), min, 25%, 50%, 75%, max per column, quartiles exact.

    One row per column. The columns are stacked into ``(column, value)`` so a
    single aggregate and a single exact-percentile plan serve all of them.
    """
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in cols
    ])).alias("s")).select("s.column", "s.v").where(F.col("v").isNotNull() & ~F.isnan("v"))
    moments = stacked.groupBy("column").agg(
        F.count(F.lit(1)).alias("count"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"),
        F.min("v").alias("min"), F.max("v").alias("max"),
    )
    qs = exact_percentiles(stacked, ["column"], "v", [0.25, 0.5, 0.75], out="_q").select(
        "column", F.col("_q")[0].alias("p25"), F.col("_q")[1].alias("p50"), F.col("_q")[2].alias("p75")
    )
    out = moments.join(qs, "column", "left").select("column", "count", "mean", "std", "min", "p25", "p50", "p75", "max")
    if decimals is not None:
        out = out.withColumns({c: F.round(c, decimals) for c in ["mean", "std", "min", "p25", "p50", "p75", "max"]})
    return out
