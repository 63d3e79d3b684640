"""Data-quality metrics: completeness, validity, consistency, uniqueness.

All metrics of a frame (or of every group of it) come from one aggregate
job; the long report and the comparison table are reshapes of tiny results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridewise.config import DUPLICATE_KEY_COLUMNS, PROVENANCE_COLUMNS, CleaningConfig
from stridewise.functions import exprs, rules
from stridewise.session import materialize

CATEGORIES = ("completeness", "validity", "consistency", "uniqueness")


def _share(count: Column, total: Column) -> Column:
    return F.try_divide(count.cast("double"), total.cast("double"))


def metric_columns(df: DataFrame, cfg: CleaningConfig = CleaningConfig(), exclude: Sequence[str] = ()) -> list[tuple[str, str, Column]]:
    """(category, metric, aggregate Column) for every metric that applies to ``df``'s columns."""
    cols = [c for c in df.columns if c not in exclude]
    n = F.count(F.lit(1))
    out: list[tuple[str, str, Column]] = []
    for c in cols:
        if c in PROVENANCE_COLUMNS:
            continue
        out.append(("completeness", c, F.lit(1.0) - _share(n - F.count(F.col(c)), n)))
    present = set(df.columns)
    if {"distance_km", "duration_sec"} <= present:
        out.append(("validity", "distance", _share(F.count_if(rules.valid_distance(cfg)), n)))
        out.append(("validity", "duration", _share(F.count_if(rules.valid_duration(cfg)), n)))
        out.append(("validity", "pace", _share(F.count_if(rules.valid_pace(cfg)), n)))
    if "avg_heart_rate" in present:
        out.append(("validity", "hr", _share(F.count_if(rules.valid_heart_rate(cfg)), n)))
    if {"max_heart_rate", "avg_heart_rate"} <= present:
        conflict = rules.hr_consistency(cfg).conflict
        out.append(("consistency", "hr_max_vs_avg", F.lit(1.0) - _share(F.count_if(conflict), n)))
    return out


def assess_quality(df: DataFrame, cfg: CleaningConfig = CleaningConfig(), by: Sequence[str] = (),
                   exclude: Sequence[str] = ()) -> DataFrame:
    """Wide metrics, one row (per group of ``by``): ``total_rows`` and ``<category>.<metric>`` columns.

    All metrics but uniqueness come from one aggregate. Uniqueness needs the
    number of distinct business keys: it is a separate two-step aggregate
    (distinct keys, then a count per group), joined on the group, rather than
    a ``count(DISTINCT ...)`` next to the other aggregates, which would run
    every row twice through an Expand.
    """
    by = list(by)
    metrics = metric_columns(df, cfg, exclude=list(exclude))
    aggs = [F.count(F.lit(1)).alias("total_rows")] + [col.alias(f"{cat}.{m}") for cat, m, col in metrics]
    main = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    if not set(DUPLICATE_KEY_COLUMNS) <= set(df.columns):
        return main
    group_keys = by + [k for k in DUPLICATE_KEY_COLUMNS if k not in by]
    keys = df.select(*group_keys).distinct()
    count = F.count(F.lit(1)).alias("_distinct")
    distinct = keys.groupBy(*by).agg(count) if by else keys.agg(count)
    if by:
        renamed = distinct.withColumnsRenamed({k: f"_d_{k}" for k in by}).alias("d")
        joined = main.join(renamed, _all_null_safe(main, by), "left").drop(*[f"_d_{k}" for k in by])
    else:
        joined = main.withColumn("_k", F.lit(0)).join(distinct.withColumn("_k", F.lit(0)), "_k", "left").drop("_k")
    n = F.col("total_rows")
    uniq = F.lit(1.0) - _share(n - F.coalesce(F.col("_distinct"), F.lit(0)), n)
    return joined.withColumn("uniqueness.workouts", uniq).drop("_distinct")


def _all_null_safe(main: DataFrame, by: Sequence[str]) -> Column:
    cond = None
    for k in by:
        e = main[k].eqNullSafe(F.col(f"d._d_{k}"))
        cond = e if cond is None else cond & e
    return cond


def quality_long(wide: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Wide metrics to ``by..., category, metric, value, ord`` (``total_rows`` left out)."""
    names = [c for c in wide.columns if "." in c]
    pairs = F.array(*[
        F.struct(F.lit(i).alias("ord"), F.lit(n.split(".", 1)[0]).alias("category"),
                 F.lit(n.split(".", 1)[1]).alias("metric"), F.col(f"`{n}`").alias("value"))
        for i, n in enumerate(names)
    ])
    return wide.select(*by, F.inline(pairs))


def quality_report(wide: DataFrame, cfg: CleaningConfig = CleaningConfig(), by: Sequence[str] = ()) -> DataFrame:
    """Long table ``category, metric, value, status`` (status: good / warning / bad symbol)."""
    long = quality_long(wide, by)
    return long.withColumn("status", exprs.status_indicator("value", cfg)).select(
        *by, "ord", "category", "metric", "value", "status"
    )


# Row labels of the comparison table, in order.
COMPARISON_ROWS = (
    "Initial Rows", "Final Rows", "Removed Rows", "Retention Rate (%)", "Completeness (avg)", "Validity (avg)",
)


def comparison_table(summary: DataFrame, wide: DataFrame, sources: Sequence[str] | None = None, by: str = "source") -> DataFrame:
    """One row per metric, one text column per source (in the order of ``sources``, else by name).

    ``summary``: run summary per source; ``wide``: :func:`assess_quality` per
    source. A source that is not in both, or not in a given list, raises.
    """
    # both inputs are tiny aggregates read several times below: compute them once
    summary, wide = materialize(summary, "summary"), materialize(wide, "quality")
    long_q = quality_long(wide, [by])
    means = long_q.groupBy(by).agg(
        F.avg(F.when(F.col("category") == "completeness", F.col("value"))).alias("_compl"),
        F.avg(F.when(F.col("category") == "validity", F.col("value"))).alias("_valid"),
    )
    s_keys = {r[0] for r in summary.select(by).collect()}
    q_keys = {r[0] for r in wide.select(by).collect()}
    if s_keys != q_keys:
        raise ValueError(f"summaries and qualities must hold the same sources: {sorted(s_keys)} vs {sorted(q_keys)}")
    if sources is None:
        sources = sorted(s_keys, key=lambda k: (k is None, k))
    elif set(sources) != s_keys:
        raise ValueError(f"the list of sources must name them all: {sorted(sources)} vs {sorted(s_keys)}")
    j = summary.join(means, by, "inner")
    cells = F.array(
        F.struct(F.lit(0).alias("ord"), F.col("initial_rows").cast("string").alias("cell")),
        F.struct(F.lit(1).alias("ord"), F.col("final_rows").cast("string").alias("cell")),
        F.struct(F.lit(2).alias("ord"), F.col("total_removed").cast("string").alias("cell")),
        F.struct(F.lit(3).alias("ord"), exprs.percent_text("retention_rate").alias("cell")),
        F.struct(F.lit(4).alias("ord"), exprs.percent_text("_compl").alias("cell")),
        F.struct(F.lit(5).alias("ord"), exprs.percent_text("_valid").alias("cell")),
    )
    labels = F.element_at(F.array(*[F.lit(x) for x in COMPARISON_ROWS]), F.col("ord") + 1)
    long = j.select(by, F.inline(cells)).withColumn("Metrik", labels)
    return (
        long.groupBy("ord", "Metrik").pivot(by, list(sources)).agg(F.first("cell"))
        .orderBy("ord")
    )
