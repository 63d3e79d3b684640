"""Grouped-median imputation of calories with a four-level fallback.

level3 = same group, distance bin and HR bin; level2 = same group and
distance bin; level1 = same group; level0 = whole frame (or, inside the
pipeline, again the group, because the pipeline cleans one source at a time).
Null bins are real groups and match each other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridewise.config import CleaningConfig
from stridewise.functions import exprs
from stridewise.operators.joins import lookup_join, materialize_small
from stridewise.operators.quantiles import HIST_MAX_DISTINCT, choose_method, exact_percentiles, widest_group

DIST_BIN, HR_BIN = "_dist_bin", "_hr_bin"


def with_distance_bin(df: DataFrame, cfg: CleaningConfig = CleaningConfig(), col: str = "distance_km", out: str = DIST_BIN) -> DataFrame:
    return df.withColumn(out, exprs.distance_bin(exprs.to_double(col), cfg.distance_bins))


def hr_edges(df: DataFrame, cfg: CleaningConfig = CleaningConfig(), col: str = "avg_heart_rate", group: str = "source",
             where: Column | None = None, method: str = "auto") -> DataFrame:
    """Per group: exact quantile edges at 0, 1/q, ..., 1 and the number of distinct values."""
    base = df if where is None else df.where(where)
    base = base.where(F.col(group).isNotNull())
    q = cfg.hr_quantiles
    probs = [i / q for i in range(q + 1)]
    e = exact_percentiles(base, [group], col, probs, out="_edges", method=method)
    return e.select(group, "_edges", F.col("n_distinct").alias("_nd"))


def hr_bin_expr(hr: Column, edges: Column, n_distinct: Column, quantiles: int) -> Column:
    """Quantile bin 1..n from the edges (right-closed, lowest value in bin 1, repeated edges merged).

    With fewer than ``quantiles`` but at least 2 distinct values: two equal-width
    halves, the midpoint in the lower one. Otherwise null.
    """
    qbin = F.greatest(F.lit(1), F.size(F.filter(F.array_distinct(edges), lambda e: e < hr)))
    lo, hi = F.element_at(edges, 1), F.element_at(edges, -1)
    half = F.when(hr <= lo + (hi - lo) / F.lit(2.0), F.lit(1)).otherwise(F.lit(2))
    return (
        F.when(hr.isNull(), F.lit(None).cast("int"))
        .when(n_distinct >= quantiles, qbin)
        .when(n_distinct >= 2, half)
    )


def with_hr_bin(df: DataFrame, cfg: CleaningConfig = CleaningConfig(), col: str = "avg_heart_rate", group: str = "source",
                where: Column | None = None, out: str = HR_BIN, method: str = "auto") -> DataFrame:
    """HR quantile bins per group, edges computed over ``where`` rows; null group -> null bin."""
    edges, n = materialize_small(hr_edges(df, cfg, col, group, where, method))
    j = lookup_join(df, edges, [group], small_rows=n)
    hr = exprs.to_double(col)
    return j.withColumn(out, hr_bin_expr(hr, F.col("_edges"), F.col("_nd"), cfg.hr_quantiles)).drop("_edges", "_nd")


def _grouping_id(level: Sequence[str], all_keys: Sequence[str]) -> int:
    n = len(all_keys)
    return sum(1 << (n - 1 - i) for i, k in enumerate(all_keys) if k not in level)


def median_levels(df: DataFrame, value: str, levels: Sequence[Sequence[str]], where: Column | None = None,
                  method: str = "auto", max_distinct: int = HIST_MAX_DISTINCT) -> DataFrame:
    """Exact medians of ``value`` for each grouping set in ``levels``, in one pass.

    Output: ``gid`` (Spark ``grouping_id`` over the union of the keys), the
    keys (null where not grouped, or where the key itself is null), ``median``.
    Pairs ``(keys, value) -> count`` are aggregated first, so every grouping
    set reads distinct values only.
    """
    all_keys: list[str] = []
    for lvl in levels:
        for k in lvl:
            if k not in all_keys:
                all_keys.append(k)
    sets: list[list[str]] = []
    for lvl in levels:
        if list(lvl) not in sets:
            sets.append(list(lvl))
    base = df if where is None else df.where(where)
    v = exprs.to_double(value)
    if method == "auto":
        # the bound must hold for the coarsest grouping, whose groups have the most distinct values
        coarsest = min(sets, key=len)
        method = choose_method(widest_group(base.withColumn("_v", v), coarsest, ["_v"])["_v"], max_distinct)
    if method == "rank":
        # unbounded domains: one rank plan per grouping set, tagged with its grouping id
        parts = []
        for s_ in sets:
            gid = _grouping_id(s_, all_keys)
            m = exact_percentiles(base.withColumn("_v", v), list(s_), "_v", [0.5], out="_q", method="rank")
            parts.append(m.select(F.lit(gid).cast("long").alias("gid"),
                                  *[F.col(k) if k in s_ else F.lit(None).cast(base.schema[k].dataType).alias(k) for k in all_keys],
                                  F.col("_q")[0].alias("median")))
        out = parts[0]
        for p_ in parts[1:]:
            out = out.unionByName(p_)
        return out
    pairs = (
        base.select(*all_keys, v.alias("_v"))
        .where(F.col("_v").isNotNull())
        .groupBy(*all_keys, "_v")
        .agg(F.count(F.lit(1)).alias("_w"))
    )
    if not all_keys:
        return pairs.agg(F.lit(0).alias("gid"), F.percentile(F.col("_v"), F.lit(0.5), F.col("_w")).alias("median"))
    grouped = pairs.groupingSets([[F.col(k) for k in s] for s in sets], *[F.col(k) for k in all_keys])
    return grouped.agg(
        F.grouping_id().alias("gid"),
        F.percentile(F.col("_v"), F.lit(0.5), F.col("_w")).alias("median"),
    ).select("gid", *all_keys, "median")


def level_names(levels: Sequence[Sequence[str]]) -> list[str]:
    return [f"level{len(levels) - 1 - i}" for i in range(len(levels))]


def impute_grouped(
    df: DataFrame,
    target: str,
    levels: Sequence[Sequence[str]],
    where: Column | None = None,
    flag: str = "calories_imputed",
    level_col: str = "imputation_level",
    method: str = "auto",
) -> DataFrame:
    """Fill nulls of ``target`` with the median of the first level that has one.

    ``levels`` runs from the most specific grouping to the least; lookups are
    null-safe equi-joins against the (small, size-checked) median table.
    Sets ``flag`` (was the value filled?) and ``level_col`` (``levelN`` or null).
    A row for which no level has a median keeps null and gets the last level.
    """
    names = level_names(levels)
    all_keys: list[str] = []
    for lvl in levels:
        all_keys += [k for k in lvl if k not in all_keys]
    med, n = materialize_small(median_levels(df, target, levels, where, method))
    out = df
    for i, lvl in enumerate(levels):
        gid = _grouping_id(lvl, all_keys)
        tab = med.where(F.col("gid") == gid).select(*lvl, F.col("median").alias(f"_m{i}"))
        # the empty grouping set has exactly one row
        out = lookup_join(out, tab, list(lvl), null_safe=True, small_rows=n if lvl else 1)
    t = F.col(target)
    filled = F.coalesce(t, *[F.col(f"_m{i}") for i in range(len(levels))])
    lvl_expr = F.when(t.isNotNull(), F.lit(None).cast("string"))
    for i, name in enumerate(names[:-1]):
        lvl_expr = lvl_expr.when(F.col(f"_m{i}").isNotNull(), F.lit(name))
    lvl_expr = lvl_expr.otherwise(F.lit(names[-1]))
    return out.withColumns({target: filled, flag: t.isNull(), level_col: lvl_expr}).drop(
        *[f"_m{i}" for i in range(len(levels))]
    )


def calorie_levels(group: str = "source", frame_level0: bool = True) -> list[list[str]]:
    last = [] if frame_level0 else [group]
    return [[group, DIST_BIN, HR_BIN], [group, DIST_BIN], [group], last]


def impute_grouped_calories(
    df: DataFrame,
    cfg: CleaningConfig = CleaningConfig(),
    where: Column | None = None,
    group: str = "source",
    frame_level0: bool = True,
    hr_method: str = "auto",
    cal_method: str = "auto",
) -> DataFrame:
    """Calories <= 0 become null, then the four-level fallback fills them.

    ``frame_level0=True`` (stand-alone use) takes level0 over the whole frame;
    the pipeline passes False, so level0 is the group's own median.
    """
    d = df.withColumn("calories", exprs.positive_or_null(exprs.to_double("calories")))
    d = with_distance_bin(d, cfg)
    d = with_hr_bin(d, cfg, group=group, where=where, method=hr_method)
    d = impute_grouped(d, "calories", calorie_levels(group, frame_level0), where, method=cal_method)
    return d.drop(DIST_BIN, HR_BIN)


def winsorise_calories(df: DataFrame, cfg: CleaningConfig = CleaningConfig(), col: str = "calories", dist: str = "distance_km") -> DataFrame:
    """Clip to the absolute limits, then clip kcal/km and scale back (rounded half to even)."""
    c1 = exprs.clip(col, cfg.calories_min, cfg.calories_max)
    per_km = exprs.clip(F.try_divide(c1, F.col(dist)), cfg.calories_per_km_min, cfg.calories_per_km_max)
    return df.withColumn(col, F.bround(per_km * F.col(dist), 0))


def impute_calories_step(df: DataFrame, cfg: CleaningConfig = CleaningConfig(), where: Column | None = None,
                         group: str = "source", frame_level0: bool = True, hr_method: str = "auto",
                         cal_method: str = "auto") -> DataFrame:
    """Step 6: imputation, then winsorising."""
    return winsorise_calories(impute_grouped_calories(df, cfg, where, group, frame_level0, hr_method, cal_method), cfg)


def imputation_summary(df: DataFrame, by: Sequence[str] = (), flag: str = "calories_imputed",
                       level_col: str = "imputation_level") -> DataFrame:
    """How many values each fallback level filled (imputed rows only)."""
    return df.where(F.col(flag)).groupBy(*by, level_col).agg(F.count(F.lit(1)).alias("rows"))
