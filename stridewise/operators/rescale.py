"""Rescaling of numeric columns: standard scores, min-max, and the Yeo-Johnson power transform."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridewise.functions.exprs import safe_ratio, to_double
from stridewise.operators.joins import lookup_join, materialize_small


def _scaled(df: DataFrame, cols: Sequence[str], by: Sequence[str], suffix: str, centre, spread) -> DataFrame:
    """``(value - centre) / spread`` with both taken per group in one aggregate; 0 where a group has no spread, null stays null."""
    by = list(by)
    stats = [f(to_double(c)).alias(f"_{k}{i}") for i, c in enumerate(cols) for k, f in (("c", centre), ("s", spread))]
    table, n = materialize_small(df.groupBy(*by).agg(*stats))
    joined = lookup_join(df, table, by, null_safe=True, small_rows=n)
    out = {f"{c}{suffix}": F.when(to_double(c).isNotNull(), safe_ratio(to_double(c) - F.col(f"_c{i}"), F.col(f"_s{i}"))) for i, c in enumerate(cols)}
    return joined.withColumns(out).drop(*[f"_{k}{i}" for i in range(len(cols)) for k in "cs"])


def standardise(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), suffix: str = "_std") -> DataFrame:
    """Adds standard scores (population standard deviation), per group of ``by`` or over the whole frame."""
    return _scaled(df, cols, by, suffix, F.avg, F.stddev_pop)


def min_max(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), suffix: str = "_01") -> DataFrame:
    """Adds values rescaled to 0 to 1, per group of ``by`` or over the whole frame."""
    return _scaled(df, cols, by, suffix, F.min, lambda x: F.max(x) - F.min(x))


def yeo_johnson(c: str | Column, exponent: float) -> Column:
    """The power transform with one exponent; defined for negative values too."""
    x = to_double(c)
    up = F.log1p(x) if exponent == 0 else (F.pow(x + 1, F.lit(float(exponent))) - 1) / F.lit(float(exponent))
    down = -F.log1p(-x) if exponent == 2 else -(F.pow(1 - x, F.lit(2.0 - exponent)) - 1) / F.lit(2.0 - exponent)
    return F.when(x >= 0, up).when(x < 0, down)


def exponent_grid(centre: float, step: float, reach: int) -> list[float]:
    return [centre + k * step for k in range(-reach, reach + 1)]


def yeo_johnson_exponents(df: DataFrame, cols: Sequence[str], reach: int = 5, rounds: int = 5) -> dict[str, float]:
    """The exponent of each column under which the transformed values are most likely normal.

    A grid of ``2 reach + 1`` exponents around 0 is judged for all columns in one
    aggregate (the variance under each exponent and the sum of signed logarithms give the likelihood); each further round
    looks between the neighbours of the best one, ``reach`` times finer. So a round is one scan, and a
    column without two different values keeps 1 (no change). Searches ``-reach`` to ``reach``.
    """
    best, step = {c: 0.0 for c in cols}, 1.0
    settled: set[str] = set()
    for _ in range(rounds):
        aggregates = []
        for i, c in enumerate(cols):
            x = to_double(c)
            aggregates += [F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}"), F.count(x).alias(f"n{i}"), F.sum(F.signum(x) * F.log1p(F.abs(x))).alias(f"s{i}")]
            aggregates += [F.var_pop(yeo_johnson(c, e)).alias(f"v{i}_{k}") for k, e in enumerate(exponent_grid(best[c], step, reach))]
        row = df.agg(*aggregates).first()
        for i, c in enumerate(cols):
            likely = []
            if row[f"lo{i}"] == row[f"hi{i}"]:  # one value or none
                settled.add(c)
                continue
            for k, e in enumerate(exponent_grid(best[c], step, reach)):
                v, n = row[f"v{i}_{k}"], row[f"n{i}"]
                if v is not None and v > 0 and math.isfinite(v):
                    likely.append((-0.5 * n * math.log(v) + (e - 1) * row[f"s{i}"], -k, e))
            if likely:
                best[c] = max(likely)[2]
        step /= reach
    return {c: 1.0 if c in settled else best[c] for c in cols}


def power_transform(df: DataFrame, cols: Sequence[str], exponents: dict[str, float] | None = None, suffix: str = "_yj") -> DataFrame:
    """Adds the transformed columns; exponents are estimated where none are given."""
    exponents = exponents or yeo_johnson_exponents(df, cols)
    return df.withColumns({f"{c}{suffix}": yeo_johnson(c, exponents[c]) for c in cols})
