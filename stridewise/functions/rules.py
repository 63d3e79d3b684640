"""Plausibility rules as boolean Columns.

A rule returns a Column that is True for plausible rows and never null:
a missing value counts as implausible. Callers decide whether to filter,
repair or count with it (``filter``, ``when``, ``count_if``).
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from stridewise.config import CleaningConfig


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def in_range(c: str | Column, lo: float, hi: float) -> Column:
    """Inclusive range check; null (and NaN) count as False."""
    x = _c(c)
    return F.coalesce(x.between(F.lit(lo), F.lit(hi)) & ~F.isnan(x), F.lit(False))


def ratio(num: str | Column, den: str | Column) -> Column:
    """``num / den``; null where ``den`` is 0 or null (ANSI-safe)."""
    return F.try_divide(_c(num), _c(den))


def pace_min_per_km(duration_sec: str | Column = "duration_sec", distance_km: str | Column = "distance_km") -> Column:
    return ratio(_c(duration_sec) / F.lit(60.0), distance_km)


def valid_distance(cfg: CleaningConfig, col: str = "distance_km") -> Column:
    return in_range(col, cfg.distance_min, cfg.distance_max)


def valid_duration(cfg: CleaningConfig, col: str = "duration_sec") -> Column:
    return in_range(col, cfg.duration_min, cfg.duration_max)


def valid_pace(cfg: CleaningConfig, duration: str = "duration_sec", distance: str = "distance_km") -> Column:
    return in_range(pace_min_per_km(duration, distance), cfg.pace_min, cfg.pace_max)


def valid_heart_rate(cfg: CleaningConfig, col: str = "avg_heart_rate") -> Column:
    return in_range(col, cfg.hr_min, cfg.hr_max)


def all_present(cols: list[str]) -> Column:
    """True where none of ``cols`` is null."""
    out = F.lit(True)
    for c in cols:
        out = out & F.col(c).isNotNull()
    return out


class HrConsistency(NamedTuple):
    inverted: Column
    tolerance: Column
    conflict: Column


def hr_consistency(cfg: CleaningConfig, avg: str = "avg_heart_rate", mx: str = "max_heart_rate") -> HrConsistency:
    """Masks for ``max < avg``: all inverted rows, those within the tolerance, the rest."""
    a, m = F.col(avg), F.col(mx)
    inverted = F.coalesce(a.isNotNull() & m.isNotNull() & (m < a), F.lit(False))
    tolerance = inverted & F.coalesce((a - m) <= F.lit(cfg.hr_consistency_tolerance), F.lit(False))
    return HrConsistency(inverted, tolerance, inverted & ~tolerance)
