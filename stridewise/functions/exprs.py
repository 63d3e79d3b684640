"""Scalar expressions: text parsing, coercion, repair and presentation.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen; none needs a Python UDF.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from stridewise.config import CleaningConfig


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: str | Column) -> Column:
    x = _c(c)
    return F.when(~F.isnan(x), x)


def to_double(c: str | Column) -> Column:
    """Numeric coercion: unparsable text becomes null, and so does NaN.

    For columns that are numbers already the optimizer drops the text branch, as their type is known in the plan.
    """
    x = _c(c)
    text = x.cast("string")
    return F.when(F.typeof(x) == "string", F.when(~text.rlike(_NO_NUMBER), text.try_cast("double"))).otherwise(nan_to_null(x.try_cast("double")))


#: Texts that the JVM would take for numbers: with its type letters after digits (``12d``, ``1.5f``), and NaN.
_NO_NUMBER = r"(?i)[0-9.]\s*[df]\s*(?::|$)|nan"


def duration_to_seconds(c: str | Column) -> Column:
    """``hh:mm:ss``, ``mm:ss`` or a plain number (fractions allowed) to seconds.

    Null, unparsable parts or four and more parts give null. One pattern check for the whole
    text; parts are cut only in the branch that their number selects.
    """
    s = _c(c).cast("string")
    colons = F.length(s) - F.length(F.replace(s, F.lit(":"), F.lit("")))

    def number(part: Column) -> Column:
        return part.try_cast("double")

    first, last = number(F.substring_index(s, ":", 1)), number(F.substring_index(s, ":", -1))
    return F.when(s.rlike(_NO_DURATION), F.lit(None).cast("double")).when(
        colons == 2, first * 3600 + number(F.split_part(s, F.lit(":"), F.lit(2))) * 60 + last
    ).when(colons == 1, first * 60 + last).when(colons == 0, number(s))


#: As :data:`_NO_NUMBER`; negative infinity as well, so that no sum of parts is NaN.
_NO_DURATION = _NO_NUMBER + r"|-\s*inf"


_EU_DATE = r"^(\d{1,2})\.(\d{1,2})\.(\d{4}) (\d{1,2}):(\d{1,2})$"


def parse_eu_datetime(c: str | Column) -> Column:
    """``dd.MM.yyyy HH:mm`` to a zone-less timestamp; anything else gives null.

    Day and month are never swapped. The value never passes through the
    session zone (wall-clock time is kept). One pattern check, one split.
    """
    s = F.trim(_c(c).cast("string"))
    ok = s.rlike(_EU_DATE)
    p = F.split(s, r"[.: ]")

    def g(i: int, width: int) -> Column:
        return F.lpad(p.getItem(i), width, "0")

    iso = F.concat(g(2, 4), F.lit("-"), g(1, 2), F.lit("-"), g(0, 2), F.lit(" "), g(3, 2), F.lit(":"), g(4, 2), F.lit(":00"))
    return F.when(ok, iso.try_cast("timestamp_ntz"))


_OFFSET = r"\s*(Z|[+-]\d{2}:?\d{2})$"


def strip_utc_offset(c: str | Column) -> Column:
    """Drop a trailing UTC offset (``+0200``, ``-05:00``, ``Z``) and keep the wall-clock time."""
    s = F.trim(_c(c).cast("string"))
    return F.regexp_replace(s, _OFFSET, "").try_cast("timestamp_ntz")


def parse_date(c: str | Column) -> Column:
    """ISO date (or timestamp) text to a zone-less timestamp; bad text gives null."""
    return F.trim(_c(c).cast("string")).try_cast("timestamp_ntz")


def null_outside_open_closed(c: str | Column, lo: float, hi: float) -> Column:
    """Keep values in ``(lo, hi]``, null otherwise (HR error nulling)."""
    x = _c(c)
    return F.when((x > F.lit(lo)) & (x <= F.lit(hi)), x)


def positive_or_null(c: str | Column) -> Column:
    x = _c(c)
    return F.when(x > 0, x)


def clip(c: str | Column, lo: float, hi: float) -> Column:
    """Clip to ``[lo, hi]``; null stays null (``greatest``/``least`` alone would skip nulls)."""
    x = _c(c)
    return F.when(x.isNotNull(), F.greatest(F.lit(float(lo)), F.least(F.lit(float(hi)), x)))


def impute_date(date: str | Column, export_date: str | Column, hours: int = 12) -> Column:
    """Missing date := export date + ``hours``."""
    return F.coalesce(_c(date), _c(export_date) + F.make_dt_interval(F.lit(0), F.lit(hours)))


def distance_bin(c: str | Column, edges: Sequence[float]) -> Column:
    """Left-closed bins ``[e_i, e_{i+1})``, labelled by their lower edge.

    Negative values are clipped to 0 first; values at or beyond the last
    edge get null (a real group in the imputation, not a missing value).
    """
    x = _c(c)
    x = F.when(x < 0, F.lit(0.0)).otherwise(x)
    out = None
    for lo, hi in zip(edges[:-1], edges[1:]):
        cond = (x >= F.lit(float(lo))) & (x < F.lit(float(hi)))
        out = F.when(cond, F.lit(float(lo))) if out is None else out.when(cond, F.lit(float(lo)))
    return out


def status_indicator(value: str | Column, cfg: CleaningConfig = CleaningConfig()) -> Column:
    v = _c(value)
    return (
        F.when(v >= F.lit(cfg.status_good), F.lit("✅"))
        .when(v >= F.lit(cfg.status_warning), F.lit("⚠️"))
        .otherwise(F.lit("❌"))
    )


def percent_text(value: str | Column) -> Column:
    """``0.8765`` -> ``"87.7%"``: one decimal, ties to even, as integer tenths."""
    tenths = F.bround(_c(value) * F.lit(1000.0), 0).cast("long")
    return F.concat(
        F.when(tenths < 0, F.lit("-")).otherwise(F.lit("")),
        (F.abs(tenths) / F.lit(10)).cast("long").cast("string"),
        F.lit("."),
        (F.abs(tenths) % 10).cast("string"),
        F.lit("%"),
    )


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """``num / den``, 0 where ``den`` is 0."""
    return F.coalesce(F.try_divide(_c(num).cast("double"), _c(den).cast("double")), F.lit(0.0))


def changed(old: str | Column, new: str | Column) -> Column:
    """True where two values differ; null on either side counts as changed."""
    return ~F.coalesce(_c(old) == _c(new), F.lit(False))
