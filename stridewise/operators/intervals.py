"""Points matched with the intervals of time that hold them, by an equi-join on time buckets."""

from __future__ import annotations

import sys
from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridewise.operators.joins import lookup_join, materialize_small

# the functions below run in Python workers; shipped by value, executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bucket widths grow by this factor from level to level; an interval lies in the first level that is as wide as it is long.
LEVEL_FACTOR = 4
#: Points (or intervals) of one bucket that a task takes at once; a bucket with more is split.
BUCKET_ROWS = 50_000
#: The exponent of the least bucket width, some seconds (for summaries; a join needs none).
LEAST_LEVEL = 10


def micros(c: str | Column) -> Column:
    """Microseconds since 1970 of a zone-less time."""
    c = F.col(c) if isinstance(c, str) else c
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), c.cast("timestamp_ntz"))


def _parts(rows: str, bucket_rows: int) -> Column:
    return F.greatest(F.lit(1), F.ceil(F.col(rows) / F.lit(bucket_rows))).cast("int")


def interval_join(points: DataFrame, intervals: DataFrame, time: str, begin: str, end: str, by: Sequence[str] = (),
                  bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Every pair of a point and an interval with ``begin <= time < end`` and equal ``by`` columns.

    Columns: those of ``intervals``, then those of ``points`` without ``by``; other names must not clash (``ValueError``).
    Points without a time, intervals without a begin or an end and intervals that hold no moment match nothing;
    null ``by`` values equal each other; repeated rows give a pair each.

    An interval lies on the level whose buckets are at least as wide as it is long, so in two buckets at most,
    whatever its length; a point looks itself up once on every level in use. Buckets that hold more than
    ``bucket_rows`` points or intervals are split in both directions by hashes of the rows, so that neither a crowded hour nor one
    ``by`` value with a third of all rows becomes one task; splitting changes the work of a task, never the pairs.
    """
    by = list(by)
    clash = (set(points.columns) & set(intervals.columns)) - set(by)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    left, right, cell = _in_cells(points, intervals, time, begin, end, by, bucket_rows)
    left = left.withColumnsRenamed({c: f"_p_{c}" for c in cell})
    inside = (F.col("_b") <= F.col("_t")) & (F.col("_t") < F.col("_e"))
    for c in cell:
        same = F.col(f"_p_{c}").eqNullSafe(F.col(c)) if c in by else F.col(f"_p_{c}") == F.col(c)
        inside = same & inside
    pairs = right.join(left, inside)
    return pairs.select(*[F.col(f"`{c}`") for c in intervals.columns], *[F.col(f"`{c}`") for c in points.columns if c not in by])


def _in_cells(points: DataFrame, intervals: DataFrame, time: str, begin: str, end: str, by: list[str], bucket_rows: int,
              least: int | None = None) -> tuple[DataFrame, DataFrame, list[str]]:
    """Points (with ``_t``) and intervals (with ``_b``, ``_e``) in the cells in which they meet, and the columns that name a cell.

    Every pair of a point and an interval that holds it meets in one cell. ``least``: the lowest level used.
    """
    right = intervals.withColumns({"_b": micros(begin), "_e": micros(end)}).where(F.col("_b") < F.col("_e"))
    # the level in use: the exponent of the first width >= length, at least a second
    length = F.greatest(F.col("_e") - F.col("_b"), F.lit(1_000_000))
    level = F.ceil(F.log(float(LEVEL_FACTOR), length.cast("double")) - F.lit(1e-9)).cast("int")
    level = level if least is None else F.greatest(level, F.lit(least))
    right = right.withColumn("_level", level)
    levels = sorted(r[0] for r in right.select("_level").distinct().collect())  # at most 32: a 64-bit length has no more
    left = points.withColumn("_t", micros(time)).where(F.col("_t").isNotNull())
    width = F.pow(F.lit(float(LEVEL_FACTOR)), F.col("_level")).cast("long")
    right = right.withColumn("_bucket", F.explode(F.sequence(F.floor(F.col("_b") / width), F.floor((F.col("_e") - 1) / width))))
    places = F.array(*[F.struct(F.lit(v).alias("_level"), F.floor(F.col("_t") / F.lit(LEVEL_FACTOR**v)).alias("_bucket")) for v in levels])
    if not levels:
        places = F.array().cast("array<struct<_level: int, _bucket: bigint>>")
    left = left.withColumn("_place", F.explode(places)).select("*", "_place.*").drop("_place")
    cell = [*by, "_level", "_bucket"]

    # buckets with too many rows on a side; there are at most (rows / bucket_rows) of them
    sizes = right.groupBy(*cell).agg(F.count(F.lit(1)).alias("_ni"), F.lit(0).cast("long").alias("_np")).unionByName(
        left.groupBy(*cell).agg(F.lit(0).cast("long").alias("_ni"), F.count(F.lit(1)).alias("_np")))
    hot = sizes.groupBy(*cell).agg(F.sum("_ni").alias("_ni"), F.sum("_np").alias("_np")).where(
        (F.col("_ni") > 0) & (F.col("_np") > 0) & (F.greatest("_ni", "_np") > bucket_rows))
    hot, n_hot = materialize_small(hot.select(*cell, _parts("_np", bucket_rows).alias("_pp"), _parts("_ni", bucket_rows).alias("_pi")), "hot-buckets")

    def placed(side: DataFrame, own: str, other: str, own_part: str, other_part: str) -> DataFrame:
        """A row in one part of its own side, copied to all parts of the other."""
        if not n_hot:
            return side
        side = lookup_join(side, hot, cell, null_safe=True, small_rows=n_hot)
        mine = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in side.columns if c not in ("_pp", "_pi")]), F.coalesce(F.col(own), F.lit(1)))
        return side.withColumns({own_part: mine, other_part: F.explode(F.sequence(F.lit(0), F.coalesce(F.col(other), F.lit(1)) - 1))}).drop("_pp", "_pi")

    parts = ["_i", "_j"] if n_hot else []
    return placed(left, "_pp", "_pi", "_i", "_j"), placed(right, "_pi", "_pp", "_j", "_i"), [*cell, *parts]


def _summary_level(points: DataFrame, by: list[str], bucket_rows: int) -> int:
    """The widest level at which the cell of a point (``_t``) holds about an eighth of ``bucket_rows`` on average, by what is counted."""
    goal = max(1, bucket_rows // 8)
    n, first, last = points.agg(F.count(F.lit(1)), F.min("_t"), F.max("_t")).first()
    if not n:
        return LEAST_LEVEL
    level = max(LEAST_LEVEL, int(np.log(max(1.0, (last - first + 1.0) * min(1.0, goal / n))) / np.log(LEVEL_FACTOR)))
    while level > LEAST_LEVEL:
        held = points.groupBy(*by, F.floor(F.col("_t") / F.lit(LEVEL_FACTOR**level)).alias("_bucket")).agg(F.count(F.lit(1)).cast("double").alias("_n"))
        size = held.agg(F.sum(F.col("_n") * F.col("_n")) / F.sum("_n")).first()[0]
        if size <= LEVEL_FACTOR * goal:
            break
        # points stand closer together than over the whole time
        level = max(LEAST_LEVEL, level - max(1, int(np.log(size / goal) / np.log(LEVEL_FACTOR))))
    return level


def interval_summary(points: DataFrame, intervals: DataFrame, time: str, begin: str, end: str, keys: Sequence[str],
                     aggregates: Mapping[str, tuple[str, str | None]], by: Sequence[str] = (), bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """The pairs of :func:`interval_join`, grouped by ``keys`` (columns of ``intervals``), without writing out the pairs.

    ``aggregates`` maps a name to ``("count", None)`` (pairs), ``("count", column)``, ``("min", column)`` or ``("max", column)`` of a column
    of ``points``; nulls do not count. Groups without a pair are absent. Pairs grow with the product of both sides; this with their sum:
    points of a cell are sorted once, an interval finds its first and last by binary search, counts are
    differences of running counts and extremes come from a table of those of all runs of 1, 2, 4, ... points.
    Cells are as in the join, but not narrower than what holds some thousands of points.
    """
    by, keys = list(by), list(keys)
    clash = (set(points.columns) & set(intervals.columns)) - set(by)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    values = list(dict.fromkeys(c for _, c in aggregates.values() if c is not None))
    timed = points.withColumn("_t", micros(time)).where(F.col("_t").isNotNull())
    points = points.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*by, time, *values])])
    intervals = intervals.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*by, *keys, begin, end])])
    left, right, cell = _in_cells(points, intervals, time, begin, end, by, bucket_rows, _summary_level(timed, by, bucket_rows))
    left = left.select(*cell, "_t", *[F.col(f"`{c}`").alias(f"_v{i}") for i, c in enumerate(values)])
    right = right.select(*cell, "_b", "_e", *[F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(keys)])
    asked = [(kind, None if c is None else f"_v{values.index(c)}") for kind, c in aggregates.values()]

    def summarise(held: pa.Table, spans: pa.Table) -> pa.Table:
        return summary_of_cell(held, spans, [f"_k{i}" for i in range(len(keys))], asked)

    kinds = [f"{left.schema[v].dataType.simpleString()}" if kind != "count" else "bigint" for kind, v in asked]
    schema = ", ".join([*[f"_k{i} {right.schema[f'_k{i}'].dataType.simpleString()}" for i in range(len(keys))], *[f"_a{i} {t}" for i, t in enumerate(kinds)]])
    parts = left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(summarise, schema)
    merge = {"count": F.sum, "min": F.min, "max": F.max}
    return parts.groupBy(*[F.col(f"_k{i}").alias(k) for i, k in enumerate(keys)]).agg(
        *[merge[kind](f"_a{i}").alias(name) for i, (name, (kind, _)) in enumerate(aggregates.items())])


def summary_of_cell(points: pa.Table, spans: pa.Table, keys: Sequence[str], asked: Sequence[tuple[str, str | None]]) -> pa.Table:
    """The spans ``_b``, ``_e`` that hold points, with their keys and what is asked of these points."""
    t = points["_t"].to_numpy()
    order = np.argsort(t, kind="stable")
    t = t[order]
    low, high = np.searchsorted(t, spans["_b"].to_numpy()), np.searchsorted(t, spans["_e"].to_numpy())
    hit = np.flatnonzero(high > low)
    low, high = low[hit], high[hit]
    out = [spans[k].combine_chunks().take(pa.array(hit)) for k in keys]
    for kind, column in asked:
        if column is None:
            out.append(pa.array(high - low, pa.int64()))
            continue
        values = points[column].combine_chunks().take(pa.array(order))
        if kind == "count":
            known = np.concatenate([[0], np.cumsum(values.is_valid().to_numpy(zero_copy_only=False))])
            out.append(pa.array(known[high] - known[low], pa.int64()))
        else:
            out.append(values.take(best_of_runs(values, low, high, kind)))
    return pa.Table.from_arrays(out, names=[*keys, *[f"_a{i}" for i in range(len(asked))]])


def best_of_runs(values: pa.Array, low: np.ndarray, high: np.ndarray, kind: str) -> pa.Array:
    """The place of the least or greatest value of each run ``[low, high)``, null where all are null."""
    rank = pc.rank(values, "ascending", null_placement="at_end", tiebreaker="dense").to_numpy().astype(np.int64)
    none = len(values) + 1 if kind == "min" else 0  # ranks start at 1
    rank = np.where(values.is_valid().to_numpy(zero_copy_only=False), rank, none)
    pick = np.minimum if kind == "min" else np.maximum
    place = np.zeros(len(values) + 2, dtype=np.int64)
    place[rank] = np.arange(len(values))
    size = np.frexp((high - low).astype(np.float64))[1] - 1  # the longest power of two within the run
    best, runs = np.full(len(low), none, dtype=np.int64), rank
    for k in range(int(size.max(initial=-1)) + 1):
        if k:
            runs = pick(runs[: -(1 << k - 1)], runs[1 << k - 1 :])
        at = np.flatnonzero(size == k)
        best[at] = pick(runs[low[at]], runs[high[at] - (1 << k)])
    return pa.array(place[best], mask=best == none)
