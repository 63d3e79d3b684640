"""Lookup joins against small statistic tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Statistic tables up to this many rows are broadcast; larger ones are joined
# by shuffle. The row count is measured, not assumed.
BROADCAST_MAX_ROWS = 100_000


def materialize_small(df: DataFrame, name: str = "stats", max_rows: int = BROADCAST_MAX_ROWS) -> tuple[DataFrame, int]:
    """Compute a statistic table once and return it with its row count.

    At most ``max_rows + 1`` rows are fetched (one job). Within the bound the
    table becomes a local relation, which is what a broadcast ships anyway:
    later plans never recompute the aggregate behind it and a lost executor
    cannot lose it. Beyond the bound it is written as a table under the
    checkpoint root and joined by shuffle.
    """
    from pyspark import StorageLevel

    from stridewise.session import materialize

    held = df.persist(StorageLevel.MEMORY_AND_DISK)   # the write below reuses what the fetch computed
    try:
        rows = held.limit(max_rows + 1).collect()
        if len(rows) <= max_rows:
            return df.sparkSession.createDataFrame(rows, df.schema), len(rows)
        table = materialize(held, name)
        return table, table.count()
    finally:
        held.unpersist()


def lookup_join(
    big: DataFrame,
    small: DataFrame,
    keys: Sequence[str],
    null_safe: bool = False,
    small_rows: int | None = None,
    max_rows: int = BROADCAST_MAX_ROWS,
) -> DataFrame:
    """Left join of ``big`` with a statistic table on ``keys``.

    ``small`` is broadcast only when its measured row count is within
    ``max_rows``; otherwise the join is left to the planner (shuffle join,
    AQE may still switch it at run time). With ``null_safe`` null keys match
    null keys (null groups are real groups). An empty ``keys`` is a one-row
    lookup: its values are added as literal columns.
    """
    if small_rows is None:
        small, small_rows = materialize_small(small)
    if not keys:
        # a single row: its values become literal columns, no join at all
        if small_rows > 1:
            raise ValueError("a lookup without keys needs a table of at most one row")
        rows = small.limit(2).collect()
        if len(rows) > 1:
            raise ValueError("a lookup without keys needs a table of at most one row")
        values = rows[0].asDict() if rows else {}
        return big.withColumns({f.name: F.lit(values.get(f.name)).cast(f.dataType) for f in small.schema.fields})
    renamed = small
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"__r_{k}")
    cond: Column | None = None
    for k in keys:
        l, r = big[k], renamed[f"__r_{k}"]
        c = l.eqNullSafe(r) if null_safe else (l == r)
        cond = c if cond is None else cond & c
    side = F.broadcast(renamed) if small_rows <= max_rows else renamed
    out = big.join(side, cond, "left")
    return out.drop(*[f"__r_{k}" for k in keys])
