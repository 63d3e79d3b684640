"""Keep-first deduplication on a business key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_first(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] = (),
    count_col: str | None = "n_copies",
    sum_cols: Sequence[str] = (),
) -> DataFrame:
    """One row per ``keys`` (null keys equal each other), the first in a defined order.

    "First" is the smallest row by ``order_by`` and then by all remaining
    columns in table order, nulls first: deterministic whatever the file and
    partition order. Planned as one aggregate whose buffer is a single row
    (the minimum of the row as an ordered struct; struct buffers make it
    sort-based), so partial aggregation collapses copies before
    the shuffle and a key holding a third of all rows costs no more memory
    than any other. ``count_col`` carries the number of copies per key;
    ``sum_cols`` are added up over the copies instead of being part of the row.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys and c not in sum_cols]
    # the aggregate is sort-based (struct buffers); a numeric or time key first
    # gives the sort a discriminating prefix, low-cardinality strings go last
    types = dict(df.dtypes)
    group_keys = sorted(keys, key=lambda k: 0 if types[k].startswith(("timestamp", "date", "bigint", "int", "double")) else 1)
    ordering = list(order_by) + [c for c in rest if c not in order_by]
    # the ordering struct holds every non-key column once, so its minimum is the
    # whole first row: one struct per buffer, each column shuffled once
    aggs = [F.min(F.struct(*[F.col(c) for c in ordering])).alias("_first")]
    if count_col:
        aggs.append(F.count(F.lit(1)).alias(count_col))
    aggs += [F.sum(c).alias(c) for c in sum_cols]
    grouped = df.groupBy(*group_keys).agg(*aggs)
    cols = [F.col(c) if c in keys or c in sum_cols else F.col(f"_first.{c}").alias(c) for c in df.columns]
    if count_col:
        cols.append(F.col(count_col))
    return grouped.select(*cols)


def duplicated_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows minus distinct keys (null keys equal), as a one-row frame."""
    return df.agg((F.count(F.lit(1)) - F.count_distinct(F.struct(*keys))).alias("duplicated"))
