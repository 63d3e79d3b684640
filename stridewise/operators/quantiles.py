"""Exact percentiles per group, with bounded memory per task.

pandas computes medians and quantiles exactly, so approximate sketches are not
an option. Two plans, both exact and with linear interpolation between order
statistics (the convention of pandas, DuckDB and Spark's ``percentile``):

``hist``
    Pre-aggregate ``(group, value) -> count`` (map-side combine, shuffled by
    group *and* value, so one hot group spreads over all reducers), then run
    Spark's ``percentile(value, p, count)`` per group on the distinct pairs.
    The final task of a group holds one entry per distinct value, so this is
    the plan for columns with a bounded domain (heart rate, kcal).

``rank``
    For unbounded domains: range-partition the distinct pairs by
    ``(group, value)`` (a hot group is cut into many partitions by sampled
    bounds), fix the partition ids by writing the pairs as a table, count rows of
    each group per partition, turn that small table into per-partition offsets
    and pick the rows whose global rank hits the wanted positions. No task
    ever holds more than one range partition.

``auto`` measures the distinct values per group (``approx_count_distinct``)
and takes ``hist`` below ``max_distinct``, ``rank`` above.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stridewise.session import materialize

HIST_MAX_DISTINCT = 2_000_000


def _value_pairs(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    v = F.col(value).cast("double")
    vals = df.select(*[F.col(k) for k in keys], v.alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    return vals.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_w"))


def _hist(pairs: DataFrame, keys: Sequence[str], probs: Sequence[float], out: str) -> DataFrame:
    return pairs.groupBy(*keys).agg(
        F.percentile(F.col("_v"), F.array(*[F.lit(float(p)) for p in probs]), F.col("_w")).alias(out),
        F.sum("_w").alias("n"),
        F.count(F.lit(1)).alias("n_distinct"),
    )


def _rank(pairs: DataFrame, keys: Sequence[str], probs: Sequence[float], out: str, partitions: int) -> DataFrame:
    # the written table fixes the partition ids for every later reader
    ordered = materialize(
        pairs.repartitionByRange(partitions, *[F.col(k).asc_nulls_first() for k in keys], F.col("_v"))
        .withColumn("_pid", F.spark_partition_id()),
        "ranked",
    )
    # rows of each group before this value, within the same range partition
    w_local = Window.partitionBy("_pid", *keys).orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    local = ordered.withColumn("_before", F.coalesce(F.sum("_w").over(w_local), F.lit(0)))
    spans = ordered.groupBy("_pid", *keys).agg(F.sum("_w").alias("_cnt"), F.count(F.lit(1)).alias("_nd"))
    w_grp = Window.partitionBy(*keys)
    w_off = w_grp.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(
        "_pid", *keys, "_cnt",
        F.coalesce(F.sum("_cnt").over(w_off), F.lit(0)).alias("_off"),
        F.sum("_cnt").over(w_grp).alias("n"),
        F.sum("_nd").over(w_grp).alias("n_distinct"),
    )
    # positions to fetch: floor and ceil of p * (n - 1) for every p
    pos = F.explode(F.array(*[
        F.struct(F.lit(i).alias("_i"), (F.lit(float(p)) * (F.col("n") - 1)).alias("_pos"))
        for i, p in enumerate(probs)
    ]))
    groups = spans.select(*keys, "n", "n_distinct").distinct()
    targets = groups.select(*keys, "n", "n_distinct", pos.alias("_t")).select(
        *keys, "n", "n_distinct", "_t._i", "_t._pos",
        F.explode(F.array(F.floor("_t._pos"), F.ceil("_t._pos"))).alias("_r"),
    ).dropDuplicates([*keys, "_i", "_r"])
    def nse(a: DataFrame, b: DataFrame, cols: Sequence[str]):
        cond = None
        for c in cols:
            e = a[c].eqNullSafe(b[c])
            cond = e if cond is None else cond & e
        return cond
    sp = spans.select("_pid", *keys, "_off", "_cnt").alias("sp")
    tg = targets.alias("tg")
    hit = tg.join(sp, nse(tg, sp, keys) & (F.col("tg._r") >= F.col("sp._off")) & (F.col("tg._r") < F.col("sp._off") + F.col("sp._cnt")))
    hit = hit.select(*[F.col(f"tg.{k}").alias(k) for k in keys], "tg.n", "tg.n_distinct", "tg._i", "tg._pos", "tg._r", "sp._pid", "sp._off")
    lc = local.alias("lc")
    ht = hit.alias("ht")
    rank_in = F.col("ht._r") - F.col("ht._off")
    found = ht.join(lc, nse(ht, lc, ["_pid", *keys]) & (rank_in >= F.col("lc._before")) & (rank_in < F.col("lc._before") + F.col("lc._w")))
    found = found.select(*[F.col(f"ht.{k}").alias(k) for k in keys], "ht.n", "ht.n_distinct", "ht._i", "ht._pos", "ht._r", F.col("lc._v").alias("_v"))
    # interpolate as Spark's percentile does: (hi - pos) * v_lo + (pos - lo) * v_hi
    per_p = found.groupBy(*keys, "n", "n_distinct", "_i", "_pos").agg(
        F.min_by("_v", "_r").alias("_lo_v"), F.max_by("_v", "_r").alias("_hi_v")
    )
    lo, hi = F.floor("_pos"), F.ceil("_pos")
    q = F.when((lo == hi) | (F.col("_lo_v") == F.col("_hi_v")), F.col("_lo_v")).otherwise(
        (hi - F.col("_pos")) * F.col("_lo_v") + (F.col("_pos") - lo) * F.col("_hi_v")
    )
    per_p = per_p.withColumn("_q", q)
    res = per_p.groupBy(*keys, "n", "n_distinct").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_i", "_q"))), lambda s: s["_q"]).alias(out)
    )
    return res.select(*keys, out, "n", "n_distinct")


def exact_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Sequence[float],
    out: str = "q",
    method: str = "auto",
    max_distinct: int = HIST_MAX_DISTINCT,
    partitions: int | None = None,
) -> DataFrame:
    """Exact percentiles of ``value`` per group of ``keys``.

    Returns one row per group with at least one non-null value:
    ``keys..., out (array<double>, one entry per prob), n, n_distinct``.
    Null keys form their own group. Nulls and NaN in ``value`` are ignored.
    Without keys the whole frame is one group.
    """
    keys = list(keys)
    if not keys:
        # one group over the whole frame, for either plan
        whole = exact_percentiles(df.select(F.lit(0).alias("_all"), value), ["_all"], value, probs, out, method, max_distinct, partitions)
        return whole.drop("_all")
    pairs = _value_pairs(df, keys, value)
    if method == "auto":
        method = choose_method(widest_group(df, keys, [value])[value], max_distinct)
    if method == "hist":
        return _hist(pairs, keys, probs, out)
    if method == "rank":
        n = partitions or max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
        return _rank(pairs, keys, probs, out, n)
    raise ValueError(f"unknown method {method!r}")


def widest_group(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> dict[str, int]:
    """Largest approximate number of distinct values per group, for each of ``cols`` (one job)."""
    aggs = [F.approx_count_distinct(c).alias(c) for c in cols]
    per_group = df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)
    row = per_group.agg(*[F.max(c).alias(c) for c in cols]).first()
    return {c: int(row[c] or 0) for c in cols}


def choose_method(distinct: int, max_distinct: int = HIST_MAX_DISTINCT) -> str:
    return "hist" if distinct <= max_distinct else "rank"


def exact_median(df: DataFrame, keys: Sequence[str], value: str, out: str = "median", **kw) -> DataFrame:
    res = exact_percentiles(df, keys, value, [0.5], out="_q", **kw)
    return res.select(*keys, F.col("_q")[0].alias(out), "n", "n_distinct")
