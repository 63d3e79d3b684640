"""Union of cleaned sources, chronological order, derived features."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SOURCE_RANK = "_source_rank"


def concat_sources(frames: Sequence[DataFrame], sort_by: str | None = "date", tie_breakers: Sequence[str] = ()) -> DataFrame:
    """UNION ALL by column name (missing columns null); no cross-source dedupe.

    With ``sort_by`` the result is ordered by it (nulls last), then by the
    position of the frame in ``frames`` (what a stable sort of the
    concatenation gives), then by ``tie_breakers``.
    """
    if not frames:
        raise ValueError("no frames to combine")
    ranked = [f.withColumn(SOURCE_RANK, F.lit(i)) for i, f in enumerate(frames)]
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), ranked)
    if sort_by is not None:
        out = out.orderBy(F.col(sort_by).asc_nulls_last(), F.col(SOURCE_RANK), *[F.col(c).asc_nulls_last() for c in tie_breakers])
    return out.drop(SOURCE_RANK)


def add_features(df: DataFrame, duration: str = "duration_sec", distance: str = "distance_km") -> DataFrame:
    """``duration_min = duration_sec / 60``, ``pace_min_per_km = duration_min / distance_km`` (null for 0 km)."""
    minutes = F.col(duration) / F.lit(60.0)
    return df.withColumns({
        "duration_min": minutes,
        "pace_min_per_km": F.try_divide(minutes, F.col(distance)),
    })


def top_chronological(df: DataFrame, n: int, sort_by: str = "date", tie_breakers: Sequence[str] = ()) -> DataFrame:
    """The first ``n`` rows in time order (a top-k: Spark keeps n rows per task, then merges)."""
    order = [F.col(sort_by).asc_nulls_last(), *[F.col(c).asc_nulls_last() for c in tie_breakers]]
    return df.orderBy(*order).limit(n)


#: Buckets whose fingerprints are compared; the driver sees one number each where tables differ.
FINGERPRINT_BUCKETS = 4096


def _common(a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both frames with the columns of ``a``, by name, in the types to which a union would widen them."""
    types = a.limit(0).unionByName(b.select(*[F.col(f"`{c}`") for c in a.columns]).limit(0)).schema
    both = [d.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in types]) for d in (a, b)]
    return both[0], both[1]


def _row_hashes(df: DataFrame) -> list[Column]:
    """Two independent 64-bit hashes of a row; which values are null is hashed too, as null values leave a hash as it is."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    nulls = [c.isNull() for c in columns]
    return [F.xxhash64(*nulls, *columns), F.xxhash64(F.lit("second"), *columns, *nulls)]


def fingerprints(df: DataFrame, buckets: int = FINGERPRINT_BUCKETS) -> DataFrame:
    """``(bucket, rows, s0..s3)``: order-free sums of the row hashes by bucket; equal multisets of rows give equal ones.

    Rows are combined where they are read: one scan, at most ``buckets`` small rows a task are exchanged.
    """
    first, second = _row_hashes(df)
    hashed = df.select(first.alias("_h0"), second.alias("_h1"))
    low = F.lit((1 << 32) - 1)
    halves = [F.col("_h0").bitwiseAND(low), F.shiftrightunsigned("_h0", 32), F.col("_h1").bitwiseAND(low), F.shiftrightunsigned("_h1", 32)]
    return hashed.groupBy(F.pmod("_h0", F.lit(buckets)).alias("bucket")).agg(
        F.count(F.lit(1)).alias("rows"), *[F.sum(h).alias(f"s{i}") for i, h in enumerate(halves)]
    )


def differing_buckets(a: DataFrame, b: DataFrame, buckets: int = FINGERPRINT_BUCKETS) -> list[int]:
    """Buckets whose fingerprints differ (``buckets`` at most)."""
    signed = fingerprints(a, buckets)
    negative = fingerprints(b, buckets)
    names = [c for c in signed.columns if c != "bucket"]
    both = signed.unionByName(negative.select("bucket", *[(-F.col(c)).alias(c) for c in names]))
    summed = both.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in names])
    unequal = F.lit(False)
    for c in names:
        unequal = unequal | (F.col(c) != 0)
    return [r["bucket"] for r in summed.where(unequal).select("bucket").collect()]


def frames_difference(a: DataFrame, b: DataFrame, buckets: int = FINGERPRINT_BUCKETS) -> DataFrame:
    """Rows of ``a`` missing from ``b`` and rows of ``b`` not in ``a`` (multisets, by column name), one row.

    Equal frames give ``(0, 0)`` after one scan each: fingerprints of hash buckets (128 bits a row, summed)
    are compared first, and rows are shuffled only in buckets that differ, once, each with its sign. Null equals null and NaN equals NaN.
    """
    a, b = _common(a, b)
    unequal = differing_buckets(a, b, buckets)
    if not unequal:
        return a.sparkSession.createDataFrame([(0, 0)], "missing long, extra long")
    wanted = F.array(*[F.lit(x).cast("long") for x in unequal])
    names = a.columns

    def part(df: DataFrame, sign: int) -> DataFrame:
        inside = df.where(F.array_contains(wanted, F.pmod(_row_hashes(df)[0], F.lit(buckets)))) if len(unequal) < buckets else df
        return inside.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)], F.lit(sign).alias("_sign"))

    left = part(a, 1).unionByName(part(b, -1)).groupBy(*[f"c{i}" for i in range(len(names))]).agg(F.sum("_sign").alias("_n"))
    return left.agg(F.coalesce(F.sum(F.when(F.col("_n") > 0, F.col("_n"))), F.lit(0)).cast("long").alias("missing"),
                    F.coalesce(F.sum(F.when(F.col("_n") < 0, -F.col("_n"))), F.lit(0)).cast("long").alias("extra"))
