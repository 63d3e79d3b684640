"""Moving averages over a span of time, without one task per source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: A time bucket is as long as this many spans; its halo is one span, so rows travel 1 + 1/4 times.
SPANS_A_BUCKET = 4
_DAY = 86_400_000_000


def moving_average(df: DataFrame, value: str, time: str, by: Sequence[str], days: int, out: str = "moving_average", count: str = "rows_in_span") -> DataFrame:
    """Average of ``value`` over the ``days`` days up to each moment, per group: one row per group and distinct moment.

    The span of a moment ``t`` holds the rows after ``t - days`` up to ``t``, those of the same moment included
    (a calendar window if times are dates). Rows of one moment are added up first. Time is cut into buckets; a bucket also gets the rows of the last span before it (its
    halo), so a window never needs more than one bucket and a source with very many rows is worked on by many tasks.
    Rows without a time are left out; null values count as no value; a span without values gives null. Times are
    zone-less; groups may be null.
    """
    by = list(by)
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(time).cast("timestamp_ntz"))
    span, width = days * _DAY, SPANS_A_BUCKET * days * _DAY
    moments = (
        df.where(F.col(time).isNotNull()).groupBy(*by, time)
        .agg(F.sum(F.col(value).cast("double")).alias("_sum"), F.count(value).alias("_n"))
        .withColumn("_at", micros).withColumn("_bucket", F.floor(F.col("_at") / F.lit(width)).cast("long"))
    )
    reaches = F.col("_at") > (F.col("_bucket") + 1) * F.lit(width) - F.lit(span)
    buckets = F.when(reaches, F.array(F.col("_bucket"), F.col("_bucket") + 1)).otherwise(F.array(F.col("_bucket")))
    placed = moments.withColumn("_in", F.explode(buckets))
    window = Window.partitionBy(*by, "_in").orderBy("_at").rangeBetween(-(span - 1), 0)
    summed = placed.withColumns({"_s": F.sum("_sum").over(window), "_c": F.sum("_n").over(window)}).where(F.col("_in") == F.col("_bucket"))
    return summed.select(*by, time, F.try_divide(F.col("_s"), F.col("_c")).alias(out), F.col("_c").alias(count))
