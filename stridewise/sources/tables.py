"""Loading the benchmark tables and mapping ``lineitem`` onto the workout schema."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _d(x: float) -> F.Column:
    return F.lit(float(x))


def run_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as workout records in the core schema (plus identity columns).

    Returns flag A/N/other become sources alpha/beta/gamma, ship date is the
    start time, the line number picks the activity, and modular rules on the
    keys inject nulls, zeros, out-of-range values and HR inversions. Orders
    with key divisible by 97 appear twice, the copy in a later export, so
    keep-first deduplication has work to do. Same mapping as the SQL of the
    oracle; all arithmetic on doubles.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_discount", "l_tax", "l_returnflag", "l_shipdate",
    )
    ok, pk, sk, ln, qty = (F.col(c) for c in ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity"])
    null_d = F.lit(None).cast("double")
    base = li.select(
        F.when(F.col("l_returnflag") == "A", "alpha").when(F.col("l_returnflag") == "N", "beta")
        .otherwise("gamma").alias("source"),
        F.col("l_shipdate").alias("date"),
        F.when(ln == 7, "Cycling").when(ln >= 5, "Trail Running").otherwise("Running").alias("activity_type"),
        F.when(pk % 101 == 0, null_d).when(pk % 103 == 0, qty + 40).otherwise(qty).alias("distance_km"),
        F.when(sk % 37 == 0, null_d)
        .otherwise(qty * 60 * (2 + ((ok * 7 + pk) % 900) / _d(100))).alias("duration_sec"),
        F.when(F.col("l_tax") == 0, null_d)
        .when((F.col("l_tax") == 0.08) & (F.col("l_discount") == 0), _d(0))
        .otherwise(qty * (20 + pk % 110)).alias("calories"),
        F.when(F.col("l_discount") == 0.1, null_d).when(pk % 211 == 0, _d(0))
        .when(pk % 199 == 0, _d(305)).otherwise((75 + pk % 140).cast("double")).alias("avg_heart_rate"),
        F.when(F.col("l_discount") == 0.09, null_d)
        .otherwise((69 + pk % 140 + ok % 60).cast("double")).alias("max_heart_rate"),
        ok, ln,
    )
    first = base.withColumns({"copy_no": F.lit(0), "export_date": F.lit("2025-08-22").cast("timestamp_ntz")})
    second = base.where(ok % 97 == 0).withColumns(
        {"copy_no": F.lit(1), "export_date": F.lit("2025-09-19").cast("timestamp_ntz")}
    )
    return first.unionByName(second)


CORE_WITH_IDS = [
    "date", "activity_type", "distance_km", "duration_sec", "calories",
    "avg_heart_rate", "max_heart_rate", "source", "export_date", "l_orderkey", "l_linenumber", "copy_no",
]


def running_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run view restricted to running activities (keyword ``run``), ordered columns."""
    rv = run_view(spark, sf_dir)
    return rv.where(F.lower("activity_type").contains("run")).select(*CORE_WITH_IDS)
