"""Plan shapes that the scale design relies on."""

from pyspark.sql import functions as F

from stridewise.operators.dedupe import keep_first
from stridewise.operators.joins import lookup_join, materialize_small
from stridewise.operators.quantiles import exact_percentiles
from stridewise.plans import pipeline as pl


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedupe_combines_before_the_shuffle(make_runs):
    plan = _plan(keep_first(make_runs(n=4), ["source", "date"], ["export_date"]))
    assert "partial_min" in plan and "Exchange hashpartitioning" in plan
    assert plan.index("Exchange hashpartitioning") < plan.rindex("partial_min")   # partial below the exchange


def test_histogram_percentiles_shuffle_on_group_and_value(spark):
    df = spark.range(100).selectExpr("id % 3 AS g", "CAST(id AS DOUBLE) AS v")
    plan = _plan(exact_percentiles(df, ["g"], "v", [0.5], method="hist"))
    assert "partial_percentile" in plan
    assert "Exchange hashpartitioning(g#" in plan and ", _v#" in plan


def test_small_statistics_are_broadcast(spark):
    big = spark.range(1000).selectExpr("CAST(id % 3 AS STRING) AS k", "id")
    small, n = materialize_small(big.groupBy("k").agg(F.count(F.lit(1)).alias("c")))
    plan = _plan(lookup_join(big, small, ["k"], small_rows=n))
    assert n == 3 and "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_cleaned_plan_has_no_python_and_no_shuffle_join(make_runs, config):
    res = pl.clean_runs(make_runs(distance_km=[3.0, 4.0, 5.0], calories=[300.0, None, 500.0]), config)
    plan = _plan(res.data)
    assert "FileScan parquet" in plan                      # reads the written deduplicated table
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    assert "EvalPython" not in plan and "PythonUDF" not in plan
