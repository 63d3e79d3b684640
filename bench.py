"""Bench: headline catalog queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

The headline set covers every operator family (rules, dedupe, exact medians and
quantile bins, grouping-set imputation, the fused pipeline and its report,
quality, parsing and typing, both importers, the end-to-end run).
``BENCH_QUERIES=all`` runs the whole catalog; a comma list picks queries.

Each query is run to completion with the ``noop`` sink (full computation, no
collect); the figure per query is the median of ``$BENCH_REPS`` warm runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stridewise.plans.queries import QUERIES  # noqa: E402
from stridewise.session import local_session  # noqa: E402

HEADLINE = [
    "range_filter", "dedupe_first", "hr_median_fill", "hr_quantile_bins", "median_levels", "calories_impute",
    "full_pipeline", "step_report", "quality_report", "comparison_table", "describe", "duration_parse",
    "garmin_typing", "xml_workouts", "garmin_csv_import", "run_pipeline_exports",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "1"))
    picked = os.environ.get("BENCH_QUERIES", "")
    only = [] if picked == "all" else ([q for q in picked.split(",") if q] or HEADLINE)
    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2, app="stridewise-bench")
    QUERIES["range_filter"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    times: dict[str, float] = {}
    for name, fn in QUERIES.items():
        if only and name not in only:
            continue
        runs = []
        for _ in range(reps):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "sum_of_headline_query_seconds" if not picked else "sum_of_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": sf, "cpus": cpus,
    }))


if __name__ == "__main__":
    main()
