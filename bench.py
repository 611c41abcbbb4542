"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is built and run once to warm up, then timed ``BENCH_REPS`` times
(default 3); the reported time is the median.  Runs end in a ``noop`` write, so
every row is computed but nothing is collected to the driver.  Prints ONE JSON
line: ``{"metric", "value" (sum of medians), "unit", "queries", "sf", ...}``.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "stg_charges", "int_subscriptions", "int_charges", "charge_accrual", "month_accrual",
    "revenue_projections", "cq1_month_revenue", "cq2_revenue_trend", "cq3_annual_charge_trace",
    "cq4_live_projection", "accounting_export", "int_subscriber_daily", "subscriber_daily",
    "subscriber_history", "stg_post_overview", "int_post_overview", "stg_post_traffic",
    "int_post_growth", "cq5_top_posts_open_rate", "cq6_top_converting_posts",
    "cq9_publication_summary", "data_checks",
]


def _sf_label(path: str) -> str:
    m = re.search(r"sf([0-9.]+)", path)
    return m.group(1) if m else path


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE

    from subledger.plans.registry import QUERIES
    from subledger.session import checkpoint_dir, get_session

    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(cpus)))
    spark = get_session(f"local[{cpus}]", shuffle_partitions=parts, app_name="subledger-bench")
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name][0](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    results, errors = {}, {}
    for name in names:
        try:
            run(name)  # warm-up
            results[name] = round(statistics.median(run(name) for _ in range(reps)), 3)
        except Exception as e:  # keep benchmarking the others
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
    out = {
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "sf": _sf_label(sf_dir),
        "cpus": cpus,
        "reps": reps,
        "spark": spark.version,
    }
    if errors:
        out["errors"] = errors
    print(json.dumps(out))


if __name__ == "__main__":
    main()
