"""Benchmark: headline warehouse queries on local[$BENCH_CPUS] at $BENCH_SF_DIR.

Each query is executed in full with the ``noop`` sink (every row computed,
nothing collected to the driver). Prints one JSON line.
"""
from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from reelhouse.registry import build  # noqa: E402
from reelhouse.session import get_session  # noqa: E402

ANALYSIS = ["q1_dau_rolling", "q2_churn_segments", "q3_completion_by_genre", "q4_ltv_by_plan",
            "q5_period_device_crosstab", "q6_cohort_retention", "q7_original_roi",
            "v_daily_active_users", "v_churn_risk_summary"]
HEADLINE = [
    "fact_viewing_events", "mart_user_engagement", "mart_content_performance",
    "mart_subscription_metrics", "v_daily_active_users",
    "q1_dau_rolling", "q2_churn_segments", "q3_completion_by_genre", "q4_ltv_by_plan",
    "q5_period_device_crosstab", "q6_cohort_retention", "q7_original_roi",
    "sessions", "similar_users_topk", "recommend_topn",
    "watch_quartiles_by_risk", "roc_auc", "event_keys", "dau_forecast",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = sys.argv[1:]
    spark = get_session(f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2), app_name="reelhouse-bench")
    from reelhouse.registry import QUERIES
    names = [n for n in (only or HEADLINE) if n in QUERIES]
    # warm-up: JVM, parquet footers
    build("q5_period_device_crosstab", spark, sf_dir).write.format("noop").mode("overwrite").save()
    timings = {}
    for name in names:
        t0 = time.perf_counter()
        build(name, spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t0, 3)
    if not only:
        # The warehouse workflow: build every layer once into a folder of
        # Parquet tables, then answer the analysis queries from those tables.
        from reelhouse.plans.warehouse import BuiltWarehouse, Warehouse, conform
        from reelhouse.registry import QUERIES as Q
        from reelhouse.session import scratch_path
        from reelhouse.sources.io import build_warehouse
        out = scratch_path(spark, "built")
        t0 = time.perf_counter()
        build_warehouse(Warehouse(spark, sf_dir), out)
        timings["warehouse_build"] = round(time.perf_counter() - t0, 3)
        for name in ANALYSIS:
            t0 = time.perf_counter()
            conform(Q[name](BuiltWarehouse(spark, out))).write.format("noop").mode("overwrite").save()
            timings["built:" + name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(timings.values()), 3),
                      "unit": "sec", "queries": timings, "sf": sf, "cpus": cpus}))


if __name__ == "__main__":
    main()
