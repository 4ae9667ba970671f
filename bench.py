"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR: data folder, BENCH_CPUS: local cores, BENCH_QUERIES: names or "all".
Each query runs once to warm up, then three times; the median counts. Results
are forced with the noop sink.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.plans import QUERIES  # noqa: E402
from tidemark.session import local_session  # noqa: E402

HEADLINE = """
medallion_gold star_join_active_sales left_join_fill temporal_price_join asof_join_features feature_lookup
gold_customer_spending conditional_counts distinct_counts daily_p95 gold_daily_metrics gold_user_activity
pivot_region_revenue cost_by_tag sort_multi_key top_users_by_value win_rank_dense win_lag_lead
win_running_total win_moving_avg dedup_latest_by_key merge_upsert scd2_apply change_feed apply_changes
profile_full zscore_outliers drift_report expect_warn_metrics row_filter_region mask_columns
customer_features product_features user_behavior_features binary_metrics forecast_linear
chunk_documents vector_topk classify_keywords pii_scan doc_dedup_exact answer_scores
daily_cost budget_status mv_sales stream_append_finalised
""".split()


def seconds(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    wanted = os.environ.get("BENCH_QUERIES", "").split()
    names = list(QUERIES) if wanted == ["all"] else wanted or HEADLINE
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, "tidemark-bench")
    spark.sparkContext.setLogLevel("OFF")
    timed, failed = {}, {}
    for name in names:
        try:
            seconds(spark, name, sf_dir)
            timed[name] = round(statistics.median(seconds(spark, name, sf_dir) for _ in range(runs)), 3)
        except Exception as e:  # one broken query must not hide the others
            failed[name] = f"{type(e).__name__}: {str(e)[:200]}"
    line = {
        "metric": "sum of median query seconds",
        "value": round(sum(timed.values()), 3),
        "unit": "sec",
        "queries": timed,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
        "cores": cpus,
        "spark": spark.version,
    }
    if failed:
        line["failed"] = failed
    spark.stop()
    print(json.dumps(line))


if __name__ == "__main__":
    main()
