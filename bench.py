"""Benchmark the headline queries.

Runs a representative query per operator family at $BENCH_SF_DIR (default
/root/testdata/sf0.1) on local[$BENCH_CPUS] and prints one JSON line:
{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}
Each query is executed completely with the no-op sink (no collect to the
driver); times are wall-clock per query after one JVM warm-up.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "group_rate_stats", "top_procedures", "payment_benchmarks", "two_level_distribution", "standings",
    "ratio_of_sums", "rfm", "gini", "top_share", "cohort_retention", "seasonal_index",
    "rolling_std", "rsi", "macd", "ewm_adjusted", "cross_section_zscore", "quantile_buckets", "rank_desc",
    "last_n_per_key", "elo_ratings", "time_ordered_split",
    "asof_latest_before", "fuzzy_name_join", "lookup_fallback_chain", "nine_table_star",
    "auc_exact", "roc_pr_points", "threshold_sweep", "backtest_stats", "linear_trend_forecast",
    "walk_forward_folds", "stratified_split",
    "flatten_nested_quotes", "extract_html_table", "insert_or_replace",
    "boosted_trees_delay",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    from quarry.plans.catalog import load_all
    from quarry.session import get_spark

    extra = {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
             "spark.sql.files.maxPartitionBytes": str(64 << 20)}
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2, app="quarry-bench", extra=extra)
    reg = load_all()
    names = only or HEADLINE

    spark.range(1000).selectExpr("sum(id)").collect()  # JVM warm-up
    times: dict[str, float] = {}
    for name in names:
        t0 = time.time()
        df = reg[name].build(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir, "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
