"""Physical-plan checks: pushdown reaches the scan, feature operators stay
JVM-side (no Python evaluation), global ranks avoid a single-partition
sort of raw rows."""

from conftest import TEST_SF


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_pushdown_and_pruning(spark, registry):
    p = _plan(registry["scan_sql_table"].build(spark, TEST_SF))
    assert "PushedFilters: [IsNotNull(l_suppkey), EqualTo(l_suppkey,7)]" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_suppkey:bigint,l_linenumber:int,l_quantity:double" in p


def test_feature_operators_have_no_python(spark, registry):
    for name in ["group_rate_stats", "rsi", "macd", "ewm_adjusted", "cross_section_zscore", "rolling_std",
                 "cohort_retention", "latest_snapshot_join", "fuzzy_name_join"]:
        p = _plan(registry[name].build(spark, TEST_SF))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_global_rank_has_no_single_partition_sort(spark, registry):
    p = _plan(registry["rank_desc"].build(spark, TEST_SF))
    assert "SinglePartition" not in p
    assert "MapInPandas" in p or "PythonMapInArrow" in p


AUDITED = ["group_rate_stats", "payment_benchmarks", "gini", "top_share", "cohort_retention", "rfm",
           "rolling_std", "macd", "ewm_adjusted", "expanding_prior_stats", "quantile_buckets", "rank_desc",
           "time_ordered_split", "asof_latest_before", "fuzzy_name_join", "auc_exact", "roc_pr_points",
           "backtest_stats", "cum_product", "walk_forward_folds", "stratified_split", "label_encode",
           "last_n_per_key", "insert_or_replace", "flatten_nested_quotes", "extract_html_table"]


def test_no_single_partition_exchange_over_raw_rows(spark, registry):
    """A SinglePartition exchange may only sit on top of a partial
    aggregate (one row per task); never on raw rows."""
    for name in AUDITED:
        lines = _plan(registry[name].build(spark, TEST_SF)).split("\n")
        for i, line in enumerate(lines):
            if "Exchange SinglePartition" in line:
                child = lines[i + 1] if i + 1 < len(lines) else ""
                assert "HashAggregate" in child or "ObjectHashAggregate" in child, (name, child)
