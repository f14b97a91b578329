"""Registered queries against their DuckDB twins on the smallest scale factor."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

SUBSET = [
    "a10_w6_sales_lag1_weekly", "p7_merged_items", "p8_top_categories_state", "a12_period_table_weekly",
    "a12_period_table_weekly_order_weights", "f9_model_table_daily", "i5_imputed_weekly", "b10_compare_lag_models",
    "a20_category_table", "a17_a19_sales_volume_buckets", "e2_pearson_corr", "w8_item_price_changes",
    "b1_rolling_folds_weekly", "b5_backtest_seasonal_naive", "w7_region_lags_rollings", "a26_box_lead_days_by_region",
]


@pytest.mark.parametrize("name", SUBSET)
def test_query_matches_duckdb(spark, name):
    from oracle_check import compare
    report = compare(spark, "/root/testdata/sf0.001", [name])
    entry = report[name]
    assert entry.get("ok") is True, entry
