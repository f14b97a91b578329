"""The stage runners end to end on raw CSV files (stand-in tables written as CSV)."""

import datetime as dt

from pyspark.sql import functions as F

from demandflow.plans import stages
from demandflow.sources import fixtures
from demandflow.sources.fixtures import FIXTURE_REGION_SUFFIX


def test_stages_end_to_end(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    tables = fixtures.raw_tables(spark, "/root/testdata/sf0.001")
    names = {"orders": "shop_orders", "order_items": "shop_order_items",
             "products": "shop_products", "customers": "shop_customers"}
    for role, df in tables.items():   # small stand-in tables written as single CSV files
        df.toPandas().to_csv(raw / f"{names[role]}.csv", index=False)
    out = tmp_path / "interim"
    regions = fixtures.state_regions(spark, "/root/testdata/sf0.001")
    merged = stages.run_merge_stage(spark, str(raw), str(out), region_mapping=regions)
    from demandflow.plans.common import merged as merged_direct
    assert spark.read.parquet(merged).count() == merged_direct(spark, "/root/testdata/sf0.001").count()
    stages.run_period_stage(spark, str(out), "W", suffix_map=FIXTURE_REGION_SUFFIX)
    stages.run_feature_stage(spark, str(out), "W")
    imputed = stages.run_impute_stage(spark, str(out), "W")
    df = spark.read.parquet(imputed)
    assert "have_nulls" in df.columns and df.count() > 100
    reports = stages.run_analysis_stage(spark, imputed, str(tmp_path / "reports"))
    rank = spark.read.option("header", True).csv(reports["rank"])
    assert rank.count() > 10 and "score" in rank.columns
    weeks = sorted(r.order_week for r in df.select("order_week").collect())
    # folds stop at the first empty week, so cut just before three consecutive weeks
    i = max(j for j in range(60, len(weeks) - 3)
            if all((weeks[j + k + 1] - weeks[j + k]).days == 7 for k in range(3)))
    cut = weeks[i]
    path = stages.run_backtest_stage(
        spark, imputed, str(tmp_path / "reports"), dt.datetime.combine(cut, dt.time()), dt.timedelta(days=7),
        cut, weeks[i + 3], relevant_csv=reports["relevant"], gbt_params={"maxIter": 5, "maxDepth": 3})
    m = spark.read.option("header", True).csv(path)
    assert sorted(r.model for r in m.collect()) == ["additive", "gbt", "lookback", "seasonal_ar", "seasonal_naive"]
