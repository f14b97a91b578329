"""Stage runners with file boundaries, one per step of the original workflow:

raw CSV directory -> merged Parquet -> period Parquet -> features Parquet -> imputed Parquet,
then the feature-analysis reports (CSV) and the backtest metric table (CSV).

Each runner reads its input with S1/S3, writes with S4/S5 and returns the output path, so
a later stage (or a restarted job after executor loss) starts from durable files instead
of recomputing the lineage.
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from demandflow.operators import analysis, backtest, clean, features, impute, metrics, models, panel, period
from demandflow.sources.catalog import load_dataset, read_csv_semi, read_parquet, resolve_table, write_csv, write_parquet

MERGED = "merged.parquet"


def _period_name(freq: str) -> str:
    return "weekly_agg.parquet" if freq.upper() == "W" else "daily_agg.parquet"


def run_merge_stage(spark: SparkSession, raw_dir: str, out_dir: str, filter_state: str | None = None,
                    top_k: int = 7, region_mapping=None) -> str:
    """S1, S2 -> build_merged -> S4."""
    cat = load_dataset(spark, raw_dir)
    df = clean.build_merged(resolve_table(cat, "orders"), resolve_table(cat, "order_items"),
                            resolve_table(cat, "products"), resolve_table(cat, "customers"),
                            region_mapping=region_mapping, filter_state=filter_state, top_k=top_k)
    out = os.path.join(out_dir, MERGED)
    write_parquet(df, out)
    return out


def run_period_stage(spark: SparkSession, out_dir: str, freq: str = "W", series_keys=(), suffix_map=None) -> str:
    """S3 -> build_period_table -> S4 (partitioned by year of the period)."""
    merged = read_parquet(spark, os.path.join(out_dir, MERGED))
    kw = {"suffix_map": suffix_map} if suffix_map else {}
    table = period.build_period_table(merged, freq, series_keys, **kw)
    key = "order_week" if freq.upper() == "W" else "order_date"
    out = os.path.join(out_dir, _period_name(freq))
    write_parquet(table.withColumn("period_year", F.year(key)), out, partition_by=["period_year"])
    return out


def run_feature_stage(spark: SparkSession, out_dir: str, freq: str = "W", series_keys=(), **kw) -> str:
    """S3 -> lags, rollings, calendar -> S4."""
    table = read_parquet(spark, os.path.join(out_dir, _period_name(freq))).drop("period_year")
    out = os.path.join(out_dir, _period_name(freq).replace(".parquet", "_withlags.parquet"))
    write_parquet(features.build_features(table, series_keys=series_keys, **kw), out)
    return out


def run_impute_stage(spark: SparkSession, out_dir: str, freq: str = "W") -> str:
    """S3 -> impute_nulls -> S4."""
    src = os.path.join(out_dir, _period_name(freq).replace(".parquet", "_withlags.parquet"))
    out = src.replace(".parquet", "_imputed.parquet")
    write_parquet(impute.impute_nulls(read_parquet(spark, src)), out)
    return out


def run_analysis_stage(spark: SparkSession, imputed_path: str, reports_dir: str, target_col: str = "sales_qty",
                       order_col: str = "order_week", prefix: str = "feature_") -> dict[str, str]:
    """E7 with its three CSV reports (S5) and the list of relevant features."""
    df = read_parquet(spark, imputed_path)
    res = analysis.analyze_continuous_features(df, target_col, order_col)
    paths = {}
    for name, key in (("corr_pearson", "pearson"), ("mutual_info", "mi"), ("rank", "rank")):
        paths[name] = os.path.join(reports_dir, f"{prefix}{name}.csv")
        write_csv(res[key], paths[name])
    paths["relevant"] = os.path.join(reports_dir, f"{prefix}relevant.csv")
    write_csv(analysis.relevant_features(res["rank"]).select("feature"), paths["relevant"])
    return paths


def run_backtest_stage(spark: SparkSession, imputed_path: str, reports_dir: str, first_train_end: dt.datetime,
                       step: dt.timedelta, test_start: dt.date, test_end: dt.date, relevant_csv: str | None = None,
                       target_col: str = "sales_qty", date_col: str = "order_week",
                       gbt_params: dict | None = None) -> str:
    """Entry 3: folds (B1), forecasters (B4, B7, B8, B8b and the naive baseline), metrics per
    model (B10) written as one CSV (B11, S5).  With ``relevant_csv`` the tree model uses the
    features kept by the analysis stage (S6)."""
    df = read_parquet(spark, imputed_path).drop("period_year")
    feats = [c for c in df.columns if "roll" in c or "lag" in c]
    if relevant_csv:
        chosen = spark.createDataFrame([(f,) for f in feats], "feature string")
        kept = {r.feature for r in read_csv_semi(spark, relevant_csv, chosen, schema="feature string").collect()}
        feats = [f for f in feats if f in kept] or feats
    window = (date_col, target_col, first_train_end, step, test_start, test_end)
    preds = {
        "seasonal_naive": backtest.backtest(df, models.seasonal_naive_fit_predict(target_col, date_col, 1), *window),
        "gbt": backtest.backtest(df, models.gbt_fit_predict(feats, target_col, date_col, gbt_params), *window),
        "additive": panel.panel_backtest(df, panel.additive(), *window),
        "seasonal_ar": panel.panel_backtest(df, panel.seasonal_arma(52), *window),
        "lookback": panel.panel_backtest(df, panel.lookback(4), *window),
    }
    out = os.path.join(reports_dir, "metrics_all.csv")
    write_csv(metrics.compare_models(preds), out)
    return out
