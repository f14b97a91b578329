"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame over the whole
driver tables.  Names start with the SURVEY inventory ID they exercise."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandflow.operators import analysis, backtest, clean, features, impute, metrics, models, panel, period, profile
from demandflow.plans.common import merged, normalize
from demandflow.session import partitions_for
from demandflow.sources import catalog, fixtures
from demandflow.sources.fixtures import FIXTURE_REGION_SUFFIX

Query = Callable[[SparkSession, str], DataFrame]


def _keyed(spark: SparkSession, sf_dir: str, freq: str = "W") -> tuple[DataFrame, str]:
    df = period.calc_time_deltas(merged(spark, sf_dir))
    return period.add_time_key(df, freq)


def period_table(spark: SparkSession, sf_dir: str, freq: str = "W") -> DataFrame:
    return period.build_period_table(merged(spark, sf_dir), freq, suffix_map=FIXTURE_REGION_SUFFIX)


def model_table(spark: SparkSession, sf_dir: str, freq: str = "W") -> DataFrame:
    return features.build_features(period_table(spark, sf_dir, freq))


# --- step 1: minimum slice ---------------------------------------------------------------
def q_sales_lag1_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2 -> A10 -> W6 (lag 1): weekly item count with its previous observed week."""
    df, key = period.add_time_key(merged(spark, sf_dir), "W")
    target = period.aggregate_sales_target(df, key)
    return features.add_lags(target, key, ["sales_qty"], [1])


# --- step 2: sources, cleaning, joins ---------------------------------------------------
def q_merged_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned, deduplicated item-grain table."""
    return normalize(merged(spark, sf_dir))


def q_top_categories_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of one state within its 7 best-selling categories."""
    return normalize(merged(spark, sf_dir, filter_state="NATION_11", top_k=7))


def q_customer_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5 exploration variant: upper-cased state, unknown -> 'estado inválido'; the stand-in
    state codes are matched against the fixed Brazilian map, so every row is 'unknown'
    except through the dimension variant computed alongside."""
    cust = fixtures.customers(spark, sf_dir)
    dim = fixtures.state_regions(spark, sf_dir)
    by_dim = clean.add_customer_region(cust, dim, out_col="region_dim")
    return clean.add_customer_region(by_dim, None, out_col="region_fixed", default=clean.INVALID_STATE_LABEL,
                                     upper=True)


# --- step 3/4: period table -----------------------------------------------------------------
def q_time_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """floored day differences and approval hours per item."""
    df = period.calc_time_deltas(merged(spark, sf_dir))
    return normalize(df.select("order_id", "order_item_id", "delivery_diff_estimated",
                               "estimated_delivery_lead_days", "approval_time_hours"))


def q_price_vars_product_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product x week mean price and its changes."""
    df, key = _keyed(spark, sf_dir)
    return normalize(period.compute_price_vars_by_product(df, key))


def q_price_vars_category_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category x week revenue-weighted changes."""
    df, key = _keyed(spark, sf_dir)
    pv = period.price_vars_from_partials(period.product_period_partials(df, key), key)
    return normalize(period.aggregate_price_vars_to_category(pv, key).drop("revenue_cat"))


def q_price_vars_time_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Week-level changes weighted by category revenue."""
    df, key = _keyed(spark, sf_dir)
    pv = period.price_vars_from_partials(period.product_period_partials(df, key), key)
    return normalize(period.aggregate_price_vars_to_time(period.aggregate_price_vars_to_category(pv, key), key))


def q_time_metrics_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide regional delivery metrics and sales-weighted means per week."""
    df, key = _keyed(spark, sf_dir)
    return normalize(period.aggregate_time_metrics_wide_weighted(df, key, suffix_map=FIXTURE_REGION_SUFFIX))


def q_sales_target_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10 daily."""
    df, key = _keyed(spark, sf_dir, "D")
    return period.aggregate_sales_target(df, key)


def q_period_table_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A12 (J8): the weekly period table."""
    return normalize(period_table(spark, sf_dir, "W"))


def q_period_table_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A12 daily."""
    return normalize(period_table(spark, sf_dir, "D"))


# --- step 5/6: features and imputation -----------------------------------------------------
def q_model_table_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """28 lags, 42 causal rollings, 16 calendar columns."""
    return normalize(model_table(spark, sf_dir, "W"))


def q_model_table_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same on the daily table (events are single days)."""
    return normalize(model_table(spark, sf_dir, "D"))


def q_imputed_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zero-filled changes and the have_nulls flag."""
    return normalize(impute.impute_nulls(model_table(spark, sf_dir, "W")))


QUERIES: dict[str, Query] = {
    "a10_w6_sales_lag1_weekly": q_sales_lag1_weekly,
    "p7_merged_items": q_merged_items,
    "p8_top_categories_state": q_top_categories_state,
    "p5_customer_region": q_customer_region,
    "f1_time_deltas": q_time_deltas,
    "w1_price_vars_product_weekly": q_price_vars_product_weekly,
    "a4_price_vars_category_weekly": q_price_vars_category_weekly,
    "a5_price_vars_time_weekly": q_price_vars_time_weekly,
    "a9_time_metrics_wide_weighted_weekly": q_time_metrics_weekly,
    "a10_sales_target_daily": q_sales_target_daily,
    "a12_period_table_weekly": q_period_table_weekly,
    "a12_period_table_daily": q_period_table_daily,
    "f9_model_table_weekly": q_model_table_weekly,
    "f9_model_table_daily": q_model_table_daily,
    "i5_imputed_weekly": q_imputed_weekly,
}


# --- step 7: folds, CV, metrics, sequences ---------------------------------------------------


FIRST_TRAIN_END = _dt.datetime(2000, 6, 25)
STEP = _dt.timedelta(days=7)


def weekly_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, key = period.add_time_key(merged(spark, sf_dir), "W")
    return period.aggregate_sales_target(df, key)


def lag_model_predictions(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Two naive 'models' (lag 1 and lag 4 of the weekly target), FIXTURES section 3."""
    lagged = features.add_lags(weekly_target(spark, sf_dir), "order_week", ["sales_qty"], [1, 4])
    return {f"lag{k}": lagged.select(F.col("order_week").alias("date"), F.col("sales_qty").alias("y_true"),
                                     F.col(f"sales_qty_lag{k}").alias("y_pred")) for k in (1, 4)}


def q_rolling_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1: expanding weekly folds after 2000-06-25, stopping at the first empty window."""
    return backtest.split_rolling(weekly_target(spark, sf_dir), "order_week", FIRST_TRAIN_END, STEP)


def q_time_series_cv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B2: three time-ordered CV splits of the static training weeks."""
    t = weekly_target(spark, sf_dir).where(F.col("order_week") <= F.lit(FIRST_TRAIN_END.date()))
    return backtest.time_series_cv(t, "order_week", 3)


def q_compare_lag_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five metrics for each naive model (seasonality 1)."""
    return normalize(metrics.compare_models(lag_model_predictions(spark, sf_dir)))


def q_metrics_seasonal4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B9 with a seasonal naive scale (s = 4) for the lag-1 model over the whole weekly series."""
    p = lag_model_predictions(spark, sf_dir)["lag1"]
    return normalize(metrics.calculate_metrics(p, order_col="date", seasonality=4))


def q_lookback_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """14-week look-back windows of the weekly target (as text for the value hash)."""
    seq = features.lookback_sequences(weekly_target(spark, sf_dir), "sales_qty", "order_week", 14)
    return seq.select("order_week", F.array_join(F.transform("x_seq", lambda v: v.cast("string")), ",")
                      .alias("x_seq_csv"), "y")


def q_seasonal_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """y_t - y_(t-52) on the weekly target."""
    return features.seasonal_difference(weekly_target(spark, sf_dir), "sales_qty", "order_week", 52,
                                        out_col="sales_qty_sdiff52")


def q_infer_freq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inferred frequency of the weekly and the daily period keys."""
    df = merged(spark, sf_dir)
    wk, _ = period.add_time_key(df, "W")
    dy, _ = period.add_time_key(df, "D")
    return (features.infer_freq_frame(wk, "order_week").withColumn("time_col", F.lit("order_week"))
            .unionByName(features.infer_freq_frame(dy, "order_date").withColumn("time_col", F.lit("order_date"))))


QUERIES.update({
    "b1_rolling_folds_weekly": q_rolling_folds,
    "b2_time_series_cv": q_time_series_cv,
    "b10_compare_lag_models": q_compare_lag_models,
    "b9_metrics_seasonal4": q_metrics_seasonal4,
    "w11_lookback_sequences": q_lookback_sequences,
    "w12_seasonal_difference": q_seasonal_difference,
    "w13_infer_freq": q_infer_freq,
})


# --- step 8: exploration -----------------------------------------------------------------------


def _raw(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    raw = fixtures.raw_tables(spark, sf_dir)
    raw["order_reviews"] = fixtures.order_reviews(spark, sf_dir)
    return raw


def _orders_with_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    from demandflow.functions.timecols import floor_days_between, hours_between
    o = fixtures.orders(spark, sf_dir)
    return o.withColumns({
        "approval_time_hours": hours_between("order_approved_at", "order_purchase_timestamp"),
        "prazo": floor_days_between("order_estimated_delivery_date", "order_purchase_timestamp")})


def q_duplicate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full-row duplicates per raw table."""
    out = None
    for name, df in _raw(spark, sf_dir).items():
        part = profile.duplicate_rows(df).withColumn("dataset", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


def q_null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10: columns with nulls per raw table."""
    out = None
    for name, df in _raw(spark, sf_dir).items():
        part = profile.null_profile(df).withColumn("dataset", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


def q_schema_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column types (engine-neutral names), non-null counts and positions of the merged
    table."""
    info = profile.schema_info(merged(spark, sf_dir))
    neutral = F.when(F.col("dtype") == "timestamp_ntz", F.lit("timestamp")).otherwise(F.col("dtype"))
    return info.withColumn("dtype", neutral)


def q_product_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``produto<n>`` labels by ascending product id (globally numbered)."""
    prods = merged(spark, sf_dir).select("product_id").distinct()
    return profile.ordinal_labels(prods, "product_id", "produto", "produto_n")


def q_price_vars_category_unweighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unweighted category means of the product changes."""
    df, key = _keyed(spark, sf_dir)
    pv = period.price_vars_from_partials(period.product_period_partials(df, key), key)
    return normalize(profile.category_price_means_unweighted(pv, key))


def q_products_per_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A13 (J13 natural join): orders with more than one distinct product."""
    raw = _raw(spark, sf_dir)
    o, i = raw["orders"].select("order_id"), raw["order_items"].select("order_id", "product_id")
    shared = [c for c in o.columns if c in i.columns]
    # join and group-by share one exchange, in parts of a fixed size
    n = partitions_for(i)
    o, i = o.repartition(n, *shared), i.repartition(n, *shared)
    return normalize(profile.share_with_more_than_one(o.join(i, shared), "order_id", "product_id"))


def q_sellers_per_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products sold by more than one seller."""
    return normalize(profile.share_with_more_than_one(_raw(spark, sf_dir)["order_items"], "product_id", "seller_id"))


def q_row_distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A15 (J2): rows and distinct ids of orders and of items (with their categories), as
    (metric, value) rows; exact distinct counts (``approx=True`` is the at-scale option)."""
    raw = _raw(spark, sf_dir)
    orders = profile.row_and_distinct_counts(raw["orders"], ["order_id"], "orders")
    items = profile.row_and_distinct_counts(raw["order_items"].join(raw["products"], "product_id", "left"),
                                            ["order_id", "order_item_id", "product_category_name"], "items")
    return orders.unionByName(items)


def q_capped_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product share by capped sales count, cumulative from the top."""
    return normalize(profile.capped_frequency(_raw(spark, sf_dir)["order_items"], 10))


def q_sales_volume_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A17, A19 (J14, J15): sales volume share and mean review per capped bucket."""
    raw = _raw(spark, sf_dir)
    return normalize(profile.sales_volume_by_bucket(raw["order_items"], raw["order_reviews"], 10))


def q_review_multiplicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct reviews per (order, product)."""
    raw = _raw(spark, sf_dir)
    return profile.review_multiplicity(raw["order_items"], raw["order_reviews"])


def q_category_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top-20 categories by sales, the rest as 'outros'."""
    raw = _raw(spark, sf_dir)
    return normalize(profile.category_table(raw["order_items"], raw["products"], 20))


def q_late_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late deliveries (estimated - carrier < 0) over order items."""
    raw = _raw(spark, sf_dir)
    return normalize(profile.late_share(raw["orders"].join(raw["order_items"], "order_id", "left")))


def q_describe_order_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """describe() of approval hours and promised lead days over orders."""
    return normalize(profile.describe_columns(_orders_with_times(spark, sf_dir), ["approval_time_hours", "prazo"]))


def q_summarize_period_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistical summary of the weekly period table's numeric columns."""
    return normalize(profile.summarize_features(period_table(spark, sf_dir, "W")))


def q_item_price_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W8 (J10, J12): item-grain % price changes of products with >= 3 sales."""
    raw = _raw(spark, sf_dir)
    return normalize(profile.item_price_changes(raw["orders"], raw["order_items"], 3))


def q_nonzero_change_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A24 (P13): % of item-grain price changes different from zero."""
    raw = _raw(spark, sf_dir)
    return normalize(profile.nonzero_change_share(profile.item_price_changes(raw["orders"], raw["order_items"], 3)))


def q_histogram_approval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """50-bin equal-width histogram of approval hours."""
    return normalize(profile.histogram(_orders_with_times(spark, sf_dir), "approval_time_hours", 50))


def q_box_lead_days_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A26 (J3, P5): box-plot statistics of promised lead days by customer region."""
    o = _orders_with_times(spark, sf_dir)
    cust = clean.add_customer_region(fixtures.customers(spark, sf_dir), fixtures.state_regions(spark, sf_dir))
    return normalize(profile.box_stats(o.join(cust, "customer_id", "left"), "prazo", "customer_region"))


def q_weekly_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each week's share of all items sold."""
    return normalize(profile.share_of_total(weekly_target(spark, sf_dir), "sales_qty"))


QUERIES.update({
    "p9_duplicate_rows": q_duplicate_rows,
    "p10_null_profile": q_null_profile,
    "p15_schema_info": q_schema_info,
    "p16_product_labels": q_product_labels,
    "a11_price_vars_category_unweighted_weekly": q_price_vars_category_unweighted,
    "a13_products_per_order": q_products_per_order,
    "a14_sellers_per_product": q_sellers_per_product,
    "a15_row_distinct_counts": q_row_distinct_counts,
    "a16_capped_sales_frequency": q_capped_frequency,
    "a17_a19_sales_volume_buckets": q_sales_volume_buckets,
    "a18_review_multiplicity": q_review_multiplicity,
    "a20_category_table": q_category_table,
    "a21_late_delivery_share": q_late_share,
    "a22_describe_order_times": q_describe_order_times,
    "a23_summarize_period_table": q_summarize_period_table,
    "w8_item_price_changes": q_item_price_changes,
    "a24_nonzero_price_change_share": q_nonzero_change_share,
    "a25_histogram_approval_hours": q_histogram_approval,
    "a26_box_lead_days_by_region": q_box_lead_days_region,
    "w10_weekly_share": q_weekly_share,
})


# --- step 9: feature analysis -----------------------------------------------------------------


def imputed_table(spark: SparkSession, sf_dir: str, freq: str = "W") -> DataFrame:
    return impute.impute_nulls(model_table(spark, sf_dir, freq))


def _analysis_input(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[str]]:
    """The imputed table, checkpointed: feature selection and the statistics then read it
    instead of each recomputing the pipeline."""
    from demandflow.session import materialize
    df = materialize(imputed_table(spark, sf_dir))
    return df, analysis.select_continuous_features(df, "sales_qty", 0.6, ["order_week"])


def q_continuous_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Non-null fraction, binary test and selection of each numeric column."""
    df = imputed_table(spark, sf_dir)
    return normalize(analysis.continuous_feature_profile(df, "sales_qty", 0.6, ["order_week"]))


def q_pearson(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pearson r, two-sided p-value and pairs used per selected feature."""
    df, feats = _analysis_input(spark, sf_dir)
    return normalize(analysis.compute_pearson_corr(df, "sales_qty", feats))


def q_mutual_information(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K-NN (k=3) mutual information per selected feature."""
    df, feats = _analysis_input(spark, sf_dir)
    return normalize(analysis.compute_mutual_information(df, "sales_qty", feats, "order_week", method="knn"))


def q_mutual_information_binned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E3 by quantile bins: mutual information per selected feature."""
    df, feats = _analysis_input(spark, sf_dir)
    return normalize(analysis.compute_mutual_information(df, "sales_qty", feats, grid=2.0 ** -20))


def q_item_mutual_information(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E3 at item grain, one group per (region, feature): what an item's price tells of its freight
    and its delivery times."""
    df = period.calc_time_deltas(merged(spark, sf_dir)).where(F.col("customer_region").isNotNull())
    feats = ["freight_value", "delivery_diff_estimated", "estimated_delivery_lead_days", "approval_time_hours"]
    return normalize(analysis.compute_mutual_information(df, "price", feats, series_keys=["customer_region"]))


def q_feature_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Combined rank with strength labels (mutual information by bins)."""
    df, _ = _analysis_input(spark, sf_dir)
    res = analysis.analyze_continuous_features(df, "sales_qty", "order_week", grid=2.0 ** -20)
    return normalize(res["rank"])


def q_relevant_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E6 filter: features not low on both Pearson and MI."""
    df, _ = _analysis_input(spark, sf_dir)
    res = analysis.analyze_continuous_features(df, "sales_qty", "order_week", grid=2.0 ** -20)
    return normalize(analysis.relevant_features(res["rank"]))


QUERIES.update({
    "e1_continuous_feature_profile": q_continuous_profile,
    "e2_pearson_corr": q_pearson,
    "e3_mutual_information": q_mutual_information,
    "e3_mutual_information_binned": q_mutual_information_binned,
    "e3_item_mutual_information_by_region": q_item_mutual_information,
    "e5_feature_rank": q_feature_rank,
    "e6_relevant_features": q_relevant_features,
})


# --- step 10: models and backtests -----------------------------------------------------------

TEST_START = _dt.date(2000, 6, 26)
TEST_END = _dt.date(2000, 11, 13)
# Registered GBT settings are small: every boosting round x tree level is one Spark job,
# and on the weekly test series job latency, not data, dominates.
GBT_PARAMS = {"maxDepth": 4, "stepSize": 0.1, "maxIter": 10, "minInstancesPerNode": 10, "subsamplingRate": 1.0}
SEARCH_GRID = {"maxDepth": [3, 4], "stepSize": [0.05, 0.1], "maxIter": [5, 10], "minInstancesPerNode": [5, 10]}


def lag_roll_features(df: DataFrame) -> list[str]:
    """Model features are the lag and rolling columns."""
    return [c for c in df.columns if "roll" in c or "lag" in c]


def _bt(df: DataFrame, fp, target: str = "sales_qty") -> DataFrame:
    return backtest.backtest(df, fp, "order_week", target, FIRST_TRAIN_END, STEP, TEST_START, TEST_END, parallelism=8)


def q_backtest_seasonal_naive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expanding-window backtest of the naive forecast over the test weeks."""
    return _naive_predictions(_weekly_input(spark, sf_dir))


def _naive_predictions(weekly: DataFrame) -> DataFrame:
    return _bt(weekly, models.seasonal_naive_fit_predict("sales_qty", "order_week", 1))


def _model_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The imputed weekly table, checkpointed once: fold and search loops then read it
    instead of recomputing the pipeline per Spark ML pass."""
    from demandflow.session import materialize
    return materialize(imputed_table(spark, sf_dir))


def _weekly_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weekly target, checkpointed once: every fold of every model reads these few rows."""
    from demandflow.session import materialize
    return materialize(weekly_target(spark, sf_dir))


def _gbt_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _model_input(spark, sf_dir)
    return _bt(df, models.gbt_fit_predict(lag_roll_features(df), "sales_qty", "order_week", GBT_PARAMS))


def _panel(df: DataFrame, model, series_keys: tuple[str, ...] = ()) -> DataFrame:
    return panel.panel_backtest(df, model, "order_week", "sales_qty", FIRST_TRAIN_END, STEP, TEST_START, TEST_END, series_keys)


def _additive_predictions(weekly: DataFrame) -> DataFrame:
    return _panel(weekly, panel.additive())


def _seasonal_arma_predictions(weekly: DataFrame) -> DataFrame:
    return _panel(weekly, panel.seasonal_arma(52))


def _lookback_predictions(weekly: DataFrame) -> DataFrame:
    return _panel(weekly, panel.lookback(4))


def q_gbt_backtest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gradient-boosted trees on the lag/rolling features, per fold."""
    return normalize(_gbt_predictions(spark, sf_dir))


def q_additive_backtest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trend + Fourier seasonality ridge regression, per fold."""
    return normalize(_additive_predictions(weekly_target(spark, sf_dir)))


def q_seasonal_ar_backtest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(1, 1, 1)(0, 1, 1, 52) by two-stage least squares, per fold."""
    return normalize(_seasonal_arma_predictions(weekly_target(spark, sf_dir)))


def q_lookback_backtest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Standardised 4-week look-back linear autoregression, per fold."""
    return normalize(_lookback_predictions(weekly_target(spark, sf_dir)))


def q_model_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metric table of the five forecasters over the test weeks."""
    weekly = _weekly_input(spark, sf_dir)
    preds = {
        "seasonal_naive": _naive_predictions(weekly),
        "gbt": _gbt_predictions(spark, sf_dir),
        "additive": _additive_predictions(weekly),
        "seasonal_ar": _seasonal_arma_predictions(weekly),
        "lookback": _lookback_predictions(weekly),
    }
    return normalize(metrics.compare_models(preds))


def q_gbt_random_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B3 (B2): seeded random search (4 draws) over a GBT grid with 3 time-ordered CV splits."""
    df = _model_input(spark, sf_dir)
    _, table = models.random_search_gbt(df, lag_roll_features(df), "order_week", "sales_qty",
                                        FIRST_TRAIN_END.date(), 3, 4, SEARCH_GRID, parallelism=8)
    return normalize(table)


def q_feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GBT feature importances on the static training window."""
    df = _model_input(spark, sf_dir)
    feats = lag_roll_features(df)
    train = df.where(F.col("order_week") <= F.lit(FIRST_TRAIN_END.date()))
    (tr,) = models.fill_from_train(train, [train], feats)
    model, _ = models.gbt_model(tr, feats, "sales_qty", "order_week", GBT_PARAMS)
    return normalize(models.feature_importances(spark, model, feats))


QUERIES.update({
    "b5_backtest_seasonal_naive": q_backtest_seasonal_naive,
    "b4_gbt_backtest": q_gbt_backtest,
    "b7_additive_backtest": q_additive_backtest,
    "b8_seasonal_ar_backtest": q_seasonal_ar_backtest,
    "b8b_lookback_backtest": q_lookback_backtest,
    "b11_model_metrics": q_model_metrics,
    "b3_gbt_random_search": q_gbt_random_search,
    "b6_feature_importance": q_feature_importance,
})


# --- series_keys: the same operators over many series -------------------------------------------
def region_weekly_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, key = period.add_time_key(merged(spark, sf_dir), "W")
    return period.aggregate_sales_target(df.where(F.col("customer_region").isNotNull()), key, ["customer_region"])


def q_region_lags_rollings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10, W6, W7 per series: weekly items per region with lags and causal rollings
    computed in windows partitioned by region."""
    t = region_weekly_target(spark, sf_dir)
    return normalize(features.add_lags_and_rollings(t, "order_week", ["sales_qty"], features.LAGS, ["sales_qty"],
                                                    features.ROLL_WINDOWS, series_keys=["customer_region"]))


def q_region_lag_model_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B9 per series: metrics of the lag-1 forecast for each region (naive scale per region)."""
    t = features.add_lags(region_weekly_target(spark, sf_dir), "order_week", ["sales_qty"], [1],
                          series_keys=["customer_region"])
    p = t.select("customer_region", F.col("order_week").alias("date"), F.col("sales_qty").alias("y_true"),
                 F.col("sales_qty_lag1").alias("y_pred"))
    return normalize(metrics.calculate_metrics(p, order_col="date", group_cols=["customer_region"]))


def q_region_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1 per series: expanding folds of each region's weekly series."""
    return backtest.split_rolling(region_weekly_target(spark, sf_dir), "order_week", FIRST_TRAIN_END, STEP,
                                  series_keys=["customer_region"])


def q_fold_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weekly rows of every fold with their role."""
    return panel.fold_rows(weekly_target(spark, sf_dir), "order_week", FIRST_TRAIN_END, STEP)


def q_region_fold_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J17 per series."""
    return panel.fold_rows(region_weekly_target(spark, sf_dir), "order_week", FIRST_TRAIN_END, STEP, ["customer_region"])


def q_region_additive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B7 per series: all regions and folds in one job."""
    return normalize(_panel(region_weekly_target(spark, sf_dir), panel.additive(), ("customer_region",)))


def q_region_lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B8b per series: all regions and folds in one job."""
    return normalize(_panel(region_weekly_target(spark, sf_dir), panel.lookback(4), ("customer_region",)))


def q_region_seasonal_arma(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B8 per series: all regions and folds in one job."""
    return normalize(_panel(region_weekly_target(spark, sf_dir), panel.seasonal_arma(13), ("customer_region",)))


QUERIES.update({
    "j17_fold_rows_weekly": q_fold_rows,
    "j17_region_fold_rows": q_region_fold_rows,
    "b7_region_additive_backtest": q_region_additive,
    "b8_region_seasonal_arma_backtest": q_region_seasonal_arma,
    "b8b_region_lookback_backtest": q_region_lookback,
    "w7_region_lags_rollings": q_region_lags_rollings,
    "b9_region_lag_model_metrics": q_region_lag_model_metrics,
    "b1_region_folds": q_region_folds,
})


# --- A2/A6/A10 fallbacks and I5 diagnostics ------------------------------------------------------
def q_period_table_order_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 (ii), A6, A10 fallbacks: without an item id, revenue weights, regional sales
    weights and the target count distinct orders."""
    m = merged(spark, sf_dir).drop("order_item_id")
    return normalize(period.build_period_table(m, "W", suffix_map=FIXTURE_REGION_SUFFIX))


def q_imputation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null cells before and after imputation and the share of rows with have_nulls."""
    return normalize(impute.imputation_summary(model_table(spark, sf_dir, "W")))


QUERIES.update({
    "a12_period_table_weekly_order_weights": q_period_table_order_weights,
    "i5_imputation_summary": q_imputation_summary,
})


def q_period_table_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A12 per series: the weekly period table of every customer state (series_keys), with
    price windows partitioned by (state, product) and every aggregate keyed by state."""
    return normalize(period.build_period_table(merged(spark, sf_dir), "W", series_keys=["customer_state"],
                                               suffix_map=FIXTURE_REGION_SUFFIX))


QUERIES["a12_period_table_weekly_by_state"] = q_period_table_by_state


def q_mutual_information_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E3 without the tie-breaking jitter: the same k-NN estimator (k=3) on z-scores snapped
    to the 2**-20 grid, so ties are exact and a brute-force SQL twin exists."""
    df, feats = _analysis_input(spark, sf_dir)
    return normalize(analysis.compute_mutual_information(df, "sales_qty", feats, "order_week", method="knn", random_state=None,
                                                         grid=2.0 ** -20))


QUERIES["e3_mutual_information_exact"] = q_mutual_information_exact


def _rank_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, feats = _analysis_input(spark, sf_dir)
    pearson = analysis.compute_pearson_corr(df, "sales_qty", feats)
    mi = analysis.compute_mutual_information(df, "sales_qty", feats, "order_week", method="knn", random_state=None, grid=2.0 ** -20)
    return analysis.add_strength_labels(analysis.combined_rank(pearson, mi))


def q_feature_rank_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E5, F13, J16 on the jitter-free mutual information: normalised |r| and MI, their
    null-aware mean and the strength labels."""
    return normalize(_rank_exact(spark, sf_dir))


def q_relevant_features_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E6 on the jitter-free mutual information: features not low on both criteria."""
    return normalize(analysis.relevant_features(_rank_exact(spark, sf_dir)))


QUERIES["e5_feature_rank_exact"] = q_feature_rank_exact
QUERIES["e6_relevant_features_exact"] = q_relevant_features_exact


def q_feature_subset_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importances on the static training window, then one backtest per top-k feature
    set (k = 10..60) with one metric row per k."""
    df = _model_input(spark, sf_dir)
    feats = lag_roll_features(df)
    train = df.where(F.col("order_week") <= F.lit(FIRST_TRAIN_END.date()))
    (tr,) = models.fill_from_train(train, [train], feats)
    model, _ = models.gbt_model(tr, feats, "sales_qty", "order_week", GBT_PARAMS)
    imp = models.feature_importances(spark, model, feats)
    return normalize(models.feature_subset_sweep(df, imp, [10, 20, 30, 40, 50, 60], "sales_qty", "order_week",
                                                 FIRST_TRAIN_END, STEP, TEST_START, TEST_END, GBT_PARAMS,
                                                 parallelism=8))


QUERIES["b6_feature_subset_sweep"] = q_feature_subset_sweep


# --- sources and sinks, and data that reaches the rarer branches -----------------------------------
def _round_trip_dir(spark: SparkSession) -> str:
    from uuid import uuid4

    from demandflow.session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/round-trip-{uuid4().hex}"


def q_csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as CSV with dates as text, some of them no dates, loaded by
    name and parsed."""
    base, o = _round_trip_dir(spark), fixtures.orders(spark, sf_dir)
    approved = F.when(F.col("order_id").cast("bigint") % 91 == 0, "not a date").otherwise(F.col("order_approved_at").cast("string"))
    catalog.write_csv(o.withColumns({"order_approved_at": approved, "order_purchase_timestamp": F.col("order_purchase_timestamp").cast("string"),
                                     "order_estimated_delivery_date": F.col("order_estimated_delivery_date").cast("string")}), f"{base}/shop_orders.csv")
    return clean.coerce_datetime(catalog.resolve_table(catalog.load_dataset(spark, base), "ORDERS"))


def q_csv_multi_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review comments with line breaks and quotes, through CSV."""
    base, rv = _round_trip_dir(spark), fixtures.order_reviews(spark, sf_dir)
    comment = F.concat(F.lit("score "), F.col("review_score"), F.lit('\nof "'), F.col("order_id"), F.lit('", fine'))
    catalog.write_csv(rv.withColumn("comment", comment), f"{base}/shop_order_reviews.csv")
    return catalog.resolve_table(catalog.load_dataset(spark, base), "order_reviews")


def q_parquet_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers written as Parquet by state and read back."""
    path = f"{_round_trip_dir(spark)}/customers"
    catalog.write_parquet(fixtures.customers(spark, sf_dir), path, ["customer_state"])
    return catalog.read_parquet(spark, path)


def q_csv_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The category report re-read, for categories of the first brand group."""
    path, raw = f"{_round_trip_dir(spark)}/report", _raw(spark, sf_dir)
    report = profile.category_table(raw["order_items"], raw["products"], 20)
    catalog.write_csv(report, path)
    chosen = raw["products"].where(F.col("product_category_name").startswith("Brand#1")).select(F.col("product_category_name").alias("categoria"))
    return normalize(catalog.read_csv_semi(spark, path, chosen, "categoria", report.schema))


def q_state_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5 with the fixed map: each nation stands for a state code (lower case, as typed), one code unknown."""
    codes = ["ac", "al", "am", "ap", "ba", "ce", "df", "es", "go", "ma", "mg", "ms", "mt", "pa", "pb", "pe", "pi", "pr", "rj", "rn", "ro", "rr",
             "rs", "sc", "se", "sp", "to", "xx"]
    state = F.element_at(F.lit(codes), (F.col("c_custkey") % 28 + 1).cast("int"))
    cust = fixtures.table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("customer_id"), state.alias("customer_state"))
    typed = clean.add_customer_region(cust, out_col="region_typed", default=clean.INVALID_STATE_LABEL, upper=True)
    return clean.add_customer_region(typed.withColumn("customer_state", F.upper("customer_state")))


def _repeated_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of which some come again with another price, others as they are."""
    items = fixtures.order_items(spark, sf_dir)
    key = F.col("order_id").cast("bigint")
    return items.unionByName(items.where(key % 50 == 0).withColumn("price", F.col("price") + 1)).unionByName(items.where(key % 75 == 0))


def q_removed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, kept and removed."""
    return clean.dedupe_report(_repeated_items(spark, sf_dir))


def q_deduped_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first row of each item key."""
    return normalize(clean.dedupe_items(_repeated_items(spark, sf_dir), order_by=("product_id", "seller_id", "price")))


def q_period_table_price_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 (iii): without item and order ids, price sums weigh and rows count."""
    m = merged(spark, sf_dir).drop("order_item_id", "order_id")
    return normalize(period.build_period_table(m, "W", suffix_map=FIXTURE_REGION_SUFFIX))


def q_regions_from_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A region outside the suffix map gets columns of its own."""
    df, key = _keyed(spark, sf_dir)
    known = {k: v for k, v in FIXTURE_REGION_SUFFIX.items() if k != "ASIA"}
    return normalize(period.aggregate_time_metrics_wide_weighted(df, key, suffix_map=known))


def q_holiday_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8: the holiday calendar over the years of the orders."""
    span = fixtures.orders(spark, sf_dir).agg(F.min(F.year("order_purchase_timestamp")).alias("a"), F.max(F.year("order_purchase_timestamp")).alias("b")).first()
    return features.br_holiday_table(spark, span["a"], span["b"]).select("date")


def q_holiday_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J9 with a holiday table: holidays of each week."""
    weeks = weekly_target(spark, sf_dir)
    out = features.add_calendar_features(weeks, "order_week", "W", features.br_holiday_table(spark, 1980, 2030))
    return out.select("order_week", "is_br_holiday_week", "n_br_holidays_week")


def q_capped_frequency_40(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A16, W9 with a cap that many products stay below."""
    return normalize(profile.capped_frequency(_raw(spark, sf_dir)["order_items"], 40))


def q_sales_volume_buckets_40(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A17, A19 with a cap that many products stay below."""
    raw = _raw(spark, sf_dir)
    return normalize(profile.sales_volume_by_bucket(raw["order_items"], raw["order_reviews"], 40))


def q_review_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of products with two reviews of one order."""
    raw = _raw(spark, sf_dir)
    return profile.review_examples(raw["order_items"], raw["order_reviews"], 2)


def q_standardized_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly sales standardised with the statistics of the first training window."""
    t = weekly_target(spark, sf_dir)
    out, _ = analysis.standardize(t, ["sales_qty"], t.where(F.col("order_week") <= F.lit(FIRST_TRAIN_END.date())), "_z")
    return normalize(out)


def q_real_vs_predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Real and predicted sales of the look-back forecasts in time order."""
    return normalize(metrics.real_vs_predicted(_lookback_predictions(weekly_target(spark, sf_dir))))


QUERIES.update({
    "s1_csv_round_trip": q_csv_round_trip,
    "s1_csv_multi_line": q_csv_multi_line,
    "s3_parquet_round_trip": q_parquet_round_trip,
    "s6_csv_semi": q_csv_semi,
    "p5_state_codes": q_state_codes,
    "p7_removed_items": q_removed_items,
    "p7_deduped_items": q_deduped_items,
    "a12_period_table_weekly_price_sums": q_period_table_price_sums,
    "a9_regions_from_data": q_regions_from_data,
    "f8_holiday_table": q_holiday_table,
    "j9_holiday_join": q_holiday_join,
    "a16_capped_sales_frequency_40": q_capped_frequency_40,
    "a17_a19_sales_volume_buckets_40": q_sales_volume_buckets_40,
    "a18_review_examples": q_review_examples,
    "e4_standardized_sales": q_standardized_sales,
    "b12_real_vs_predicted": q_real_vs_predicted,
})
