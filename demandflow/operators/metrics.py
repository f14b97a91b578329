"""Forecast error metrics (B9-B12): RMSE, MAPE, WAPE, MASE, RMSSE in one window + one
aggregation, optionally per group (model, series, fold)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

METRICS = ["rmse", "mape", "wape", "mase", "rmsse"]


def calculate_metrics(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred", order_col: str = "date",
                      group_cols: Iterable[str] = (), dropna: bool = True, seasonality: int = 1) -> DataFrame:
    """One row per group.

    MASE and RMSSE scale by the naive error y_t - y_(t-s) of the *evaluated* rows in
    ``order_col`` order (after null rows are dropped); n <= s, or a zero scale, gives
    null.  MAPE skips rows with y = 0; WAPE is null when sum|y| = 0.  An empty input gives
    one all-null row when there are no group columns.
    """
    missing = [c for c in (y_true, y_pred, order_col) if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    group_cols = list(group_cols)
    data = df.select(*group_cols, F.col(order_col), F.col(y_true).cast("double").alias("__y"),
                     F.col(y_pred).cast("double").alias("__p"))
    if dropna:
        data = data.where(F.col("__y").isNotNull() & F.col("__p").isNotNull()
                          & ~F.isnan("__y") & ~F.isnan("__p"))
    w = (Window.partitionBy(*group_cols) if group_cols else Window).orderBy(order_col)
    data = data.withColumn("__naive", F.col("__y") - F.lag("__y", seasonality).over(w))
    e = F.col("__y") - F.col("__p")
    n = F.count(F.lit(1))
    rmse = F.sqrt(F.avg(e * e))
    naive_mae = F.avg(F.abs("__naive"))
    naive_rmse = F.sqrt(F.avg(F.col("__naive") * F.col("__naive")))
    enough = n > seasonality
    aggs = [
        rmse.alias("rmse"),
        (F.avg(F.when(F.col("__y") != 0, F.abs(e / F.col("__y")))) * 100).alias("mape"),
        (F.try_divide(F.sum(F.abs(e)), F.nullif(F.sum(F.abs("__y")), F.lit(0.0))) * 100).alias("wape"),
        F.when(enough, F.try_divide(F.avg(F.abs(e)), F.nullif(naive_mae, F.lit(0.0)))).alias("mase"),
        F.when(enough, F.try_divide(rmse, F.nullif(naive_rmse, F.lit(0.0)))).alias("rmsse"),
    ]
    return data.groupBy(*group_cols).agg(*aggs)


def compare_models(predictions: Mapping[str, DataFrame], y_true: str = "y_true", y_pred: str = "y_pred",
                   order_col: str = "date", seasonality: int = 1, label_col: str = "model") -> DataFrame:
    """Union the models' predictions with a label, one metric row per model."""
    frames = [p.select(F.lit(name).alias(label_col), order_col, y_true, y_pred) for name, p in predictions.items()]
    allp = frames[0]
    for f in frames[1:]:
        allp = allp.unionByName(f)
    return calculate_metrics(allp, y_true, y_pred, order_col, [label_col], seasonality=seasonality)


def real_vs_predicted(predictions: DataFrame, order_col: str = "date") -> DataFrame:
    """The data behind the real-vs-predicted chart, in time order."""
    return predictions.orderBy(order_col)
