"""Forecasters for the backtest loop (B3, B4, B6) on Spark ML, plus a pure-SQL seasonal
naive baseline.  The linear forecasters (B7, B8, B8b) are in :mod:`panel`.

Each ``*_fit_predict`` factory returns ``fit_predict(train, valid) -> valid + prediction``
for ``backtest``.  Fitting statistics (means, changepoints, scales) are computed on the
training rows only.  Digits differ from the original gradient-boosting, Bayesian
structural, state-space and recurrent-network libraries; the capability (fit, tune,
backtest, compare) is the same.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterable, Mapping

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandflow.operators.backtest import cv_frames, lit_like

# Search space of the gradient-boosted trees.  Sizes follow the original grid where Spark
# has the parameter (depth, learning rate, rounds, row and column sampling, minimum leaf
# size); leaf count and L1/L2 penalties have no GBTRegressor counterpart.  Unlimited depth
# maps to 6.
GBT_GRID: dict[str, list] = {
    "maxDepth": [6, 8, 12],
    "stepSize": [0.03, 0.05, 0.1],
    "maxIter": [200, 400, 800],
    "subsamplingRate": [0.8, 1.0],
    "featureSubsetStrategy": ["0.8", "all"],
    "minInstancesPerNode": [10, 20, 30],
}


def _with_prediction(valid: DataFrame, pred: DataFrame, keys: list[str]) -> DataFrame:
    return valid.join(pred.select(*keys, "prediction"), keys, "left")


# --- seasonal naive ------------------------------------------------------------------------
def seasonal_naive_fit_predict(target_col: str, date_col: str, season: int = 1,
                               series_keys: Iterable[str] = ()):
    """y_hat_t = y_(t-s) from the observed history (train rows, then true valid values)."""
    keys = list(series_keys)

    def fit_predict(train: DataFrame, valid: DataFrame) -> DataFrame:
        hist = train.select(*keys, date_col, target_col).unionByName(valid.select(*keys, date_col, target_col))
        w = (Window.partitionBy(*keys) if keys else Window).orderBy(date_col)
        lagged = hist.select(*keys, date_col, F.lag(target_col, season).over(w).cast("double").alias("prediction"))
        return _with_prediction(valid, lagged, [*keys, date_col])

    return fit_predict


# --- gradient-boosted trees -------------------------------------------------------------------
def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def fill_from_train(train: DataFrame, frames: list[DataFrame], features: list[str]) -> list[DataFrame]:
    """Mean imputation fitted on ``train`` (all-null columns fall back to 0) plus a cast to
    double, applied to every frame.  SQL text, as each call on a column object costs the driver
    milliseconds and there are many features and folds."""
    row = train.selectExpr(*[f"avg(cast({_quoted(c)} as double)) as {_quoted(c)}" for c in features]).first()
    fills = {c: float(v if v is not None else 0.0) for c, v in zip(features, row)}
    filled = {c: F.expr(f"coalesce(cast({_quoted(c)} as double), cast('{v!r}' as double))") for c, v in fills.items()}
    return [f.withColumns(filled) for f in frames]


def _tail_flag(train: DataFrame, date_col: str, fraction: float) -> DataFrame:
    """Marks the last ``fraction`` of training rows (by date) as early-stopping rows."""
    rank = F.percent_rank().over(Window.orderBy(date_col))
    return train.withColumn("__is_val", rank > F.lit(1.0 - fraction))


def gbt_model(train: DataFrame, features: list[str], target_col: str, date_col: str,
              params: Mapping | None = None, validation_fraction: float = 0.0, seed: int = 42):
    """B4 fit: GBTRegressor on mean-imputed features; with ``validation_fraction`` the
    tail of the training window drives early stopping (never the validation rows)."""
    params = dict(params or {})
    assembler = VectorAssembler(inputCols=features, outputCol="__features", handleInvalid="keep")
    data = assembler.transform(train)
    kw = {}
    if validation_fraction > 0:
        data = _tail_flag(data, date_col, validation_fraction)
        kw["validationIndicatorCol"] = "__is_val"
    data = data.select("__features", F.col(target_col).cast("double").alias(target_col), *kw.values())
    return _fit_gbt(data, target_col, params, seed, **kw), assembler


def _fit_gbt(data: DataFrame, target_col: str, params: Mapping, seed: int, **kw):
    gbt = GBTRegressor(featuresCol="__features", labelCol=target_col, seed=seed, **kw, **params)
    # the estimator scans its input several times; persist it for the fit only
    data = data.persist()
    try:
        return gbt.fit(data)
    finally:
        data.unpersist()


def gbt_fit_predict(features: list[str], target_col: str, date_col: str, params: Mapping | None = None,
                    validation_fraction: float = 0.0, seed: int = 42, keep_model: list | None = None):
    def fit_predict(train: DataFrame, valid: DataFrame) -> DataFrame:
        tr, va = fill_from_train(train, [train, valid], features)
        model, assembler = gbt_model(tr, features, target_col, date_col, params, validation_fraction, seed)
        if keep_model is not None:
            keep_model.append(model)
        return model.transform(assembler.transform(va)).drop("__features")
    return fit_predict


def feature_importances(spark, model, features: list[str]) -> DataFrame:
    """(feature, importance) of a fitted tree ensemble (one value per feature)."""
    imp = model.featureImportances.toArray().tolist()
    return spark.createDataFrame(list(zip(features, [float(v) for v in imp])), "feature string, importance double")


def top_k_feature_sets(importances: DataFrame, ks: Iterable[int]) -> dict[int, list[str]]:
    """The k most important features for each k (ties by name)."""
    ordered = [r["feature"] for r in importances.orderBy(F.desc("importance"), "feature").collect()]
    return {k: ordered[:k] for k in ks}


def grid_size(grid: Mapping[str, list]) -> int:
    return math.prod(len(v) for v in grid.values())


def sample_grid(grid: Mapping[str, list], n_iter: int, seed: int = 42) -> list[dict]:
    """``n_iter`` distinct grid points drawn uniformly with a seed (mixed-radix
    decoding of sampled indices; the grid is never materialised)."""
    names = list(grid)
    size = grid_size(grid)
    picks = random.Random(seed).sample(range(size), min(n_iter, size))
    out = []
    for idx in picks:
        point = {}
        for name in reversed(names):
            idx, digit = divmod(idx, len(grid[name]))
            point[name] = grid[name][digit]
        out.append({n: point[n] for n in names})
    return out


def random_search_gbt(df: DataFrame, features: list[str], date_col: str, target_col: str, first_train_end,
                      n_splits: int = 3, n_iter: int = 30, grid: Mapping[str, list] = GBT_GRID, seed: int = 42,
                      parallelism: int = 4):
    """Time-ordered CV (B2) over the rows up to ``first_train_end``; mean RMSE of each
    sampled grid point; returns (best params, score table)."""
    static = df.where(F.col(date_col) <= lit_like(first_train_end, df.schema[date_col].dataType))
    folds = cv_frames(static, date_col, n_splits)
    evaluator = RegressionEvaluator(labelCol=target_col, predictionCol="prediction", metricName="rmse")
    from concurrent.futures import ThreadPoolExecutor

    def score(item):
        i, params = item
        fp = gbt_fit_predict(features, target_col, date_col, params, seed=seed)
        scores = [evaluator.evaluate(fp(tr, te).withColumn(target_col, F.col(target_col).cast("double")))
                  for tr, te in folds]
        return (i, str(sorted(params.items())), float(sum(scores) / len(scores)), len(scores))

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:   # concurrent Spark jobs
        rows = list(pool.map(score, enumerate(sample_grid(grid, n_iter, seed))))
    table = df.sparkSession.createDataFrame(rows, "draw int, params string, mean_rmse double, n_splits int")
    best_i = min(rows, key=lambda r: (r[2], r[0]))[0]
    return sample_grid(grid, n_iter, seed)[best_i], table


def _subset_predictions(train: DataFrame, valid: DataFrame, sets: Mapping[int, list[str]], target_col: str,
                        date_col: str, params: Mapping, seed: int = 42) -> DataFrame:
    """One fold of the sweep: (k, date, y_true, y_pred).  Every set is the head of the longest one,
    so that one is filled, assembled and written once and each fit takes the head of its vector.
    Written, as each of the many short tasks of a fit carries the plan of its input."""
    from demandflow.session import materialize

    longest = max(sets.values(), key=len)
    tr, va = fill_from_train(train, [train, valid], longest)
    assembler = VectorAssembler(inputCols=longest, outputCol="__all", handleInvalid="keep")
    y = F.col(target_col).cast("double")
    data = materialize(assembler.transform(tr).select("__all", y.alias(target_col)))
    out = assembler.transform(va).select(F.col(date_col).alias("date"), y.alias("y_true"), "__all")
    for k, feats in sets.items():
        head = VectorSlicer(inputCol="__all", outputCol="__features", indices=list(range(len(feats))))
        model = _fit_gbt(head.transform(data).drop("__all"), target_col, params, seed).setPredictionCol(f"__pred{k}")
        out = model.transform(head.transform(out)).drop("__features")
    preds = [F.struct(F.lit(k).alias("k"), F.col(f"__pred{k}").alias("y_pred")) for k in sets]
    return out.select("date", "y_true", F.explode(F.array(*preds)).alias("__p")).select("__p.k", "date", "y_true", "__p.y_pred")


def feature_subset_sweep(df: DataFrame, importances: DataFrame, ks: Iterable[int], target_col: str, date_col: str,
                         first_train_end, step, test_start=None, test_end=None, params: Mapping | None = None,
                         parallelism: int = 4) -> DataFrame:
    """For each k, backtest the tree model on the k most important features and report
    one metric row per k (B9), labelled ``k``.  The folds, their fill values and their vectors
    serve all k; up to ``parallelism`` folds are fitted concurrently."""
    from concurrent.futures import ThreadPoolExecutor

    from demandflow.operators.backtest import fold_tasks
    from demandflow.operators.metrics import METRICS, calculate_metrics
    from demandflow.session import literal_rows

    sets = top_k_feature_sets(importances, ks)
    if not sets:
        return None
    tasks = fold_tasks(df, date_col, first_train_end, step, test_start, test_end)
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        parts = list(pool.map(lambda t: _subset_predictions(t[1], t[2], sets, target_col, date_col, params or {}), tasks))
    sizes = literal_rows(df.sparkSession, [(k, len(feats)) for k, feats in sets.items()], ["k", "n_features"])
    if not parts:   # no fold: one all-null row per k
        return sizes.select(*[F.lit(None).cast("double").alias(m) for m in METRICS], "k", "n_features")
    preds = parts[0]
    for p in parts[1:]:
        preds = preds.unionByName(p)
    # a k without any prediction keeps its row
    rows = sizes.join(calculate_metrics(preds, order_col="date", group_cols=["k"]), "k", "left")
    return rows.select(*METRICS, "k", "n_features")
