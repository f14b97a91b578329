"""Linear forecasters for every series and every fold in one Spark job (B5 with B7, B8, B8b).

Rows are grouped by series, and a group - one row per period of one series, bounded by the
calendar - is fitted for all its folds where it lies, so the work spreads over series and no fit
is a job of its own.  Fold k of a series trains on its rows up to ``first_train_end + k * step``
and predicts those of the next step, as :func:`backtest.split_rolling` defines them.

A model is a function ``(days, y, extra, n_train, valid) -> predictions``: dates as days, targets
and regressors as floats (NaN: null) in date order, the number of training rows, and the slice of
rows to predict.  Only look-back one-step forecasts read targets behind the training rows, as
their past.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Callable, Iterable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandflow.operators.backtest import lit_like, valid_fold_id

Model = Callable[[np.ndarray, np.ndarray, np.ndarray, int, slice], np.ndarray]


def ridge(x: np.ndarray, y: np.ndarray, penalty: float) -> tuple[float, np.ndarray] | None:
    """Intercept and coefficients of least squares with a ridge ``penalty`` on the standardised
    columns (mean squared error + penalty * sum b^2); columns without spread get 0.  Rows with a
    NaN are left out; None without rows."""
    ok = np.isfinite(y) & np.isfinite(x).all(1)
    x, y = x[ok], y[ok]
    if not len(y):
        return None
    mean, sd = x.mean(0), x.std(0)
    used = sd > 1e-9 * np.maximum(1.0, np.abs(mean))
    b = np.zeros(x.shape[1])
    if used.any():
        z = (x[:, used] - mean[used]) / sd[used]
        c = z.T @ z / len(y)
        rhs = z.T @ (y - y.mean()) / len(y)
        solution = np.linalg.solve(c + penalty * np.eye(len(c)), rhs) if penalty else np.linalg.lstsq(c, rhs, rcond=1e-12)[0]
        b[used] = solution / sd[used]
    return float(y.mean() - mean @ b), b


def _predicted(fit: tuple[float, np.ndarray] | None, x: np.ndarray) -> np.ndarray:
    return np.full(len(x), np.nan) if fit is None else fit[0] + x @ fit[1]


def additive(changepoint_days: int = 91, changepoint_range: float = 0.8, yearly_order: int = 10, weekly_order: int = 3,
             penalty: float = 0.01) -> Model:
    """B7 re-aimed: piecewise-linear trend with a knot every ``changepoint_days`` in the first
    ``changepoint_range`` of the training dates, yearly and weekly Fourier terms, and any extra
    regressors, by ridge regression.  Rows with a null regressor are not fitted and get null."""
    def model(days, y, extra, n_train, valid):
        if not n_train:
            return np.full(valid.stop - valid.start, np.nan)
        first, last = days[0], days[n_train - 1]
        knots = np.arange(first + changepoint_days, first + changepoint_range * (last - first) + 1e-9, changepoint_days)
        t = (days - first) / 365.25
        columns = [t, *[np.maximum(t - (k - first) / 365.25, 0.0) for k in knots]]
        for order, length in ((yearly_order, 365.25), (weekly_order, 7.0)):
            for k in range(1, order + 1):
                angle = 2 * math.pi * k / length * days
                columns += [np.sin(angle), np.cos(angle)]
        x = np.column_stack([*columns, *extra.T])
        return _predicted(ridge(x[:n_train], y[:n_train], penalty), x[valid])
    return model


def lookback(length: int = 14) -> Model:
    """B8b re-aimed: linear autoregression on the ``length`` previous values; one-step forecasts
    from the true past.  Standardising the values first, as with a network, changes nothing in
    a linear model with an intercept."""
    def model(days, y, extra, n_train, valid):
        x = np.column_stack([np.r_[np.full(k, np.nan), y[:len(y) - k]] for k in range(length, 0, -1)]) if len(y) > length \
            else np.full((len(y), length), np.nan)
        return _predicted(ridge(x[:n_train], y[:n_train], 0.0), x[valid])
    return model


def seasonal_arma(season: int = 7, short_lags: int = 4) -> Model:
    """B8 re-aimed: (1, 1, 1)(0, 1, 1, season) by two-stage least squares (Hannan-Rissanen).

    z = (1 - B)(1 - B^s) y.  A long autoregression (lags 1 to ``short_lags``, s and s + 1) estimates
    the shocks; z is then regressed, without a constant, on its previous value and on the shocks one
    step and one season back, which gives phi, theta and Theta.  With these the shocks of the
    training rows are computed again by recursion from 0, and the forecast is
    phi z[-1] + theta e[-1] + Theta e[-s] + theta Theta e[-s-1], fed back step by step, future shocks
    being 0.  It starts at the end of the training rows and reads no later target.  Too few
    training rows (two seasons and the lags), or a null among them, give null."""
    s = season
    lags = [*range(1, short_lags + 1), *[k for k in (s, s + 1) if k > short_lags]]

    def model(days, y, extra, n_train, valid):
        out = np.full(valid.stop - valid.start, np.nan)
        past = y[:n_train]
        first = lags[-1] + s + 1  # rows of z that have all their regressors in both stages
        if n_train - s - 1 < first + len(lags) + 3 or not np.isfinite(past).all():
            return out
        z = past[s + 1:] - past[s:-1] - past[1:n_train - s] + past[:n_train - s - 1]
        n = len(z)
        long = np.column_stack([z[lags[-1] - k:n - k] for k in lags])
        e = np.zeros(n)
        e[lags[-1]:] = z[lags[-1]:] - long @ np.linalg.lstsq(long, z[lags[-1]:], rcond=None)[0]
        x = np.column_stack([z[first - 1:n - 1], e[first - 1:n - 1], e[first - s:n - s]])
        phi, theta, big = np.linalg.lstsq(x, z[first:], rcond=None)[0]

        def ahead(zs, es):
            def back(values, k):
                return values[-k] if len(values) >= k else 0.0
            return phi * back(zs, 1) + theta * back(es, 1) + big * back(es, s) + theta * big * back(es, s + 1)

        zs, es = [], []
        for value in z.tolist():
            es.append(value - ahead(zs, es))
            zs.append(value)
        path = past.tolist()
        for i in range(len(out)):
            zs.append(ahead(zs, es))
            es.append(0.0)
            path.append(path[-1] + path[-s] - path[-s - 1] + zs[-1])
            out[i] = path[-1]
        return out
    return model


def fold_rows(df: DataFrame, date_col: str, first_train_end, step: dt.timedelta | int, series_keys: Iterable[str] = ()) -> DataFrame:
    """Every row once per fold that it has a part in: ``fold_id`` and ``role`` ('train' or
    'valid') beside its columns.  A row's folds are a run of numbers, so they are a sequence of the
    row and of its series' number of folds; nothing is compared with a fold table."""
    from demandflow.operators.backtest import split_rolling
    keys = list(series_keys)
    folds = split_rolling(df, date_col, first_train_end, step, keys)
    count = folds.groupBy(*keys).agg((F.max("fold_id") + 1).alias("__folds"))
    rows = df.where(F.col(date_col).isNotNull()).withColumn("__own", valid_fold_id(date_col, first_train_end, step))
    if keys:
        cond = F.lit(True)
        for k in keys:
            cond = cond & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
        rows = rows.alias("a").join(count.alias("b"), cond).select("a.*", "b.__folds")
    else:  # one number for all rows
        rows = rows.withColumn("__folds", F.lit(count.first()["__folds"]).cast("int"))
    own = F.greatest(F.col("__own"), F.lit(0))
    spread = rows.where(own < F.col("__folds")).withColumn("fold_id", F.explode(F.sequence(own, F.col("__folds") - 1)))
    role = F.when(F.col("fold_id") == F.col("__own"), "valid").otherwise("train")
    return spread.withColumn("role", role).drop("__own", "__folds")


def panel_backtest(df: DataFrame, model: Model, date_col: str, target_col: str, first_train_end, step: dt.timedelta | int,
                   test_start=None, test_end=None, series_keys: Iterable[str] = (), extra_features: Iterable[str] = ()) -> DataFrame:
    """B5 over all series and folds: ``(series keys, date, y_true, y_pred, fold_id)`` for the
    validation rows in [test_start, test_end] (P14).  Rows without a date are left out; of rows
    of one series and date all are kept, ordered by the target."""
    keys, extra = list(series_keys), list(extra_features)
    dtype = df.schema[date_col].dataType
    wanted = F.lit(True)
    if test_start is not None:
        wanted = wanted & (F.col(date_col) >= lit_like(test_start, dtype))
    if test_end is not None:
        wanted = wanted & (F.col(date_col) <= lit_like(test_end, dtype))
    days = F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(date_col).cast("timestamp_ntz")) / F.lit(86400.0)
    rows = df.where(F.col(date_col).isNotNull()).select(
        *keys, F.col(date_col).alias("date"), days.alias("__days"), F.col(target_col).cast("double").alias("y_true"),
        *[F.col(c).cast("double").alias(f"__x{i}") for i, c in enumerate(extra)],
        valid_fold_id(date_col, first_train_end, step).alias("fold_id"), wanted.alias("__wanted"))
    schema = T.StructType([*[rows.schema[k] for k in keys], T.StructField("date", dtype), T.StructField("y_true", T.DoubleType()),
                           T.StructField("y_pred", T.DoubleType()), T.StructField("fold_id", T.IntegerType())])

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["__days", "y_true"], kind="mergesort", ignore_index=True)
        fold = group["fold_id"].to_numpy()
        day, y = group["__days"].to_numpy(float), group["y_true"].to_numpy(float)
        x = group[[f"__x{i}" for i in range(len(extra))]].to_numpy(float)
        wanted_rows = group["__wanted"].to_numpy(bool)
        predicted, kept, k = np.full(len(group), np.nan), np.zeros(len(group), bool), 0
        while True:
            valid = slice(*np.searchsorted(fold, [k, k + 1]))
            if valid.start == valid.stop:
                break
            if wanted_rows[valid].any():
                predicted[valid] = model(day, y, x, valid.start, valid)
                kept[valid] = wanted_rows[valid]
            k += 1
        out = group.loc[kept, [*keys, "date", "y_true", "fold_id"]]
        out.insert(len(keys) + 2, "y_pred", pd.Series(predicted, dtype="Float64").mask(np.isnan(predicted))[kept])
        return out

    return rows.groupBy(*keys).applyInPandas(fit, schema)
