"""Expanding-window folds, time-ordered CV and the backtest loop."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _micros(step: dt.timedelta | int) -> int:
    if isinstance(step, dt.timedelta):
        return (step.days * 86_400 + step.seconds) * 1_000_000 + step.microseconds
    return int(step) * 86_400_000_000


def _ts(value) -> Column:
    """A TIMESTAMP_NTZ literal that does not pass through the session time zone (a Python
    datetime literal would be read as a zoned instant first)."""
    if isinstance(value, dt.datetime):
        return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
    if isinstance(value, dt.date):
        return F.lit(value.isoformat()).cast("timestamp_ntz")
    return F.lit(value).cast("timestamp_ntz")


def lit_like(value, dtype) -> Column:
    """Literal of ``value`` in the type of a date/time column, without time-zone shifts."""
    if isinstance(dtype, T.TimestampNTZType):
        return _ts(value)
    if isinstance(dtype, T.DateType) and isinstance(value, dt.datetime):
        return F.lit(value.date())
    return F.lit(value).cast(dtype)


def valid_fold_id(date_col: str, first_train_end, step: dt.timedelta | int) -> Column:
    """Fold whose validation window (e_k, e_k + step] holds the row, e_k = first + k*step;
    -1 for rows on or before the first cut-off."""
    gap = F.timestamp_diff("MICROSECOND", _ts(first_train_end), F.col(date_col).cast("timestamp_ntz"))
    fold = F.ceil(gap / F.lit(float(_micros(step)))) - 1
    return F.when(gap <= 0, F.lit(-1)).otherwise(fold).cast("int")


def split_rolling(df: DataFrame, date_col: str, first_train_end, step: dt.timedelta | int,
                  series_keys: Iterable[str] = ()) -> DataFrame:
    """B1: the fold table (fold_id, train_end, valid_end, n_train, n_valid).

    Fold k trains on dates <= e_k and validates on (e_k, e_k + step]; folds stop at the
    first empty validation window, even if later rows exist.  Counts come from one
    group-by on the fold id plus a running sum; no row is copied per fold.
    """
    keys = list(series_keys)
    counts = (df.where(F.col(date_col).isNotNull())
              .select(*keys, valid_fold_id(date_col, first_train_end, step).alias("fold_id"))
              .groupBy(*keys, "fold_id").agg(F.count(F.lit(1)).alias("n")))
    w = (Window.partitionBy(*keys) if keys else Window).orderBy("fold_id")
    before = F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = counts.select(*keys, "fold_id", F.col("n").alias("n_valid"), before.alias("n_train"),
                           (F.row_number().over(w) - 2).alias("__rank"))
    has_base = F.max(F.when(F.col("fold_id") == -1, 1).otherwise(0)).over(
        Window.partitionBy(*keys) if keys else Window.partitionBy())
    ranked = ranked.withColumn("__rank", F.col("__rank") + 1 - has_base)
    step_us = _micros(step)
    train_end = F.timestamp_add("MICROSECOND", F.col("fold_id").cast("bigint") * F.lit(step_us), _ts(first_train_end))
    return (ranked.where((F.col("fold_id") >= 0) & (F.col("fold_id") == F.col("__rank")))
            .select(*keys, "fold_id", train_end.alias("train_end"),
                    F.timestamp_add("MICROSECOND", F.lit(step_us), train_end).alias("valid_end"),
                    F.col("n_train").cast("bigint").alias("n_train"), F.col("n_valid").cast("bigint").alias("n_valid")))


def fold_frames(df: DataFrame, folds: DataFrame, date_col: str) -> list[tuple[int, DataFrame, DataFrame]]:
    """The (fold_id, train, valid) pairs as lazy filters of ``df``; the fold table is
    tiny (one row per fold), the rows stay distributed."""
    out = []
    ts = F.col(date_col).cast("timestamp_ntz")
    for row in folds.orderBy("fold_id").select("fold_id", "train_end", "valid_end").collect():
        train = df.where(ts <= _ts(row["train_end"]))
        valid = df.where((ts > _ts(row["train_end"])) & (ts <= _ts(row["valid_end"])))
        out.append((row["fold_id"], train, valid))
    return out


def time_series_cv(df: DataFrame, date_col: str, n_splits: int = 3, series_keys: Iterable[str] = ()) -> DataFrame:
    """B2: time-ordered CV with ``n_splits`` test blocks of n // (n_splits + 1) rows at the
    end; split i trains on every row before its block.  Returns one row per split:
    split_id, n_train, n_test, train_last, test_first, test_last."""
    keys = list(series_keys)
    part = Window.partitionBy(*keys) if keys else Window.partitionBy()
    w = (Window.partitionBy(*keys) if keys else Window).orderBy(date_col)
    idx = df.where(F.col(date_col).isNotNull()).select(
        *keys, date_col, (F.row_number().over(w) - 1).alias("r"), F.count(F.lit(1)).over(part).alias("n"))
    size = F.floor(F.col("n") / (n_splits + 1))
    first_test = F.col("n") - F.lit(n_splits) * size
    split = F.when((size > 0) & (F.col("r") >= first_test), F.floor((F.col("r") - first_test) / size)) \
        .otherwise(F.lit(-1)).cast("int")
    groups = idx.select(*keys, date_col, split.alias("split_id")).groupBy(*keys, "split_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(date_col).alias("first"), F.max(date_col).alias("last"))
    gw = (Window.partitionBy(*keys) if keys else Window).orderBy("split_id")
    out = groups.select(
        *keys, "split_id",
        F.coalesce(F.sum("n_rows").over(gw.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        .cast("bigint").alias("n_train"),
        F.col("n_rows").cast("bigint").alias("n_test"),
        F.lag("last").over(gw).alias("train_last"), F.col("first").alias("test_first"), F.col("last").alias("test_last"))
    return out.where(F.col("split_id") >= 0)


def cv_frames(df: DataFrame, date_col: str, n_splits: int = 3) -> list[tuple[DataFrame, DataFrame]]:
    """B2 as (train, test) pairs cut by date (rows of one series have distinct dates)."""
    pairs = []
    dtype = df.schema[date_col].dataType
    for row in time_series_cv(df, date_col, n_splits).orderBy("split_id").collect():
        d = F.col(date_col)
        pairs.append((df.where(d <= lit_like(row["train_last"], dtype)),
                      df.where((d >= lit_like(row["test_first"], dtype)) & (d <= lit_like(row["test_last"], dtype)))))
    return pairs


FitPredict = Callable[[DataFrame, DataFrame], DataFrame]


def fold_tasks(df: DataFrame, date_col: str, first_train_end, step: dt.timedelta | int, test_start=None,
               test_end=None) -> list[tuple[int, DataFrame, DataFrame]]:
    """The (fold_id, train, valid) frames with validation restricted to
    [test_start, test_end]."""
    folds = split_rolling(df, date_col, first_train_end, step)
    if test_start is not None:   # folds whose window ends before the test period never contribute
        folds = folds.where(F.col("valid_end") >= _ts(test_start))
    if test_end is not None:
        folds = folds.where(F.col("train_end") < _ts(test_end))
    dtype = df.schema[date_col].dataType
    tasks = []
    for fold_id, train, valid in fold_frames(df, folds, date_col):
        if test_start is not None:
            valid = valid.where(F.col(date_col) >= lit_like(test_start, dtype))
        if test_end is not None:
            valid = valid.where(F.col(date_col) <= lit_like(test_end, dtype))
        tasks.append((fold_id, train, valid))
    return tasks


def backtest(df: DataFrame, fit_predict: FitPredict, date_col: str, target_col: str, first_train_end,
             step: dt.timedelta | int, test_start=None, test_end=None, parallelism: int = 4) -> DataFrame:
    """For each fold, restrict validation to [test_start, test_end] (P14), fit on the
    training rows, predict the validation rows; returns the union of
    (date, y_true, y_pred, fold_id).

    The fold table is tiny and drives a loop on the driver; every fit is a Spark job, and
    up to ``parallelism`` folds are fitted concurrently from driver threads (the scheme of
    ``CrossValidator(parallelism=...)``), which hides per-job latency."""
    from concurrent.futures import ThreadPoolExecutor

    tasks = fold_tasks(df, date_col, first_train_end, step, test_start, test_end)

    def run(task):
        fold_id, train, valid = task
        return fit_predict(train, valid).select(
            F.col(date_col).alias("date"), F.col(target_col).cast("double").alias("y_true"),
            F.col("prediction").cast("double").alias("y_pred"), F.lit(fold_id).alias("fold_id"))

    if not tasks:
        none = F.lit(None)
        return df.where(F.lit(False)).select(F.col(date_col).alias("date"), F.col(target_col).cast("double").alias("y_true"),
                                             none.cast("double").alias("y_pred"), none.cast("int").alias("fold_id"))
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        parts = list(pool.map(run, tasks))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
