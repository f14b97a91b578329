"""Micro fixtures for lags/rollings, calendar flags, imputation, folds, CV and metrics."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from demandflow.operators import backtest, features, impute, metrics


def _series(spark, ys, start=dt.date(2018, 1, 1), step=7):
    rows = [(start + dt.timedelta(days=step * i), float(y)) for i, y in enumerate(ys)]
    return spark.createDataFrame(rows, "order_week date, y double")


def test_w7_causal_rolling(spark):
    out = features.add_rollings(_series(spark, [1, 3, 5, 9]), "order_week", ["y"], [2]).orderBy("order_week").collect()
    assert [r.y_roll2_mean for r in out] == [None, None, 2.0, 4.0]
    assert [r.y_roll2_std for r in out][:2] == [None, None]
    assert [r.y_roll2_std for r in out][2:] == [pytest.approx(math.sqrt(2))] * 2


def test_causality_property(spark):
    """Changing values at t >= T leaves lag and rolling features at t <= T unchanged."""
    a = _series(spark, [1, 2, 3, 4, 5, 6])
    b = _series(spark, [1, 2, 3, 40, 50, 60])
    fa = features.add_lags_and_rollings(a, "order_week", ["y"], [1, 2], ["y"], [2, 3]).orderBy("order_week").collect()
    fb = features.add_lags_and_rollings(b, "order_week", ["y"], [1, 2], ["y"], [2, 3]).orderBy("order_week").collect()
    for ra, rb in zip(fa[:4], fb[:4]):
        assert {k: v for k, v in ra.asDict().items() if k != "y"} == {k: v for k, v in rb.asDict().items() if k != "y"}


def test_f7_event_weeks(spark):
    df = spark.createDataFrame([(dt.date(2018, 11, 26),)], "order_week date")
    r = features.add_calendar_features(df, "order_week", "W").first()
    assert (r.is_black_friday_week, r.is_cyber_monday_week, r.is_christmas_week) == (1, 0, 0)
    d = spark.createDataFrame([(dt.date(2018, 12, 25),), (dt.date(2018, 3, 30),)], "order_date date")
    rows = features.add_calendar_features(d, "order_date", "D").orderBy("order_date").collect()
    assert [r.n_br_holidays_week for r in rows] == [1, 1]   # Good Friday 2018, Christmas


def test_holiday_table_path_equals_rule(spark):
    df = spark.createDataFrame([(dt.date(2018, 1, 1) + dt.timedelta(weeks=i),) for i in range(60)], "order_week date")
    hol = features.br_holiday_table(spark, 2017, 2020)
    a = features.add_calendar_features(df, "order_week", "W").select("order_week", "n_br_holidays_week")
    b = features.add_calendar_features(df, "order_week", "W", hol).select("order_week", "n_br_holidays_week")
    assert sorted(a.collect()) == sorted(b.collect())


def test_i2_i4_imputation(spark):
    df = spark.createDataFrame([(None, None, 1.0)], "sales_qty_lag1 double, approval_time_hours_weighted_lag1 double, "
                                                    "approval_time_hours_mean_n double")
    r = impute.impute_nulls(df).first()
    assert r.sales_qty_lag1 == 0.0 and r.approval_time_hours_weighted_lag1 is None and r.have_nulls == 1


def test_b1_folds_stop_at_first_gap(spark):
    base = dt.date(2018, 1, 1)
    df = spark.createDataFrame([(base + dt.timedelta(days=d),) for d in (0, 7, 14, 28)], "d date")
    folds = backtest.split_rolling(df, "d", dt.datetime(2018, 1, 1), dt.timedelta(days=7)).orderBy("fold_id").collect()
    assert [(f.fold_id, f.n_train, f.n_valid) for f in folds] == [(0, 1, 1), (1, 2, 1)]


def test_b2_time_series_cv(spark):
    df = spark.createDataFrame([(dt.date(2018, 1, 1) + dt.timedelta(days=i),) for i in range(10)], "d date")
    cv = backtest.time_series_cv(df, "d", 3).orderBy("split_id").collect()
    assert [(c.n_train, c.n_test) for c in cv] == [(4, 2), (6, 2), (8, 2)]
    assert cv[0].test_first == dt.date(2018, 1, 5)


def test_b9_metrics(spark):
    rows = [(i, float(y), float(p)) for i, (y, p) in enumerate(zip([2, 4, 0, 6], [1, 5, 1, 6]))]
    df = spark.createDataFrame(rows, "date int, y_true double, y_pred double")
    m = metrics.calculate_metrics(df).first()
    assert m.rmse == pytest.approx(math.sqrt(0.75))
    assert m.mape == pytest.approx(25.0)
    assert m.wape == pytest.approx(25.0)
    assert m.mase == pytest.approx(0.1875)
    assert m.rmsse == pytest.approx(math.sqrt(0.75) / math.sqrt(56 / 3))
    one = metrics.calculate_metrics(df.limit(1)).first()
    assert one.mase is None and one.rmsse is None
    empty = metrics.calculate_metrics(df.where("false")).first()
    assert all(empty[c] is None for c in metrics.METRICS)
