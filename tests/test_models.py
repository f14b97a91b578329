"""Forecasters on a synthetic seasonal series: every model predicts every validation row,
and the seasonal models beat the naive forecast."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandflow.operators import backtest, metrics, models, panel


@pytest.fixture(scope="module")
def seasonal(spark):
    rng = np.random.default_rng(0)
    start = dt.date(2020, 1, 1)
    rows = []
    for t in range(200):
        y = 50 + 0.1 * t + 8 * math.sin(2 * math.pi * t / 7) + rng.normal(0, 0.5)
        rows.append((start + dt.timedelta(days=t), float(y), float(t % 7)))
    return spark.createDataFrame(rows, "d date, y double, dow double").cache()


def _run(df, fp, parallelism=4):
    return backtest.backtest(df, fp, "d", "y", dt.datetime(2020, 6, 1), 7, parallelism=parallelism)


def _rmse(pred):
    return metrics.calculate_metrics(pred, order_col="date").first().rmse


def test_sample_grid_deterministic_and_distinct():
    a = models.sample_grid(models.GBT_GRID, 30, seed=42)
    b = models.sample_grid(models.GBT_GRID, 30, seed=42)
    assert a == b and len({str(sorted(p.items())) for p in a}) == 30
    assert models.grid_size(models.GBT_GRID) == 324
    assert all(set(p) == set(models.GBT_GRID) for p in a)


def test_top_k_feature_sets(spark):
    imp = spark.createDataFrame([("a", 0.1), ("b", 0.5), ("c", 0.5), ("d", 0.0)], "feature string, importance double")
    sets = models.top_k_feature_sets(imp, [1, 2, 10])
    assert sets[1] == ["b"] and sets[2] == ["b", "c"] and len(sets[10]) == 4


def test_seasonal_models_beat_naive(seasonal):
    naive = _run(seasonal, models.seasonal_naive_fit_predict("y", "d", 1))
    n_valid = seasonal.where(F.col("d") > F.lit(dt.date(2020, 6, 1))).count()
    assert naive.count() == n_valid
    base = _rmse(naive)
    for model in (panel.seasonal_arma(7), panel.lookback(14), panel.additive(changepoint_days=60, yearly_order=2)):
        pred = panel.panel_backtest(seasonal, model, "d", "y", dt.datetime(2020, 6, 1), 7)
        assert pred.count() == n_valid and pred.where(F.col("y_pred").isNull()).count() == 0
        assert _rmse(pred) < base


def test_gbt_backtest_and_importance(spark, seasonal):
    from demandflow.operators.features import add_lags
    df = add_lags(seasonal, "d", ["y"], [1, 7]).cache()
    feats = ["y_lag1", "y_lag7", "dow"]
    params = {"maxIter": 5, "maxDepth": 3}
    pred = backtest.backtest(df, models.gbt_fit_predict(feats, "y", "d", params), "d", "y",
                             dt.datetime(2020, 6, 20), 7, parallelism=8)
    assert pred.count() == df.where(F.col("d") > F.lit(dt.date(2020, 6, 20))).count()
    train = df.where(F.col("d") <= F.lit(dt.date(2020, 6, 20)))
    (tr,) = models.fill_from_train(train, [train], feats)
    model, _ = models.gbt_model(tr, feats, "y", "d", params, validation_fraction=0.2)
    imp = {r.feature: r.importance for r in models.feature_importances(spark, model, feats).collect()}
    assert set(imp) == set(feats) and abs(sum(imp.values()) - 1.0) < 1e-9


def test_standardize_fit_on_train(spark):
    from demandflow.operators.analysis import standardize
    df = spark.createDataFrame([(1.0, True), (3.0, True), (100.0, False), (5.0, False)], "x double, tr boolean")
    out, params = standardize(df, ["x"], fit_df=df.where("tr"), suffix="_z")
    assert params["x"] == (2.0, 1.0)
    assert [r.x_z for r in out.orderBy("x").collect()] == [-1.0, 1.0, 3.0, 98.0]


def test_b6_feature_subset_sweep(spark, seasonal):
    from demandflow.operators.features import add_lags
    df = add_lags(seasonal, "d", ["y"], [1, 7]).cache()
    imp = spark.createDataFrame([("y_lag7", 0.6), ("y_lag1", 0.3), ("dow", 0.1)], "feature string, importance double")
    out = models.feature_subset_sweep(df, imp, [1, 3], "y", "d", dt.datetime(2020, 7, 1), 7,
                                      params={"maxIter": 3, "maxDepth": 2}, parallelism=8)
    rows = {r.k: r for r in out.collect()}
    assert set(rows) == {1, 3} and rows[1].n_features == 1 and rows[3].n_features == 3
    assert all(rows[k].rmse is not None for k in rows)


def test_b6_sweep_prepares_each_fold_once(spark, seasonal, monkeypatch):
    """F8: the folds are filled once for all k, with the results of one backtest per k."""
    from demandflow.operators.features import add_lags
    df = add_lags(seasonal, "d", ["y"], [1, 7]).withColumn("none", F.lit(None).cast("int")).cache()
    order = ["y_lag7", "none", "y_lag1", "dow"]
    imp = spark.createDataFrame(list(zip(order, [0.5, 0.3, 0.2, 0.0])), "feature string, importance double")
    window, params = (dt.datetime(2020, 7, 5), 7, dt.date(2020, 7, 8), dt.date(2020, 7, 17)), {"maxIter": 2, "maxDepth": 2}
    filled, keep = [], models.fill_from_train
    monkeypatch.setattr(models, "fill_from_train", lambda *a: (filled.append(a), keep(*a))[1])
    out = models.feature_subset_sweep(df, imp, [1, 2, 9], "y", "d", *window, params=params)
    rows = {r.k: r for r in out.collect()}
    assert len(filled) == backtest.split_rolling(df, "d", *window[:2]).count() == 2
    assert {k: r.n_features for k, r in rows.items()} == {1: 1, 2: 2, 9: 4}
    for k, r in rows.items():
        one = backtest.backtest(df, models.gbt_fit_predict(order[:k], "y", "d", params), "d", "y", *window)
        want = metrics.calculate_metrics(one, order_col="date").first()
        assert [r[m] for m in metrics.METRICS] == pytest.approx(list(want), rel=1e-12)
    none = models.feature_subset_sweep(df, imp, [1, 2], "y", "d", *window[:2], dt.date(2021, 1, 1))
    assert none.columns == out.columns
    assert sorted(map(tuple, none.collect()), key=str) == [(*[None] * 5, 1, 1), (*[None] * 5, 2, 2)]


def test_fill_from_train_names_and_extremes(spark):
    df = spark.createDataFrame([(1.0, None, None, 1e-5), (None, None, float("inf"), None)], "`a b` double, n double, i double, t double")
    (got,) = models.fill_from_train(df, [df], df.columns)
    assert got.columns == df.columns
    assert sorted(map(tuple, got.collect())) == [(1.0, 0.0, math.inf, 1e-5), (1.0, 0.0, math.inf, 1e-5)]


def test_forecasts_read_no_later_target(spark, seasonal):
    cut = dt.datetime(2020, 6, 1)
    for model in (panel.seasonal_arma(7), panel.additive(changepoint_days=60)):
        def got(df):
            return [r["y_pred"] for r in panel.panel_backtest(df, model, "d", "y", cut, 200).orderBy("date").collect()]
        plain = got(seasonal)
        assert len(plain) == 47 and None not in plain
        assert plain == got(seasonal.withColumn("y", F.when(F.col("d") > F.lit(cut.date()), F.col("y") * 10).otherwise(F.col("y"))))
    short = seasonal.where(F.col("d") > F.lit(dt.date(2020, 5, 20)))
    assert all(r["y_pred"] is None for r in panel.panel_backtest(short, panel.seasonal_arma(7), "d", "y", cut, 7).where("fold_id = 0").collect())


def arma_by_hand(y, s, steps, lags):
    """Hannan-Rissanen and the forecast, one value at a time."""
    z = [y[t] - y[t - 1] - y[t - s] + y[t - s - 1] for t in range(s + 1, len(y))]
    top = max(lags)
    a = np.array([[z[t - k] for k in lags] for t in range(top, len(z))])
    coef = np.linalg.solve(a.T @ a, a.T @ np.array(z[top:]))
    e = [0.0] * top + [z[t] - sum(c * z[t - k] for c, k in zip(coef, lags)) for t in range(top, len(z))]
    first = top + s + 1
    b = np.array([[z[t - 1], e[t - 1], e[t - s]] for t in range(first, len(z))])
    phi, theta, big = np.linalg.solve(b.T @ b, b.T @ np.array(z[first:]))
    shocks = {}
    def ahead(t):
        at = lambda d, k: d.get(k, 0.0)
        return phi * at(values, t - 1) + theta * at(shocks, t - 1) + big * at(shocks, t - s) + theta * big * at(shocks, t - s - 1)
    values = {}
    for t, v in enumerate(z):
        shocks[t] = v - ahead(t)
        values[t] = v
    path = list(y)
    for t in range(len(z), len(z) + steps):
        values[t], shocks[t] = ahead(t), 0.0
        path.append(path[-1] + path[-s] - path[-s - 1] + values[t])
    return path[len(y):]


def test_seasonal_arma_and_additive_against_plain_code():
    rng = np.random.default_rng(3)
    t = np.arange(150)
    y = 30 + 0.2 * t + 5 * np.sin(2 * np.pi * t / 7) + rng.normal(0, 1, 150).cumsum() * 0.3
    got = panel.seasonal_arma(7)(t.astype(float), y, np.zeros((150, 0)), 140, slice(140, 150))
    assert np.allclose(got, arma_by_hand(y[:140], 7, 10, [1, 2, 3, 4, 7, 8]))
    # ridge: the gradient of its objective is 0, with and without regressors
    x, target = rng.normal(size=(60, 4)), rng.normal(size=60)
    x[:, 2] = 5.0
    intercept, b = panel.ridge(x, target, 0.1)
    z = (x - x.mean(0)) / np.where(x.std(0) > 0, x.std(0), 1)
    w = b * x.std(0)
    residual = target - intercept - x @ b
    assert abs(residual.mean()) < 1e-12 and b[2] == 0
    assert np.allclose(z[:, [0, 1, 3]].T @ residual / 60, 0.1 * w[[0, 1, 3]])


def test_panel_over_series_with_nulls_and_regressors(spark):
    rng = np.random.default_rng(1)
    rows = []
    for s in (None, "a", "b"):
        for k in range(80):
            x = float(rng.normal())
            rows.append((s, dt.date(2024, 1, 1) + dt.timedelta(days=k), None if k == 5 else 3.0 + 2.0 * x, x, "keep"))
    rows += [("c", None, 1.0, 1.0, "keep"), ("d", dt.date(2024, 1, 1), 1.0, 1.0, "keep")]
    df = spark.createDataFrame(rows, "s string, d date, y double, x double, y_pred string")
    model = panel.additive(changepoint_days=1000, yearly_order=0, weekly_order=0, penalty=0.0)
    out = panel.panel_backtest(df, model, "d", "y", dt.datetime(2024, 2, 1), 7, series_keys=["s"], extra_features=["x"])
    got = out.collect()
    assert len(got) == 3 * 48 and {r["s"] for r in got} == {None, "a", "b"}
    assert all(abs(r["y_pred"] - r["y_true"]) < 1e-9 for r in got)
    one = panel.panel_backtest(df.where("s = 'a'"), model, "d", "y", dt.datetime(2024, 2, 1), 7, extra_features=["x"]).collect()
    assert sorted(r["y_pred"] for r in one) == sorted(r["y_pred"] for r in got if r["s"] == "a")
    assert panel.panel_backtest(df.limit(0), model, "d", "y", dt.datetime(2024, 2, 1), 7, series_keys=["s"], extra_features=["x"]).count() == 0


def test_fold_rows_are_the_folds(spark):
    days = [0, 1, 2, 5, 6, 7, 9, 10, 11, 30]
    rows = [(s, dt.date(2024, 1, 1) + dt.timedelta(days=d), d) for s in (None, "a") for d in days] + [("z", None, 3), ("y", dt.date(2023, 1, 1), 1)]
    df = spark.createDataFrame(rows, "s string, d date, n int")
    first = dt.date(2024, 1, 3)
    for keys, frame in ((["s"], df), ([], df.where("s = 'a'"))):
        got = sorted(((r["s"] or "", r["fold_id"], r["role"], r["n"]) for r in panel.fold_rows(frame, "d", first, 3, keys).collect()))
        want = []
        for s in (("", "a") if keys else ("a",)):
            # folds of three days after day 2: (2, 5], (5, 8], (8, 11], then none is left before day 30
            for k in range(3):
                end = 2 + 3 * k
                want += [(s, k, "train", d) for d in days if d <= end] + [(s, k, "valid", d) for d in days if end < d <= end + 3]
        assert got == sorted(want)
