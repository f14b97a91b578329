"""Feature analysis and exploration operators against hand-computed or brute-force values."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandflow.operators import analysis, profile


def test_e1_binary_and_fraction(spark):
    rows = [(1.0, 0, None, 1.5), (2.0, 1, None, 2.5), (3.0, None, None, 3.5)]
    df = spark.createDataFrame(rows, "y double, flag int, empty double, x double")
    assert analysis.select_continuous_features(df, "y") == ["x"]
    prof = {r.feature: r for r in analysis.continuous_feature_profile(df, "y").collect()}
    assert prof["flag"].is_binary and not prof["empty"].is_binary and prof["empty"].nonnull_frac == 0.0


def _t_pvalue(r, n):
    """Two-sided p of Pearson's r by numerical integration of the Student density."""
    nu = n - 2
    t = abs(r) * math.sqrt(nu / (1 - r * r))
    c = math.exp(math.lgamma((nu + 1) / 2) - math.lgamma(nu / 2)) / math.sqrt(nu * math.pi)
    u = np.linspace(0, t, 200001)
    f = c * (1 + u * u / nu) ** (-(nu + 1) / 2)
    inside = 2 * np.trapezoid(f, u)
    return 1 - inside


@pytest.mark.parametrize("n", [3, 4, 5, 10, 11, 57])
def test_e2_pvalue_matches_t_distribution(spark, n):
    rng = np.random.default_rng(n)
    x = rng.normal(size=n)
    y = 0.5 * x + rng.normal(size=n)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    row = analysis.compute_pearson_corr(df, "y", ["x"]).first()
    assert row.pearson_r == pytest.approx(np.corrcoef(x, y)[0, 1], abs=1e-12)
    assert row.pearson_pvalue == pytest.approx(_t_pvalue(row.pearson_r, n), abs=1e-6)


def test_e2_constant_and_short(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0), (4.0, None)], "y double, x double")
    row = analysis.compute_pearson_corr(df, "y", ["x"]).first()
    assert row.pearson_r is None and row.pearson_pvalue is None and row.n_used == 3
    short = spark.createDataFrame([(1.0, 1.0), (2.0, 3.0)], "y double, x double")
    assert analysis.compute_pearson_corr(short, "y", ["x"]).first().pearson_r is None


def _ksg_brute(x, y, k=3):
    """Independent O(N^2) KSG on already prepared coordinates."""
    n = len(x)
    d = np.maximum(np.abs(x[:, None] - x[None, :]), np.abs(y[:, None] - y[None, :]))
    np.fill_diagonal(d, np.inf)
    eps = np.sort(d, axis=1)[:, k - 1]
    nx = np.array([np.sum(np.abs(x - x[i]) < eps[i]) - 1 for i in range(n)])
    ny = np.array([np.sum(np.abs(y - y[i]) < eps[i]) - 1 for i in range(n)])
    psi = lambda m: -0.5772156649015329 + sum(1.0 / j for j in range(1, int(m)))
    return max(0.0, psi(n) + psi(k) - np.mean([psi(v + 1) for v in nx]) - np.mean([psi(v + 1) for v in ny]))


def test_e3_ksg_matches_brute_force():
    rng = np.random.default_rng(7)
    x = rng.normal(size=300)
    y = np.sin(x) + 0.3 * rng.normal(size=300)
    zx, zy = (x - x.mean()) / x.std(), (y - y.mean()) / y.std()
    fast = analysis.ksg_mutual_information(x, y, 3, standardize=True, seed=None, chunk=37)
    assert fast == pytest.approx(_ksg_brute(zx, zy), abs=1e-12)
    assert fast > 0.3
    noise = analysis.ksg_mutual_information(rng.normal(size=400), rng.normal(size=400), 3)
    assert noise < 0.05


def test_e3_spark_groups(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=120)
    rows = [(i, float(a), float(2 * a + rng.normal() * 0.1), 1.0) for i, a in enumerate(x)]
    df = spark.createDataFrame(rows, "t int, x double, y double, short double")
    df = df.withColumn("short", F.when(F.col("t") < 4, F.col("short")))
    out = {r.feature: r for r in analysis.compute_mutual_information(df, "y", ["x", "short"], "t").collect()}
    assert out["x"].mi > 1.0 and out["x"].n_used == 120
    assert out["short"].mi is None and out["short"].n_used == 4


def test_e5_combined_rank(spark):
    p = spark.createDataFrame([("a", 0.8), ("b", -0.4)], "feature string, pearson_r double")
    m = spark.createDataFrame([("a", 0.5), ("b", None)], "feature string, mi double")
    out = {r.feature: r for r in analysis.combined_rank(p, m).collect()}
    assert (out["a"].r_norm_abs, out["a"].mi_norm, out["a"].score) == (1.0, 1.0, 1.0)
    assert (out["b"].r_norm_abs, out["b"].mi_norm, out["b"].score) == (0.5, None, 0.5)
    lab = {r.feature: r for r in analysis.add_strength_labels(analysis.combined_rank(p, m)).collect()}
    assert lab["a"].pearson_label == "Forte" and lab["b"].pearson_label == "Moderado" and lab["b"].mi_label is None


def test_a23_skew_kurtosis(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 2, 3, 10)], "v double")
    r = profile.summarize_features(df, exclude=()).first()
    assert r.skew == pytest.approx(2.028699, abs=1e-6)
    assert r.kurtosis == pytest.approx(4.272147, abs=1e-6)
    assert r.p25 == 2.0 and r.n_unique == 4 and r.pct_notnull == 100.0
    const = spark.createDataFrame([(3.0,)] * 5, "v double")
    c = profile.summarize_features(const, exclude=()).first()
    assert c.skew == 0.0 and c.kurtosis == 0.0


def test_a16_capped_frequency(spark):
    rows = [("p1", "o")] + [("p2", "o")] + [("p3", "o")] * 3 + [("p4", "o")] * 12
    items = spark.createDataFrame(rows, "product_id string, order_id string")
    out = {r.n_vendas: r for r in profile.capped_frequency(items, 10).collect()}
    assert {k: v.frequencia for k, v in out.items()} == {10: 25.0, 3: 25.0, 1: 50.0}
    assert [out[k].frequencia_acumulada for k in (10, 3, 1)] == [25.0, 50.0, 100.0]


def test_round_ratio_half_even(spark):
    from demandflow.functions.stats import round_ratio_half_even
    df = spark.createDataFrame([(1, 32), (3, 32), (1, 3), (2, 3)], "n long, d long")
    vals = [r[0] for r in df.select(round_ratio_half_even("n", "d", 100, 2)).collect()]
    assert vals == [3.12, 9.38, 33.33, 66.67]


def test_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 1, 2, 3, 4)], "x double")
    out = [r["count"] for r in profile.histogram(df, "x", 2).orderBy("bin").collect()]
    assert out == [2, 3]


def test_box_stats(spark):
    df = spark.createDataFrame([("a", float(v)) for v in (1, 2, 3, 4, 100)], "g string, v double")
    r = profile.box_stats(df, "v", "g").first()
    assert (r.q1, r.median, r.q3) == (2.0, 3.0, 4.0)
    assert (r.whisker_low, r.whisker_high, r.outliers) == (1.0, 4.0, 1)


def test_ordinal_labels_global_and_partitioned(spark):
    df = spark.createDataFrame([("b", "x"), ("a", "x"), ("c", "y"), ("a", "y")], "p string, g string")
    glob = {(r.p, r.lab) for r in profile.ordinal_labels(df, "p", "produto", "lab").collect()}
    assert glob == {("a", "produto1"), ("b", "produto2"), ("c", "produto3")}
    part = {(r.g, r.p, r.lab) for r in profile.ordinal_labels(df, "p", "produto", "lab", ["g"]).collect()}
    assert ("y", "c", "produto2") in part and ("x", "b", "produto2") in part


def test_a15_counts_exact_and_approx(spark):
    df = spark.createDataFrame([(i % 7, i) for i in range(1000)], "a int, b int")
    exact = {r.metric: r.value for r in profile.row_and_distinct_counts(df, ["a", "b"], "t").collect()}
    assert exact == {"t_rows": 1000, "t_a_distinct": 7, "t_b_distinct": 1000}
    approx = {r.metric: r.value for r in profile.row_and_distinct_counts(df, ["a", "b"], "t", approx=True).collect()}
    assert approx["t_a_distinct"] == 7 and abs(approx["t_b_distinct"] - 1000) <= 50


def test_approx_quantiles_close_to_exact(spark):
    rows = [("a" if i % 2 else "b", float((i * 37) % 1001)) for i in range(4000)]
    df = spark.createDataFrame(rows, "g string, v double")
    exact = profile.describe_columns(df, ["v"]).first()
    approx = profile.describe_columns(df, ["v"], approx=True).first()
    for q in ("p25", "p50", "p75"):
        assert abs(exact[q] - approx[q]) <= 2.0
    ex = {r.g: r for r in profile.box_stats(df, "v", "g").collect()}
    ap = {r.g: r for r in profile.box_stats(df, "v", "g", approx=True).collect()}
    assert set(ex) == set(ap) == {"a", "b"}
    assert all(abs(ex[g].median - ap[g].median) <= 2.0 for g in ex)
    assert all(ex[g].n == ap[g].n == 2000 for g in ex)
