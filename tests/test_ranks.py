"""Order across partitions: running totals, neighbours, numbers and quantiles against plain Python."""

import math
import random

import numpy as np
import pytest

from demandflow.operators import analysis, mutual_info, profile, ranks


@pytest.fixture(scope="module")
def rows():
    """A hot key, a null key, repeated values and nulls."""
    rng = random.Random(5)
    out = [("hot", float(rng.randrange(40)), k) for k in range(600)] + [(None, float(rng.randrange(9)), 1000 + k) for k in range(50)]
    out += [("one", 3.0, 5000), ("nulls", None, 6000)]
    return out


def test_running_totals_and_neighbours(spark, rows):
    df = spark.createDataFrame(rows, "k string, v double, id long").repartition(6)
    got = {r["id"]: r for r in ranks.previous_values(df, ["k"], ["v", "id"], "v", "prev", total=("v", ["k"], "n")).collect()}
    totals = {r["id"]: r["upto"] for r in ranks.running_totals(df, ["k"], ["v", "id"], "id").collect()}
    for key in ("hot", None, "one", "nulls"):
        own = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        run = 0
        for i, r in enumerate(own):
            run += r[2]
            assert totals[r[2]] == run
            assert got[r[2]]["prev"] == (own[i - 1][1] if i else None)
            assert got[r[2]]["n"] == sum(x[1] is not None for x in own)
    assert ranks.running_totals(df.limit(0), ["k"], ["v"], "id").count() == 0


def test_dense_numbers_and_labels(spark):
    df = spark.createDataFrame([(x,) for x in ["b", "a", "c", "a", None, "d"]], "k string").repartition(4)
    assert {r["k"]: r["n"] for r in ranks.dense_numbers(df, "k", "n").collect()} == {"a": 1, "b": 2, "c": 3, "d": 4}
    got = profile.ordinal_labels(df, "k", "p", "label").collect()
    assert {(r["k"], r["label"]) for r in got} == {("a", "p1"), ("b", "p2"), ("c", "p3"), ("d", "p4"), (None, None)} and len(got) == 6


def test_quantiles_match_numpy(spark, rows):
    df = spark.createDataFrame(rows, "k string, v double, id long")
    got = {r["k"]: r for r in ranks.exact_quantiles(df, ["k"], "v", {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}).collect()}
    assert set(got) == {"hot", None, "one"}
    for key, r in got.items():
        own = [v for k, v, _ in rows if k == key]
        assert np.allclose([r[c] for c in "abcde"], np.quantile(own, [0, 0.25, 0.5, 0.9, 1]))
    box = {r["k"]: r for r in profile.box_stats(df, "v", "k").collect()}
    own = np.array([v for k, v, _ in rows if k == "hot"])
    q1, q3 = np.quantile(own, [0.25, 0.75])
    inside = own[(own >= q1 - 1.5 * (q3 - q1)) & (own <= q3 + 1.5 * (q3 - q1))]
    assert box["hot"]["n"] == 600 and box["hot"]["whisker_low"] == inside.min() and box["hot"]["whisker_high"] == inside.max()
    assert box["hot"]["outliers"] == 600 - len(inside)


def binned(x, y, bins):
    """Plug-in mutual information over rank bins with the Miller-Madow correction."""
    n = len(x)
    if n < 5:
        return None
    place = [[sum(w < v for w in side) * bins // n for v in side] for side in (x, y)]
    cells = list(zip(*place))
    def h(labels):
        counts = [labels.count(c) for c in set(labels)]
        return -sum(c / n * math.log(c / n) for c in counts) + (len(counts) - 1) / (2 * n)
    return max(0.0, h(place[0]) + h(place[1]) - h(cells))


def test_binned_mutual_information(spark):
    rng = np.random.default_rng(2)
    rows, data = [], {}
    for s in (None, "a"):
        y = rng.normal(size=300)
        columns = {"same": y, "noise": rng.normal(size=300), "zeros": np.where(rng.random(300) < 0.6, 0.0, y), "short": np.r_[y[:3], [np.nan] * 297]}
        data[s] = (y, columns)
        rows += [(s, float(y[i]), *[None if math.isnan(c[i]) else float(c[i]) for c in columns.values()]) for i in range(300)]
    df = spark.createDataFrame(rows, "s string, y double, same double, noise double, zeros double, short double").repartition(5)
    features = ["same", "noise", "zeros", "short"]
    for bins in (None, 4):
        got = {(r["s"], r["feature"]): r for r in analysis.compute_mutual_information(df, "y", features, series_keys=["s"], bins=bins).collect()}
        for s, (y, columns) in data.items():
            for f, x in columns.items():
                ok = ~np.isnan(x)
                n = int(ok.sum())
                b = bins or min(mutual_info.MAX_BINS, max(2, int(math.sqrt(n / 5))))
                want = binned(x[ok].tolist(), y[ok].tolist(), b)
                assert got[s, f]["n_used"] == n
                assert got[s, f]["mi"] is None if want is None else abs(got[s, f]["mi"] - want) < 1e-9
    assert got["a", "same"]["mi"] > got["a", "zeros"]["mi"] > got["a", "noise"]["mi"]
    assert analysis.compute_mutual_information(df.limit(0), "y", features).count() == 0


def test_mutual_information_of_many_rows(spark):
    """Far beyond what a nearest-neighbour search in one task could do."""
    df = spark.range(200_000).selectExpr("sin(id) AS x", "cast(id % 2 as double) AS z", "sin(id) + cast(id % 3 as double) AS y")
    got = {r["feature"]: r["mi"] for r in analysis.compute_mutual_information(df, "y", ["x", "z"]).collect()}
    assert got["x"] > 0.5 and got["z"] < 0.01


def test_pearson_tails(spark):
    from pyspark.sql import functions as F
    cases = [(0.95, 57, 1.7736530437688976e-29), (0.7, 345, 4.323775024028764e-52), (-0.2, 10, 0.5795839999999999), (0.9, 4, 0.1), (0.5, 3, 2 / 3),
             (0.99, 3, 0.09010682728882419), (1e-5, 3_000_000_000, math.erfc(1e-5 * math.sqrt(3e9 / 2))), (1e-4, 3_000_000_000, math.erfc(1e-4 * math.sqrt(3e9 / 2))),
             (0.0, 50, 1.0), (1.0, 5, 0.0), (None, 9, None), (0.4, 2, None)]
    df = spark.createDataFrame([(r, n) for r, n, _ in cases], "r double, n long")
    got = df.select(analysis.pearson_pvalue(F.col("r"), F.col("n")).alias("p"), analysis.pearson_log_pvalue(F.col("r"), F.col("n")).alias("l")).collect()
    for g, (r, n, p) in zip(got, cases, strict=True):
        if p is None:
            assert g["p"] is None
        else:
            assert g["p"] == pytest.approx(p, rel=1e-6, abs=0) if p else g["p"] == 0.0
    # below the smallest double the logarithm still tells
    tiny = spark.createDataFrame([(0.5, 3_000_000_000)], "r double, n long").select(analysis.pearson_log_pvalue(F.col("r"), F.col("n")).alias("l")).first()["l"]
    assert tiny == pytest.approx(1.5e9 * math.log(0.75), rel=1e-6)


def test_reports_are_sorted(spark):
    rng = np.random.default_rng(4)
    y = rng.normal(size=200)
    rows = [(k, float(y[k]), float(-y[k] + rng.normal()), float(y[k] + 3 * rng.normal()), float(rng.normal())) for k in range(200)]
    df = spark.createDataFrame(rows, "t int, y double, a double, b double, c double")
    res = analysis.analyze_continuous_features(df, "y", "t", top_n=2)
    assert [r["pearson_r"] for r in res["pearson"].collect()] == sorted((r["pearson_r"] for r in res["pearson"].collect()), reverse=True)
    assert [r["score"] for r in res["rank"].collect()] == sorted((r["score"] for r in res["rank"].collect()), reverse=True)
    top = res["pearson_top"].collect()
    assert [abs(r["pearson_r"]) for r in top] == sorted((abs(r["pearson_r"]) for r in top), reverse=True) and len(top) == 2
    assert res["mi_top"].first()["mi_norm"] == 1.0 and res["mi_top"].count() == 2
