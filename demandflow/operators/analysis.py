"""Feature-target analysis (E1-E7): continuous-feature selection, Pearson correlation with
its two-sided p-value, mutual information, combined rank and strength labels.

Features are unpivoted into (feature, x, y) rows and grouped by feature (and series), so
the work spreads over features; all statistics are built-in aggregates, the mutual information
over quantile bins included.  Only the nearest-neighbour estimator (``method="knn"``), for tables
with one row per period of a series, runs per (series, feature) group in ``applyInPandas``.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandflow.operators.impute import numeric_columns

# Strength labels and their cut-offs.
LOW, MODERATE, STRONG = "Baixo", "Moderado", "Forte"
PEARSON_CUTS = (0.3, 0.5)
MI_CUTS = (0.3, 0.6)
EULER_GAMMA = 0.5772156649015329


# --- E1 --------------------------------------------------------------------------------------
def continuous_feature_profile(df: DataFrame, target_col: str, min_nonnull_frac: float = 0.6,
                               exclude_cols: Iterable[str] = ()) -> DataFrame:
    """E1 as a table: (feature, nonnull_frac, is_binary, selected) from one aggregation.
    A column without values is "not binary" (and fails the fraction test)."""
    exclude = set(exclude_cols) | {target_col}
    cols = [c for c in numeric_columns(df) if c not in exclude]
    n = F.count(F.lit(1))
    aggs = []
    for c in cols:
        x = F.col(c)
        aggs += [(F.count(x) / n).alias(f"f__{c}"),
                 ((F.count(x) > 0) & (F.count_if(x.isNotNull() & ~x.isin(0, 1)) == 0)).alias(f"b__{c}")]
    one = df.agg(*aggs)
    stacked = one.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"f__{c}").alias("nonnull_frac"), F.col(f"b__{c}").alias("is_binary"))
        for c in cols])).alias("s")).select("s.*")
    frac = F.coalesce(F.col("nonnull_frac"), F.lit(0.0))
    return stacked.withColumn("selected", (frac >= min_nonnull_frac) & ~F.col("is_binary"))


def select_continuous_features(df: DataFrame, target_col: str, min_nonnull_frac: float = 0.6,
                               exclude_cols: Iterable[str] = ()) -> list[str]:
    """Names of the selected features in schema order (one small aggregation)."""
    prof = continuous_feature_profile(df, target_col, min_nonnull_frac, exclude_cols)
    chosen = {r["feature"] for r in prof.where("selected").select("feature").collect()}
    return [c for c in df.columns if c in chosen]


def feature_pairs(df: DataFrame, target_col: str, features: list[str], keep: Iterable[str] = ()) -> DataFrame:
    """(keep..., feature, x, y) rows with both values present."""
    keep = list(keep)
    long = df.select(*keep, F.col(target_col).cast("double").alias("y"),
                     *[F.col(c).cast("double").alias(c) for c in features]) \
        .unpivot([*keep, "y"], features, "feature", "x")
    return long.where(F.col("x").isNotNull() & F.col("y").isNotNull() & ~F.isnan("x") & ~F.isnan("y"))


# --- E2 --------------------------------------------------------------------------------------
_SERIES_TERMS, _FRACTION_STEPS, _SMALL = 400, 120, 5.0


def _log_gamma_ratio(z: Column) -> Column:
    """ln(Gamma(z + 1/2) / Gamma(z)) for z >= 1/2: ten steps up, then Stirling's expansion."""
    product, up = F.lit(1.0), z + 10
    for i in range(10):
        product = product * (z + i) / (z + (i + 0.5))
    return (F.log(up) / 2 - 1 / (8 * up) + 1 / (192 * F.pow(up, F.lit(3))) - 1 / (640 * F.pow(up, F.lit(5)))
            + 17 / (14336 * F.pow(up, F.lit(7))) + F.log(product))


def pearson_log_pvalue(r: Column, n: Column) -> Column:
    """ln of the two-sided p-value of Pearson's r with n pairs (t test, nu = n - 2 degrees):
    p = I_q(nu/2, 1/2), the regularised incomplete beta function at q = 1 - r^2.

    With t^2 / 2 > 5 it is the function's continued fraction (a fixed number of steps; its
    logarithm does not underflow); below, 1 - I_{r^2}(1/2, nu/2) by a fixed number of terms of
    the power series, whose value is far from 1 there.  |r| = 1 gives null (p is 0)."""
    nu = (n - 2).cast("double")
    a, r2 = nu / 2, r * r
    q = (1 - F.abs(r)) * (1 + F.abs(r))
    # q^a |r| / B(a, 1/2)
    front = a * F.when(r2 < 0.5, F.log1p(-r2)).otherwise(F.log(q)) + F.log(F.abs(r)) + _log_gamma_ratio(a) - 0.5 * math.log(math.pi)

    terms = F.aggregate(F.sequence(F.lit(1), F.lit(_SERIES_TERMS)), F.struct(F.lit(1.0).alias("t"), F.lit(1.0).alias("s")), lambda s, k: F.struct(
        (s["t"] * (a + (k - 0.5)) / (k + 0.5) * r2).alias("t"), (s["s"] + s["t"] * (a + (k - 0.5)) / (k + 0.5) * r2).alias("s")))["s"]
    near = F.log1p(-F.least(F.lit(1.0), F.exp(front) * 2 * terms))

    # Lentz: c and d are the ratios of successive numerators and denominators
    first = 1 / (1 - (a + 0.5) * q / (a + 1))

    def step(s: Column, m: Column) -> Column:
        even = m * (F.lit(0.5) - m) * q / ((a - 1 + 2 * m) * (a + 2 * m))
        d1, c1 = 1 / (1 + even * s["d"]), 1 + even / s["c"]
        odd = -(a + m) * (a + 0.5 + m) * q / ((a + 2 * m) * (a + 1 + 2 * m))
        d2, c2 = 1 / (1 + odd * d1), 1 + odd / c1
        return F.struct(c2.alias("c"), d2.alias("d"), (s["h"] * d1 * c1 * d2 * c2).alias("h"))

    start = F.struct(F.lit(1.0).alias("c"), first.alias("d"), first.alias("h"))
    h = F.aggregate(F.transform(F.sequence(F.lit(1), F.lit(_FRACTION_STEPS)), lambda m: m.cast("double")), start, step)["h"]
    far = front + F.log(h) - F.log(a)
    value = F.when(r == 0, F.lit(0.0)).when(nu * r2 <= 2 * _SMALL * q, near).otherwise(far)
    return F.when(r.isNotNull() & (n >= 3) & (F.abs(r) < 1), value)


def pearson_pvalue(r: Column, n: Column) -> Column:
    """Two-sided p-value; 0 where |r| = 1 (and where it is below the smallest double)."""
    return F.when(r.isNotNull() & (n >= 3), F.coalesce(F.exp(pearson_log_pvalue(r, n)), F.lit(0.0)))


def compute_pearson_corr(df: DataFrame, target_col: str, features: list[str], series_keys: Iterable[str] = ()) -> DataFrame:
    """Pairwise-complete r, two-sided p and n per feature; fewer than 3 pairs or a
    constant side gives null (no divide-by-zero under ANSI)."""
    keys = list(series_keys)
    pairs = feature_pairs(df, target_col, features, keys)
    # A constant side is detected exactly (max = min): streaming variance leaves float
    # residue on constant input, which would otherwise turn 0/0 into +-1.
    varying = (F.max("x") > F.min("x")) & (F.max("y") > F.min("y"))
    agg = pairs.groupBy(*keys, "feature").agg(
        F.count(F.lit(1)).alias("n_used"),
        F.when(varying, F.try_divide(F.covar_samp("x", "y"), F.stddev_samp("x") * F.stddev_samp("y"))).alias("__r"))
    # greatest/least skip nulls, so clip only a present r.
    r = F.when((F.col("n_used") >= 3) & F.col("__r").isNotNull(),
               F.least(F.lit(1.0), F.greatest(F.lit(-1.0), F.col("__r"))))
    out = agg.select(*keys, "feature", r.alias("pearson_r"), F.col("n_used").cast("bigint").alias("n_used"))
    out = out.withColumn("__lnp", pearson_log_pvalue(F.col("pearson_r"), F.col("n_used")))
    # the logarithm is exact where p itself is below the smallest double; null where p is 0
    p = F.when(F.col("pearson_r").isNotNull(), F.coalesce(F.exp("__lnp"), F.lit(0.0)))
    return out.withColumns({"pearson_pvalue": p, "log10_pvalue": F.col("__lnp") / F.lit(math.log(10))}).drop("__lnp")


# --- E3 --------------------------------------------------------------------------------------
def _harmonic(m: int) -> np.ndarray:
    """H_0..H_m (H_0 = 0)."""
    return np.concatenate([[0.0], np.cumsum(1.0 / np.arange(1, m + 1))])


def _digamma_int(v: np.ndarray, h: np.ndarray) -> np.ndarray:
    """psi(v) for positive integers v: -gamma + H_(v-1)."""
    return -EULER_GAMMA + h[v.astype(np.int64) - 1]


def _scale_no_mean(a: np.ndarray) -> np.ndarray:
    sd = a.std()
    return a / sd if sd > 0 else a


def ksg_mutual_information(x: np.ndarray, y: np.ndarray, k: int = 3, standardize: bool = True,
                           seed: int | None = 42, chunk: int | None = None, grid: float | None = None) -> float:
    """Kraskov-Stoegbauer-Grassberger estimator 1 (max-norm), the estimator behind the
    common ``mutual_info_regression``: z-score, rescale, add the seeded 1e-10 jitter that
    breaks ties (``seed=None``: no jitter; ``grid``: snap the scaled coordinates to a grid),
    then I = psi(N) + psi(k) - <psi(n_x + 1) + psi(n_y + 1)>, floored at 0.

    Distances are computed in row chunks (memory chunk x N); the marginal counts use the
    same exact coordinate differences."""
    x = np.asarray(x, dtype=np.float64).copy()
    y = np.asarray(y, dtype=np.float64).copy()
    n = x.size
    if standardize:
        for a in (x, y):
            sd = a.std()
            a -= a.mean()
            if sd > 0:
                a /= sd
    x = _scale_no_mean(x)
    if seed is not None:
        rng = np.random.RandomState(seed)
        x = x + 1e-10 * max(1.0, float(np.mean(np.abs(x)))) * rng.standard_normal(n)
        y = _scale_no_mean(y)
        y = y + 1e-10 * max(1.0, float(np.mean(np.abs(y)))) * rng.standard_normal(n)
    else:
        y = _scale_no_mean(y)
    if grid:
        # optional snap of the scaled coordinates: distances become exact multiples of the
        # grid step, so equal distances are equal in every engine (a well-posed tie rule)
        x = np.round(x / grid) * grid
        y = np.round(y / grid) * grid
    nx = np.empty(n, dtype=np.int64)
    ny = np.empty(n, dtype=np.int64)
    chunk = chunk or max(1, (1 << 22) // max(n, 1))     # about 4M distances per block
    for s in range(0, n, chunk):
        e = min(n, s + chunk)
        dx = np.abs(x[s:e, None] - x[None, :])
        dy = np.abs(y[s:e, None] - y[None, :])
        d = np.maximum(dx, dy)
        d[np.arange(e - s), np.arange(s, e)] = np.inf
        eps = np.partition(d, k - 1, axis=1)[:, k - 1]
        # marginal counts strictly inside the k-th neighbour distance, on the exact
        # coordinate differences (the point itself is removed)
        radius = np.nextafter(eps, 0)[:, None]
        nx[s:e] = (dx <= radius).sum(axis=1) - 1
        ny[s:e] = (dy <= radius).sum(axis=1) - 1
    h = _harmonic(n + 1)
    mi = (_digamma_int(np.array([n]), h)[0] + _digamma_int(np.array([k]), h)[0]
          - np.mean(_digamma_int(nx + 1, h)) - np.mean(_digamma_int(ny + 1, h)))
    return max(0.0, float(mi))


def compute_mutual_information(df: DataFrame, target_col: str, features: list[str], order_col: str | None = None,
                               series_keys: Iterable[str] = (), method: str = "binned", bins: int | None = None,
                               n_neighbors: int = 3, standardize: bool = True, random_state: int | None = 42,
                               min_rows: int = 5, grid: float | None = None) -> DataFrame:
    """Mutual information per (series, feature); fewer than ``min_rows`` pairs gives null.

    ``method="binned"`` (default) reads a contingency table over quantile bins, linear in the
    rows at any grain; a ``grid`` snaps the values, so that those which differ by the rounding of
    earlier sums only are equal.  ``method="knn"`` is the nearest-neighbour estimator: one task per
    (series, feature) with work that grows with the square of its rows, meant for tables with one
    row per period of a series.  Its rows are ordered by ``order_col`` inside the group, so the
    seeded jitter is reproducible; ``random_state=None`` with a ``grid`` gives the jitter-free
    estimator on grid-snapped z-scores, whose ties are exact."""
    keys = list(series_keys)
    if method == "binned":
        from demandflow.operators.mutual_info import binned_mutual_information
        from demandflow.session import materialize
        pairs = feature_pairs(df, target_col, features, keys)
        if grid:
            pairs = pairs.withColumns({c: F.round(F.col(c) / F.lit(grid)) * F.lit(grid) for c in ("x", "y")})
        pairs = materialize(pairs)
        return binned_mutual_information(pairs, [*keys, "feature"], bins, min_rows)
    if method != "knn":
        raise ValueError("method must be 'binned' or 'knn'")
    if order_col is None:
        raise ValueError("the nearest-neighbour estimator needs order_col")
    pairs = feature_pairs(df, target_col, features, [*keys, order_col])
    key_fields = [pairs.schema[k] for k in keys]
    schema = T.StructType([*key_fields, T.StructField("feature", T.StringType()),
                           T.StructField("mi", T.DoubleType()), T.StructField("n_used", T.LongType())])

    def per_group(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order_col, kind="mergesort")
        n = len(pdf)
        mi = None if n < min_rows else ksg_mutual_information(pdf["x"].to_numpy(), pdf["y"].to_numpy(), n_neighbors,
                                                              standardize, random_state, grid=grid)
        row = {k: pdf[k].iloc[0] for k in keys}
        row.update(feature=pdf["feature"].iloc[0], mi=mi, n_used=n)
        return pd.DataFrame([row], columns=[f.name for f in schema.fields])

    return pairs.groupBy(*keys, "feature").applyInPandas(per_group, schema)


# --- E4 --------------------------------------------------------------------------------------
def standardize(df: DataFrame, cols: Iterable[str], fit_df: DataFrame | None = None,
                suffix: str = "") -> tuple[DataFrame, dict[str, tuple[float, float]]]:
    """(x - mean) / population std, statistics fitted on ``fit_df`` (e.g. the train
    fold); a zero std divides by 1.  Returns the frame and the fitted (mean, std)."""
    cols = list(cols)
    fit_df = df if fit_df is None else fit_df
    row = fit_df.agg(*[F.avg(c).alias(f"m__{c}") for c in cols], *[F.stddev_pop(c).alias(f"s__{c}") for c in cols]).first()
    params = {}
    out = {}
    for c in cols:
        mu, sd = row[f"m__{c}"] or 0.0, row[f"s__{c}"] or 0.0
        sd = sd if sd > 0 else 1.0
        params[c] = (mu, sd)
        out[c + suffix] = (F.col(c) - F.lit(mu)) / F.lit(sd)
    return df.withColumns(out), params


# --- E5, E6 ----------------------------------------------------------------------------------
def combined_rank(pearson: DataFrame, mi: DataFrame, series_keys: Iterable[str] = ()) -> DataFrame:
    """E5 (J16): full outer join on the feature; |r| / max|r| and mi / max mi (null when
    the max is <= 0); score = mean of the available normalised values."""
    keys = list(series_keys)
    j = pearson.select(*keys, "feature", "pearson_r").join(mi.select(*keys, "feature", "mi"), [*keys, "feature"], "full")
    w = Window.partitionBy(*keys) if keys else Window.partitionBy()
    r_abs = F.abs("pearson_r")
    r_max = F.max(r_abs).over(w)
    mi_max = F.max("mi").over(w)
    r_norm = F.when(r_abs.isNotNull() & (r_max > 0), r_abs / r_max)
    mi_norm = F.when(F.col("mi").isNotNull() & (mi_max > 0), F.col("mi") / mi_max)
    out = j.select(*keys, "feature", "pearson_r", "mi", r_norm.alias("r_norm_abs"), mi_norm.alias("mi_norm"))
    n_ok = F.col("r_norm_abs").isNotNull().cast("int") + F.col("mi_norm").isNotNull().cast("int")
    score = F.when(n_ok > 0, (F.coalesce("r_norm_abs", F.lit(0.0)) + F.coalesce("mi_norm", F.lit(0.0))) / n_ok)
    return out.withColumn("score", score)


def strength_label(value: Column, cuts: tuple[float, float], absolute: bool) -> Column:
    """Baixo below the first cut, Moderado below the second, else Forte; null stays
    null."""
    v = F.abs(value) if absolute else value
    return F.when(v.isNull(), F.lit(None).cast("string")).when(v < cuts[0], LOW).when(v < cuts[1], MODERATE) \
        .otherwise(STRONG)


def add_strength_labels(rank: DataFrame) -> DataFrame:
    """E6 labels: ``pearson_label`` on |r|, ``mi_label`` on mi."""
    return rank.withColumns({"pearson_label": strength_label(F.col("pearson_r"), PEARSON_CUTS, True),
                             "mi_label": strength_label(F.col("mi"), MI_CUTS, False)})


def relevant_features(labelled: DataFrame) -> DataFrame:
    """E6 filter: keep features not low on both criteria (a null label is not 'low')."""
    return labelled.where(~F.col("pearson_label").eqNullSafe(LOW) | ~F.col("mi_label").eqNullSafe(LOW))


def analyze_continuous_features(df: DataFrame, target_col: str, order_col: str, min_nonnull_frac: float = 0.6,
                                n_neighbors_mi: int = 3, random_state: int = 42, top_n: int | None = None,
                                series_keys: Iterable[str] = (), mi_method: str = "binned", grid: float | None = None) -> dict:
    """E1 -> E2 -> E3 -> E5 -> E6; empty tables when no feature qualifies; with
    ``top_n`` also the chart tables of the best features by score: ``pearson_top`` by falling
    |r| and ``mi_top`` with mi relative to its maximum, falling.  The reports are sorted as
    published: r, mi and score falling, nulls last, ties by feature (T2)."""
    series_keys = list(series_keys)
    spark = df.sparkSession
    feats = select_continuous_features(df, target_col, min_nonnull_frac, [order_col, *series_keys])
    if not feats:
        return {"features": [],
                "pearson": spark.createDataFrame([], "feature string, pearson_r double, n_used bigint, pearson_pvalue double, "
                                                     "log10_pvalue double"),
                "mi": spark.createDataFrame([], "feature string, mi double, n_used bigint"),
                "rank": spark.createDataFrame([], "feature string, pearson_r double, mi double, r_norm_abs double, "
                                                  "mi_norm double, score double, pearson_label string, mi_label string")}
    pearson = compute_pearson_corr(df, target_col, feats, series_keys)
    mi = compute_mutual_information(df, target_col, feats, order_col, series_keys, mi_method, n_neighbors=n_neighbors_mi,
                                    random_state=random_state, grid=grid)
    rank = add_strength_labels(combined_rank(pearson, mi, series_keys))

    def report(table: DataFrame, by: Column) -> DataFrame:
        return table.orderBy(*series_keys, by, "feature")

    out = {"features": feats, "pearson": report(pearson, F.desc_nulls_last("pearson_r")),
           "mi": report(mi, F.desc_nulls_last("mi")), "rank": report(rank, F.desc_nulls_last("score"))}
    if top_n:
        w = Window.partitionBy(*series_keys) if series_keys else Window.partitionBy()
        nth = F.row_number().over(w.orderBy(F.desc_nulls_last("score"), "feature"))
        best = rank.select(*series_keys, "feature", nth.alias("__nth")).where(F.col("__nth") <= top_n).drop("__nth")
        on = [*series_keys, "feature"]
        out["pearson_top"] = report(pearson.join(best, on, "left_semi"), F.desc_nulls_last(F.abs("pearson_r")))
        top_mi = mi.join(best, on, "left_semi")
        most = F.max("mi").over(w)
        out["mi_top"] = report(top_mi.withColumn("mi_norm", F.when(most > 0, F.col("mi") / most)), F.desc_nulls_last("mi"))
    return out
