"""Imputation policy (I1-I5): zero-fill change and sales columns, flag remaining nulls."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Prefixes of zero-filled columns, regional suffixes, excluded keys.
VARIATION_PREFIXES = ["price_var", "qty_var", "sales"]
REGIONAL_SUFFIXES = ("_n", "_ne", "_se", "_s", "_co")
EXCLUDE_FROM_HAVE_NULLS = {"order_week", "order_date", "year_week", "sales_qty", "revenue"}
_REGIONAL = re.compile(r"_(n|ne|se|s|co)$")
LAG_ROLL = re.compile(r"_(lag\d+|roll\d+_(mean|std))$")


def numeric_columns(df: DataFrame) -> list[str]:
    """Numeric columns in schema order."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def is_regional(col: str) -> bool:
    return bool(_REGIONAL.search(col))


def variation_columns(df: DataFrame, protect_lags: bool = False) -> list[str]:
    """Columns starting with a variation prefix (their lags and rollings too, unless
    ``protect_lags``)."""
    cols = [c for c in df.columns if any(c.startswith(p) for p in VARIATION_PREFIXES)]
    if protect_lags:
        cols = [c for c in cols if not LAG_ROLL.search(c)]
    return cols


def model_feature_candidates(df: DataFrame, exclude: Iterable[str] = EXCLUDE_FROM_HAVE_NULLS) -> list[str]:
    """Numeric columns without keys/target and without regional columns; falls back to
    all numeric non-excluded columns when that leaves nothing."""
    exclude = set(exclude)
    nums = numeric_columns(df)
    cols = [c for c in nums if c not in exclude and not is_regional(c)]
    return cols or [c for c in nums if c not in exclude]


def impute_nulls(df: DataFrame, protect_lags: bool = False) -> DataFrame:
    """I2 + I4: zero-fill the variation columns, then ``have_nulls`` = 1 when any model
    feature candidate is still null."""
    var_cols = variation_columns(df, protect_lags)
    out = df.fillna(0.0, subset=var_cols) if var_cols else df
    feats = model_feature_candidates(out)
    any_null = F.lit(False)
    for c in feats:
        any_null = any_null | F.col(c).isNull()
    return out.withColumn("have_nulls", any_null.cast("int"))


def null_totals(df: DataFrame) -> DataFrame:
    """I5 diagnostics: total null cells, and share of rows with ``have_nulls`` (one agg)."""
    total = None
    for c in df.columns:
        term = F.sum(F.col(c).isNull().cast("bigint"))
        total = term if total is None else total + term
    aggs = [total.alias("null_cells")]
    if "have_nulls" in df.columns:
        aggs.append((F.avg("have_nulls") * 100).alias("have_nulls_pct"))
    return df.agg(*aggs)


def imputation_summary(df: DataFrame, protect_lags: bool = False) -> DataFrame:
    """I5 diagnostics in one aggregation over the frame *before* imputation: null cells
    before, null cells after (zero-filled columns drop out, ``have_nulls`` is never null)
    and the % of rows flagged by ``have_nulls``."""
    from demandflow.functions.stats import round_ratio_half_even
    var_cols = set(variation_columns(df, protect_lags))
    imputed = impute_nulls(df, protect_lags)
    any_null = F.lit(False)
    for c in model_feature_candidates(imputed.drop("have_nulls")):
        filled = c in var_cols
        any_null = any_null | (F.lit(False) if filled else F.col(c).isNull())
    before = sum_nulls([F.col(c) for c in df.columns])
    after = sum_nulls([F.col(c) for c in df.columns if c not in var_cols])
    n = F.count(F.lit(1))
    return df.agg(before.alias("null_cells_before"), after.alias("null_cells_after"),
                  round_ratio_half_even(F.sum(any_null.cast("int")), n, 100, 4).alias("have_nulls_pct"))


def sum_nulls(cols):
    total = F.lit(0).cast("bigint")
    for c in cols:
        total = total + F.sum(c.isNull().cast("bigint"))
    return total
