"""E3 at any size: mutual information from a contingency table over quantile bins.

Each (series, feature) has its own bins, of nearly equal counts, for the feature and for the
target, over the rows where both are present.  Equal values share a bin: the one that the rank of
the first of them falls into.  Bin edges come from exact ranks (:mod:`ranks`), rows find their bin
among the edges of their group, and the joint table is one aggregation over
(series, feature, bin_x, bin_y): linear in the rows, with partial aggregation before every shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandflow.operators.ranks import value_ranks

MAX_BINS = 64


def default_bins(n: Column) -> Column:
    """Bins per side for ``n`` rows: about five rows per cell, at least 2, at most ``MAX_BINS``."""
    return F.least(F.lit(MAX_BINS), F.greatest(F.lit(2), F.floor(F.sqrt(n / F.lit(5.0))).cast("int")))


def quantile_edges(pairs: DataFrame, keys: list[str], bins: int | None) -> DataFrame:
    """Per keys, the lowest value of each bin that is not empty: ``__ex`` and ``__ey``, ascending, at
    most ``MAX_BINS`` (or ``bins``) each."""
    sides = pairs.select(*keys, F.explode(F.array(*[F.struct(F.lit(s).alias("__side"), F.col(s).alias("__v")) for s in ("x", "y")])).alias("__s")) \
        .select(*keys, "__s.*")
    ranks = value_ranks(sides, [*keys, "__side"], "__v")
    total = ranks.groupBy(*keys, "__side").agg(F.sum("c").alias("__n"))
    both = ranks.alias("a").join(total.alias("b"), _equal("a", "b", [*keys, "__side"])).select("a.*", "b.__n")
    wanted = default_bins(F.col("__n")) if bins is None else F.lit(bins)
    bin_no = F.floor((F.col("upto") - F.col("c")) * wanted / F.col("__n"))
    lows = both.groupBy(*keys, "__side", bin_no.alias("__bin")).agg(F.min("__v").alias("__low"))
    return lows.groupBy(*keys).agg(*[F.sort_array(F.collect_list(F.when(F.col("__side") == s, F.col("__low")))).alias(f"__e{s}") for s in ("x", "y")])


def _equal(a: str, b: str, keys: list[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}"))
    return cond


def contingency(pairs: DataFrame, keys: list[str], bins: int | None = None) -> DataFrame:
    """``keys, __bx, __by, __c``: rows per cell."""
    edges = quantile_edges(pairs, keys, bins)
    rows = pairs.alias("a").join(edges.alias("b"), _equal("a", "b", keys))
    place = {s: F.size(F.expr(f"filter(b.__e{s}, e -> e <= a.{s})")).alias(f"__b{s}") for s in ("x", "y")}
    return rows.select(*[F.col(f"a.{k}") for k in keys], *place.values()).groupBy(*keys, "__bx", "__by").agg(F.count(F.lit(1)).alias("__c"))


def binned_mutual_information(pairs: DataFrame, keys: Iterable[str], bins: int | None = None, min_rows: int = 5) -> DataFrame:
    """``keys, mi, n_used`` from rows ``keys, x, y``: the plug-in estimate in nats with the
    Miller-Madow correction of its bias by the numbers of cells in use, floored at 0; fewer than
    ``min_rows`` pairs give null."""
    keys = list(keys)
    cells = contingency(pairs, keys, bins)
    # a group has at most MAX_BINS^2 cells
    row, column = (F.sum("__c").over(Window.partitionBy(*keys, b)) for b in ("__bx", "__by"))
    marked = cells.select("*", row.alias("__cx"), column.alias("__cy"))
    log = F.col("__c") * (F.log(F.col("__c").cast("double")) - F.log(F.col("__cx").cast("double")) - F.log(F.col("__cy").cast("double")))
    out = marked.groupBy(*keys).agg(F.sum("__c").alias("__n"), F.sum(log).alias("__s"), F.count(F.lit(1)).alias("__kxy"),
                                    F.count_distinct("__bx").alias("__kx"), F.count_distinct("__by").alias("__ky"))
    n = F.col("__n").cast("double")
    raw = F.col("__s") / n + F.log(n) + (F.col("__kx") + F.col("__ky") - F.col("__kxy") - 1) / (2 * n)
    return out.select(*keys, F.when(n >= min_rows, F.greatest(F.lit(0.0), raw)).alias("mi"), F.col("__n").cast("bigint").alias("n_used"))
