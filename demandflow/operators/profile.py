"""Exploration and data-quality tables.

Tables are aggregations with map-side partial aggregation; whatever depends on an order over
many rows (quartiles, numbering, the previous sale) is built on :mod:`ranks`.  The driver only
receives one-row scalars (histogram bounds) that parametrise the next pass.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandflow.functions.stats import bias_corrected_skew, excess_kurtosis, round_ratio_half_even
from demandflow.operators.impute import numeric_columns
from demandflow.operators.ranks import dense_numbers, exact_quantiles, previous_values, quantiles_of_ranks, running_totals
from demandflow.session import literal_rows, materialize, partitions_for

OTHERS_LABEL = "outros"   # fixed value: label of the categories outside the top 20


# --- data quality -------------------------------------------------------------------------
def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows and full-row duplicates (rows - distinct rows) in one pass."""
    per = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n"))
    return per.agg(F.sum("__n").cast("bigint").alias("rows"),
                   F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).cast("bigint").alias("duplicates"))


def null_profile(df: DataFrame) -> DataFrame:
    """P10: null count per column, only columns with nulls (single scan + unpivot)."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).cast("bigint").alias(c) for c in df.columns])
    long = counts.unpivot([], df.columns, "column", "nulls")
    return long.where(F.col("nulls") > 0)


def schema_info(df: DataFrame) -> DataFrame:
    """Column, type and non-null count (the ``info()`` table)."""
    counts = df.agg(*[F.count(F.col(c)).cast("bigint").alias(c) for c in df.columns])
    long = counts.unpivot([], df.columns, "column", "non_null")
    types = literal_rows(df.sparkSession, [(f.name, f.dataType.simpleString(), i) for i, f in enumerate(df.schema.fields)],
                         ["column", "dtype", "position"])
    return long.join(F.broadcast(types), "column")   # one row per column of the schema


def ordinal_labels(df: DataFrame, key: str, prefix: str, out_col: str,
                   partition_cols: Iterable[str] = ()) -> DataFrame:
    """Dense label ``<prefix><n>`` by ascending ``key`` (``produto1``, ...).

    Within ``partition_cols`` it is a partitioned ``dense_rank``.  A global numbering of
    all distinct keys is a running count over range partitions (:mod:`ranks`), so no
    single task receives every key.
    """
    parts = list(partition_cols)
    if parts:
        rank = F.dense_rank().over(Window.partitionBy(*parts).orderBy(key))
        return df.withColumn(out_col, F.concat(F.lit(prefix), rank.cast("string")))
    labels = dense_numbers(df, key, "__n")
    return df.join(labels, key, "left").withColumn(
        out_col, F.concat(F.lit(prefix), F.col("__n").cast("string"))).drop("__n")


# --- descriptive statistics ------------------------------------------------------------------
def _long(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], cols, "feature", "value")


QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def describe_columns(df: DataFrame, cols: Iterable[str], approx: bool = False) -> DataFrame:
    """Count, mean, sample std, min, quartiles (linear interpolation), max per column.

    Columns are unpivoted and grouped by name, so the work is distributed across columns
    and partially aggregated.  Exact quartiles are picked from running counts over range
    partitions, so no task holds a column's values; ``approx=True`` switches to
    ``percentile_approx`` in the same single pass.
    """
    cols = list(cols)
    v = F.col("value")
    long = _long(df, cols)
    base = [F.count(v).cast("bigint").alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
            F.min(v).alias("min"), F.max(v).alias("max")]
    if approx:
        q = F.percentile_approx(v, list(QUARTILES.values()), 10000)
        out = long.groupBy("feature").agg(*base, q.alias("__q")).select(
            "*", *[F.col("__q")[i].cast("double").alias(n) for i, n in enumerate(QUARTILES)])
    else:
        out = long.groupBy("feature").agg(*base).join(exact_quantiles(long, ["feature"], "value", QUARTILES), "feature", "left")
    return out.select("feature", "count", "mean", "std", "min", *QUARTILES, "max")


def summarize_features(df: DataFrame, exclude: Iterable[str] = ("product_category_name", "order_week"),
                       approx: bool = False) -> DataFrame:
    """Per numeric column: dtype, non-null count and %, min, quartiles, max, mean,
    std, bias-corrected skewness (n > 2), excess kurtosis (n > 3), distinct values."""
    exclude = set(exclude)
    cols = [c for c in numeric_columns(df) if c not in exclude]
    dtypes = literal_rows(df.sparkSession, [(c, df.schema[c].dataType.simpleString()) for c in cols], ["feature", "dtype"])
    v = F.col("value")
    n_total = F.count(F.lit(1))
    nn = F.count(v)
    q = (F.percentile_approx(v, [0.25, 0.5, 0.75], 10000) if approx else F.percentile(v, [0.25, 0.5, 0.75]))
    stats = _long(df, cols).groupBy("feature").agg(
        nn.cast("bigint").alias("count_notnull"),
        F.when(n_total > 0, round_ratio_half_even(nn, n_total, 100, 2)).alias("pct_notnull"),
        F.min(v).alias("min"), q.alias("__q"), F.max(v).alias("max"), F.avg(v).alias("mean"),
        F.when(nn > 1, F.stddev_samp(v)).alias("std"), bias_corrected_skew(v).alias("skew"),
        excess_kurtosis(v).alias("kurtosis"), F.count_distinct(v).cast("bigint").alias("n_unique"))
    stats = stats.select("feature", "count_notnull", "pct_notnull", "min",
                         *[F.col("__q")[i].cast("double").alias(n) for i, n in enumerate(("p25", "p50", "p75"))],
                         "max", "mean", "std", "skew", "kurtosis", "n_unique")
    return stats.join(F.broadcast(dtypes), "feature")


# --- order / product structure -----------------------------------------------------------------
def share_with_more_than_one(df: DataFrame, group_col: str, count_col: str) -> DataFrame:
    """Distinct ``count_col`` per ``group_col`` and the % of groups with more than
    one (two-stage group-by: distinct pairs, then counts).  Rows already dealt by ``group_col``
    do not move again."""
    per = df.where(F.col(group_col).isNotNull()).groupBy(group_col) \
        .agg(F.count_distinct(count_col).alias("n_distinct"))
    return per.agg(F.count(F.lit(1)).cast("bigint").alias("groups"),
                   F.count_if(F.col("n_distinct") > 1).cast("bigint").alias("groups_multi"),
                   round_ratio_half_even(F.count_if(F.col("n_distinct") > 1), F.count(F.lit(1)), 100, 4)
                   .alias("pct_multi"),
                   F.avg("n_distinct").alias("mean_distinct"), F.max("n_distinct").cast("bigint").alias("max_distinct"))


def sales_per_product(items: DataFrame, product_col: str = "product_id", count_col: str = "order_id") -> DataFrame:
    """Sales (non-null ``count_col`` rows) per product."""
    return items.where(F.col(product_col).isNotNull()).groupBy(product_col) \
        .agg(F.count(count_col).alias("n_sales"))


def capped_frequency(items: DataFrame, cap: int = 10) -> DataFrame:
    """A16 + W9: share of products by capped sales count (cap = "cap or more"), with the
    cumulative share from the top bucket down."""
    per = sales_per_product(items).select(F.least(F.col("n_sales"), F.lit(cap)).alias("n_vendas"))
    counts = per.groupBy("n_vendas").agg(F.count(F.lit(1)).alias("__c"))
    tot = F.sum("__c").over(Window.partitionBy())
    w = Window.orderBy(F.desc("n_vendas")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counts.select("n_vendas", (F.col("__c") * 100.0 / tot).alias("frequencia"),
                         (F.sum("__c").over(w) * 100.0 / tot).alias("frequencia_acumulada"))


def sales_volume_by_bucket(items: DataFrame, reviews: DataFrame | None = None, cap: int = 10) -> DataFrame:
    """A17 (+A19 when ``reviews`` is given, J14/J15): % of sales volume from products in
    each capped bucket 1..cap (absent buckets are 0), rounded half-even to 2 decimals,
    cumulative of the rounded values from the top bucket down; mean review score of the
    items in each bucket."""
    per = sales_per_product(items).withColumn("bucket", F.least(F.col("n_sales"), F.lit(cap)))
    vol = per.groupBy("bucket").agg(F.sum("n_sales").alias("vol"))
    spine = items.sparkSession.range(1, cap + 1).select(F.col("id").cast("int").alias("n_vendas_min"))
    full = spine.join(vol, spine.n_vendas_min == vol.bucket, "left").select(
        "n_vendas_min", F.coalesce(F.col("vol"), F.lit(0)).alias("vol"))
    total = F.sum("vol").over(Window.partitionBy())
    pct = full.select("n_vendas_min", round_ratio_half_even(F.col("vol"), total, 100, 2).alias("frequencia"))
    w = Window.orderBy(F.desc("n_vendas_min")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = pct.withColumn("frequencia_acumulada", F.round(F.sum("frequencia").over(w), 2))
    if reviews is not None:
        # an order's reviews and a product's items are summed before they meet
        of_order = reviews.groupBy("order_id").agg(F.sum("review_score").alias("__s"), F.count("review_score").alias("__c"))
        of_product = items.where(F.col("product_id").isNotNull()).select("order_id", "product_id").join(of_order, "order_id") \
            .groupBy("product_id").agg(F.sum("__s").alias("__s"), F.sum("__c").alias("__c"))
        mean = of_product.join(per.select("product_id", "bucket"), "product_id").groupBy("bucket").agg(
            round_ratio_half_even(F.sum("__s"), F.sum("__c"), 1, 2).alias("media_review_score"))
        out = out.join(mean, out.n_vendas_min == mean.bucket, "left").drop("bucket")
    return out


def _reviews_per_order(reviews: DataFrame) -> DataFrame:
    """Distinct reviews of each order that has reviews."""
    return reviews.groupBy("order_id").agg(F.count_distinct("review_id").alias("n_reviews"))


def review_multiplicity(items: DataFrame, reviews: DataFrame) -> DataFrame:
    """Distinct reviews per (order, product) after the n:m join; per multiplicity the
    number of distinct orders and products.

    Every product of an order has the order's reviews, so these are counted per order before they
    meet the items.  All rows of an order lie in one of :func:`partitions_for` partitions, so what
    a task holds does not grow with the input."""
    n = partitions_for(items)
    counts = _reviews_per_order(reviews.select("order_id", "review_id").repartition(n, "order_id"))

    def counted(*columns: str) -> DataFrame:
        per = items.select("order_id", *columns).repartition(n, "order_id").join(counts, "order_id", "left")
        return per.select("order_id", *columns, F.coalesce("n_reviews", F.lit(0).cast("bigint")).alias("n_reviews"))

    orders = counted().distinct().groupBy("n_reviews").agg(F.count("order_id").alias("orders"))
    pairs = counted("product_id").select("n_reviews", "product_id").distinct()
    return orders.join(pairs.groupBy("n_reviews").agg(F.count("product_id").alias("products")), "n_reviews")


def review_examples(items: DataFrame, reviews: DataFrame, n_reviews: int = 3) -> DataFrame:
    """The joined rows of every (order, product) with ``n_reviews`` distinct reviews, counted
    per order as in :func:`review_multiplicity`."""
    n = partitions_for(items)
    reviews = reviews.repartition(n, "order_id")
    items = items.where(F.col("order_id").isNotNull() & F.col("product_id").isNotNull()) \
        .select("order_id", "product_id").repartition(n, "order_id")
    counts = _reviews_per_order(reviews)
    if n_reviews > 0:
        return items.join(reviews.join(counts.where(F.col("n_reviews") == n_reviews), "order_id"), "order_id")
    without = items.join(counts.where(F.col("n_reviews") > 0), "order_id", "left_anti")
    return without.join(reviews, "order_id", "left").withColumn("n_reviews", F.lit(0).cast("bigint"))


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """First ``k`` rows of a total order (TakeOrderedAndProject: each task keeps k)."""
    return df.orderBy(*order).limit(k)


def category_table(items: DataFrame, products: DataFrame, top: int = 20) -> DataFrame:
    """Sales and distinct products per category; categories outside the ``top`` by
    sales become ``outros`` and are re-aggregated by sum; sales per product and the share
    of sales as text.  Items collapse to one row per product before they meet the products."""
    sold = items.where(F.col("product_id").isNotNull()).groupBy("product_id").agg(F.count("order_id").alias("__n"))
    ip = sold.join(products.where(F.col("product_category_name").isNotNull()), "product_id")
    per = ip.groupBy("product_category_name").agg(F.sum("__n").alias("vendas"), F.count_distinct("product_id").alias("itens"))
    best = top_k(per, [F.desc("vendas"), F.asc("product_category_name")], top) \
        .select("product_category_name", F.lit(True).alias("__top"))
    lab = per.join(F.broadcast(best), "product_category_name", "left").select(
        F.when(F.col("__top"), F.col("product_category_name")).otherwise(F.lit(OTHERS_LABEL)).alias("categoria"),
        "vendas", "itens")
    agg = lab.groupBy("categoria").agg(F.sum("vendas").cast("bigint").alias("vendas"),
                                       F.sum("itens").cast("bigint").alias("itens"))
    total = F.sum("vendas").over(Window.partitionBy())
    return agg.select("categoria", "vendas", "itens",
                      round_ratio_half_even(F.col("vendas"), F.col("itens"), 1, 2).alias("vendas_por_item"),
                      F.concat(round_ratio_half_even(F.col("vendas"), total, 100, 2).cast("string"), F.lit("%"))
                      .alias("percentual_vendas"))


def late_share(df: DataFrame, estimated_col: str = "order_estimated_delivery_date",
               delivered_col: str = "order_delivered_carrier_date") -> DataFrame:
    """% of rows delivered after the estimate (a null comparison counts as on time)."""
    late = F.coalesce(F.timestamp_diff("MICROSECOND", F.col(delivered_col), F.col(estimated_col)) < 0, F.lit(False))
    n = F.count(F.lit(1))
    return df.agg(n.cast("bigint").alias("rows"), F.count_if(late).cast("bigint").alias("late"),
                  round_ratio_half_even(F.count_if(late), n, 100, 4).alias("late_pct"))


def item_price_changes(orders: DataFrame, items: DataFrame, min_sales: int = 3) -> DataFrame:
    """W8 (J10, J12): per-product % price change between consecutive sales in purchase
    order, for products with at least ``min_sales`` sales (items of orders that are missing count
    as sales but have no place in the sequence); ties in the timestamp are broken by order id,
    item id, seller, price and freight (a total order up to identical rows).

    One scan of the items: rows are range-partitioned by (product, order), a product's sales
    are counted per partition, and each partition's first sale of a product takes the last price
    of the partition before.  A hot product, or a hot day of it, lies in many partitions."""
    order = ["order_purchase_timestamp", "order_id", "order_item_id", "seller_id", "price", "freight_value"]
    known = orders.select("order_id", "order_purchase_timestamp").withColumn("__sold", F.lit(True))
    rows = items.where(F.col("product_id").isNotNull()).join(known, "order_id", "left") \
        .select("product_id", *order, F.col("__sold").isNotNull().alias("__sold"))
    out = previous_values(rows, ["product_id", "__sold"], order, "price", "__prev",
                          total=("order_id", ["product_id"], "__sales"),
                          keep=["product_id", "order_id", "order_item_id", "order_purchase_timestamp", "price", "__sold"])
    change = (F.try_divide(F.col("price"), F.col("__prev")) - 1) * 100
    return out.where((F.col("__sales") >= min_sales) & F.col("__sold")).select(
        "product_id", "order_id", "order_item_id", "order_purchase_timestamp", "price", change.alias("price_pct_change"))


def nonzero_change_share(changes: DataFrame, col: str = "price_pct_change") -> DataFrame:
    """A24 (P13): % of non-null changes different from zero."""
    c = F.col(col)
    n = F.count(c)
    return changes.agg(n.cast("bigint").alias("changes"), F.count_if(c != 0).cast("bigint").alias("nonzero"),
                       round_ratio_half_even(F.count_if(c != 0), n, 100, 4).alias("nonzero_pct"))


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """Equal-width bins between min and max, last bin closed, empty bins included.
    One scalar pass fetches (min, max); the second pass counts per bin."""
    bounds = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    lo, hi = bounds["lo"], bounds["hi"]
    spark = df.sparkSession
    if lo is None:
        return spark.createDataFrame([], "bin int, lower double, upper double, count bigint")
    lo, hi = float(lo), float(hi)
    span = hi - lo if hi > lo else 1.0
    x = F.col(col).cast("double")
    idx = F.least(F.floor((x - F.lit(lo)) * F.lit(float(bins)) / F.lit(span)), F.lit(bins - 1)).cast("int")
    counts = df.where(x.isNotNull()).groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    spine = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    edge = lambda i: F.lit(lo) + i.cast("double") * F.lit(span) / F.lit(float(bins))
    return spine.join(counts, "bin", "left").select(
        "bin", edge(F.col("bin")).alias("lower"), edge(F.col("bin") + 1).alias("upper"),
        F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count"))


def box_stats(df: DataFrame, value_col: str, group_col: str, approx: bool = False) -> DataFrame:
    """Per group quartiles, whiskers at the furthest value within 1.5 IQR, outliers.

    Rows collapse to one per (group, value) first.  Exact quartiles are picked from running
    counts over range partitions (``approx=True``: ``percentile_approx``); the whiskers need a
    second pass over the collapsed rows, joined to the quartiles (one row per group)."""
    v = F.col(value_col).cast("double")
    base = df.where(v.isNotNull()).select(F.col(group_col), v.alias("__v"))
    base = base.groupBy(group_col, "__v").agg(F.count(F.lit(1)).alias("__c"))
    if approx:
        raw = df.where(v.isNotNull()).groupBy(group_col).agg(F.percentile_approx(v, list(QUARTILES.values()), 10000).alias("__q"))
        quart = raw.select(group_col, *[F.col("__q")[i].alias(n) for i, n in enumerate(("q1", "median", "q3"))])
    else:
        base = materialize(base)
        weighted = running_totals(base, [group_col], ["__v"], "__c")
        quart = quantiles_of_ranks(weighted, [group_col], "__v", "__c", {"q1": 0.25, "median": 0.5, "q3": 0.75})
    quart = quart.select(F.col(group_col).alias("__g"), "q1", "median", "q3", (F.col("q3") - F.col("q1")).alias("iqr"))
    lo = F.col("q1") - 1.5 * F.col("iqr")
    hi = F.col("q3") + 1.5 * F.col("iqr")
    j = base.join(quart, base[group_col].eqNullSafe(F.col("__g"))).where(F.col(group_col).isNotNull())
    return j.groupBy(group_col, "q1", "median", "q3", "iqr").agg(
        F.min(F.when(F.col("__v") >= lo, F.col("__v"))).alias("whisker_low"),
        F.max(F.when(F.col("__v") <= hi, F.col("__v"))).alias("whisker_high"),
        F.sum(F.when((F.col("__v") < lo) | (F.col("__v") > hi), F.col("__c")).otherwise(F.lit(0))).cast("bigint").alias("outliers"),
        F.sum("__c").cast("bigint").alias("n"))


def share_of_total(df: DataFrame, value_col: str, out_col: str = "share") -> DataFrame:
    """X / sum(x) over the whole (small, aggregated) table."""
    return df.withColumn(out_col, F.col(value_col) / F.sum(value_col).over(Window.partitionBy()))


def category_price_means_unweighted(price_vars: DataFrame, time_col: str) -> DataFrame:
    """Plain mean of the product changes per category and period (older variant)."""
    from demandflow.operators.period import PRICE_VARS
    fan = price_vars.select(time_col, *PRICE_VARS, F.explode("__cats").alias("__c")) \
        .where(F.col("__c.category").isNotNull())
    return fan.groupBy(F.col("__c.category").alias("product_category_name"), time_col) \
        .agg(*[F.avg(v).alias(f"{v}_mean") for v in PRICE_VARS])


def row_and_distinct_counts(df: DataFrame, id_cols: Iterable[str], prefix: str, approx: bool = False,
                            rsd: float = 0.01) -> DataFrame:
    """``<prefix>_rows`` and ``<prefix>_<col>_distinct`` as (metric, value) rows from one
    aggregation; ``approx=True`` uses HyperLogLog++ (``approx_count_distinct``, relative
    error ``rsd``) so no exact distinct set is shuffled at scale."""
    cols = list(id_cols)
    distinct = (lambda c: F.approx_count_distinct(c, rsd)) if approx else F.count_distinct
    agg = df.agg(F.count(F.lit(1)).cast("bigint").alias(f"{prefix}_rows"),
                 *[distinct(c).cast("bigint").alias(f"{prefix}_{c}_distinct") for c in cols])
    return agg.unpivot([], agg.columns, "metric", "value")
