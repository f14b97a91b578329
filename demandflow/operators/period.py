"""Period table: time deltas, period key, price changes, regional metrics, target
(F1, F2, A1-A12, W1-W5, J4-J8).

Shuffle plan of ``build_period_table`` over item-grain rows (the only large input): one
``groupBy(product, category, region, period)`` of additive partials (item counts, price sums,
sums and counts of the three deltas), written to the shared folder, from which both branches
are rolled up:

* price branch: partials by product for the per-product window, then by category and period;
* time branch: partials by (region, period), from which the wide regional columns, the
  sales-weighted means and the target are read in a single ``groupBy(period)``.

Hot products or regions are absorbed by the partial aggregation: after it a product has
at most (#periods x #categories x #regions) rows, a number bounded by the calendar.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandflow.functions.stats import masked_wavg, propagating_wavg
from demandflow.functions.timecols import PERIOD_COLUMN, floor_days_between, hours_between, period_start
from demandflow.operators.clean import require_columns
from demandflow.session import materialize

# Region name -> column suffix.
REGION_SUFFIX = {"Norte": "n", "Nordeste": "ne", "Sudeste": "se", "Sul": "s", "Centro-Oeste": "co"}

# Output column names.
PRICE_VARS = ["price_var_w1_point", "price_var_w1_smooth", "price_var_w4_point", "price_var_m4_vs_prev4"]
PRICE_MEANS = [f"{c}_mean" for c in PRICE_VARS]
DELTA_COLS = {  # row-level delta -> regional mean name
    "delivery_diff_estimated": "delivery_diff_estimated_mean",
    "estimated_delivery_lead_days": "est_delivery_lead_days_mean",
    "approval_time_hours": "approval_time_hours_mean",
}
WEIGHTED_COLS = {
    "delivery_diff_estimated_mean": "delivery_diff_estimated_weighted",
    "est_delivery_lead_days_mean": "est_delivery_lead_days_weighted",
    "approval_time_hours_mean": "approval_time_hours_weighted",
}


# ---------------------------------------------------------------------------------------
# F1, F2
# ---------------------------------------------------------------------------------------
def calc_time_deltas(df: DataFrame, delivered_col: str = "order_delivered_customer_date") -> DataFrame:
    """delivery_diff_estimated and estimated_delivery_lead_days in floored days,
    approval_time_hours in hours."""
    require_columns(df, ["order_estimated_delivery_date", delivered_col, "order_purchase_timestamp",
                         "order_approved_at"])
    return df.withColumns({
        "delivery_diff_estimated": floor_days_between("order_estimated_delivery_date", delivered_col),
        "estimated_delivery_lead_days": floor_days_between("order_estimated_delivery_date",
                                                           "order_purchase_timestamp"),
        "approval_time_hours": hours_between("order_approved_at", "order_purchase_timestamp"),
    })


def add_time_key(df: DataFrame, freq: str = "W", ts_col: str = "order_purchase_timestamp") -> tuple[DataFrame, str]:
    """``order_week`` (Monday) or ``order_date`` as DATE; returns (frame, key name)."""
    require_columns(df, [ts_col])
    freq = freq.upper()
    if freq not in PERIOD_COLUMN:
        raise ValueError("freq must be 'W' (weekly) or 'D' (daily)")
    key = PERIOD_COLUMN[freq]
    return df.withColumn(key, period_start(ts_col, freq)), key


# ---------------------------------------------------------------------------------------
# Price branch
# ---------------------------------------------------------------------------------------
def _weight_mode(df: DataFrame) -> str:
    """A2: revenue weight by item count, else by distinct orders, else by price sum."""
    if "order_item_id" in df.columns:
        return "items"
    if "order_id" in df.columns:
        return "orders"
    return "sum"


PRICE_SUMS = ("n_items", "price_sum", "price_n")


def _in_days(col: str) -> bool:
    return not col.endswith("_hours")


def _delta_sums() -> list[Column]:
    """Additive partials of the three deltas.  Hours are summed as whole microseconds, so that the
    mean does not depend on the order of summation (day counts are whole numbers already)."""
    out = []
    for c in DELTA_COLS:
        x = F.col(c) if _in_days(c) else F.round(F.col(c) * 3.6e9).cast("bigint")
        out += [F.sum(x).alias(f"__s_{c}"), F.count(c).alias(f"__n_{c}")]
    return out


def _delta_means() -> list[Column]:
    """Means from the partials, as the reference's column names."""
    out = []
    for c, name in DELTA_COLS.items():
        total = F.sum(f"__s_{c}")
        out.append(F.try_divide(total if _in_days(c) else total / F.lit(3.6e9), F.sum(f"__n_{c}")).alias(name))
    return out


def item_partials(df: DataFrame, time_col: str, series_keys: Iterable[str] = (), product_col: str = "product_id",
                  category_col: str = "product_category_name", region_col: str = "customer_region") -> DataFrame:
    """The one aggregation of item-grain rows: additive partials per (series, product, category,
    region, period).  Null products, categories and regions are groups of their own."""
    keys = list(dict.fromkeys([*series_keys, product_col, category_col, region_col, time_col]))
    qty = F.count("order_item_id") if _weight_mode(df) == "items" else F.lit(None).cast("bigint")
    return df.where(F.col(time_col).isNotNull()).groupBy(*keys).agg(
        qty.alias("n_items"), F.sum("price").alias("price_sum"), F.count("price").alias("price_n"),
        F.count(F.lit(1)).alias("__rows"), *_delta_sums())


def product_period_partials(df: DataFrame, time_col: str, series_keys: Iterable[str] = (),
                            product_col: str = "product_id",
                            category_col: str = "product_category_name") -> DataFrame:
    """Additive partials per (series, product, category, period): item count, price sum and
    non-null price count.  This is the only shuffle of item-grain rows in the price branch
    (the distinct-order weight adds two more group-bys, see ``_order_weights``)."""
    keys = list(dict.fromkeys([*series_keys, product_col, category_col, time_col]))
    mode = _weight_mode(df)
    qty = F.count("order_item_id") if mode == "items" else F.lit(None).cast("bigint")
    return (df.where(F.col(product_col).isNotNull() & F.col(time_col).isNotNull())
            .groupBy(*keys)
            .agg(qty.alias("n_items"), F.sum("price").alias("price_sum"), F.count("price").alias("price_n")))


def products_of_partials(partials: DataFrame, time_col: str, series_keys: Iterable[str] = (), product_col: str = "product_id",
                         category_col: str = "product_category_name") -> DataFrame:
    """:func:`product_period_partials` from :func:`item_partials`.  Dealt by product, as the price
    changes need them, so nothing moves again."""
    keys = list(dict.fromkeys([*series_keys, product_col, category_col, time_col]))
    dealt = partials.where(F.col(product_col).isNotNull()).select(*keys, *PRICE_SUMS)
    return dealt.repartition(*[F.col(k) for k in dict.fromkeys([*series_keys, product_col])]) \
        .groupBy(*keys).agg(*[F.sum(c).alias(c) for c in PRICE_SUMS])


def regions_of_partials(partials: DataFrame, time_col: str, series_keys: Iterable[str] = (),
                        region_col: str = "customer_region") -> DataFrame:
    """:func:`region_period_partials` from :func:`item_partials`."""
    target = F.sum("n_items")
    return partials.groupBy(*dict.fromkeys([*series_keys, region_col, time_col])).agg(
        *_delta_means(), F.sum("__rows").alias("sales"), target.alias("__target"))


def _order_weights(df: DataFrame, keys: list[str], out: str) -> DataFrame:
    """A2 (ii): distinct orders x mean price per group (distinct counts do not add up
    across groups, so this weight needs its own group-by)."""
    return df.where(F.col(keys[-1]).isNotNull()).groupBy(*keys).agg(
        (F.count_distinct("order_id") * F.avg("price")).alias(out))


def _price_window_columns(df: DataFrame, keys: list[str], time_col: str) -> DataFrame:
    """W2-W5 over one row per (keys, period), ordered by period; rows, not calendar steps."""
    w = Window.partitionBy(*keys).orderBy(time_col)
    cum = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    w4 = w.rowsBetween(-3, Window.currentRow)
    w2 = w.rowsBetween(-1, Window.currentRow)
    step1 = df.select(
        "*",
        F.last("price_mean", ignorenulls=True).over(cum).alias("__ff"),
        F.when(F.count("price_mean").over(w4) == 4, F.avg("price_mean").over(w4)).alias("price_roll4_mean"),
    )
    step2 = step1.select(
        "*",
        (F.try_divide(F.col("__ff"), F.lag("__ff", 1).over(w)) - 1).alias("price_var_w1_point"),
        (F.try_divide(F.col("__ff"), F.lag("__ff", 4).over(w)) - 1).alias("price_var_w4_point"),
        F.last("price_roll4_mean", ignorenulls=True).over(cum).alias("__rff"),
    )
    step3 = step2.select(
        "*",
        (F.try_divide(F.col("__rff"), F.lag("__rff", 4).over(w)) - 1).alias("price_var_m4_vs_prev4"),
        F.avg("price_var_w1_point").over(w2).alias("price_var_w1_smooth"),
    )
    return step3.drop("__ff", "__rff")


def price_vars_from_partials(partials: DataFrame, time_col: str, series_keys: Iterable[str] = (),
                             product_col: str = "product_id",
                             category_col: str = "product_category_name",
                             weight_mode: str = "items", rows: DataFrame | None = None) -> DataFrame:
    """A1 + W1-W5 from the partials; keeps the per-category partials in ``__cats`` so the
    category fan-out (J5) needs no join.

    The partials are hash-partitioned by product once; the (product, period) roll-up and
    the product window both reuse that partitioning.  ``weight_mode`` picks the A2 revenue
    weight: items x mean price, distinct orders x mean price (needs the item ``rows``), or
    the price sum.
    """
    keys = [*series_keys, product_col]
    per_product = (
        partials.repartition(*[F.col(k) for k in dict.fromkeys(keys)])
        .groupBy(*keys, time_col)
        .agg(
            (F.sum("price_sum") / F.nullif(F.sum("price_n"), F.lit(0))).alias("price_mean"),
            F.sum("n_items").alias("__n_items"),
            F.sum("price_sum").alias("__price_sum"),
            F.collect_list(F.struct(F.col(category_col).alias("category"), "n_items", "price_sum", "price_n"))
            .alias("__cats"),
        )
    )
    if weight_mode == "items":
        per_product = per_product.withColumn("revenue", F.col("__n_items") * F.col("price_mean"))
    elif weight_mode == "sum":
        per_product = per_product.withColumn("revenue", F.col("__price_sum").cast("double"))
    else:
        w = _order_weights(rows, [*keys, time_col], "revenue")
        per_product = per_product.join(w, [*keys, time_col], "left")
    per_product = per_product.drop("__n_items", "__price_sum")
    return _price_window_columns(per_product, keys, time_col)


def compute_price_vars_by_product(df: DataFrame, time_col: str, series_keys: Iterable[str] = (),
                                  product_col: str = "product_id") -> DataFrame:
    """Product x period mean price and its four changes (plus ``price_roll4_mean``)."""
    require_columns(df, [product_col, time_col, "price"])
    cat = "product_category_name"
    src = df if cat in df.columns else df.withColumn(cat, F.lit(None).cast("string"))
    pv = price_vars_from_partials(product_period_partials(src, time_col, series_keys, product_col),
                                  time_col, series_keys, product_col, weight_mode=_weight_mode(src), rows=src)
    return pv.drop("__cats", "revenue")


def aggregate_price_vars_to_category(price_vars: DataFrame, time_col: str, series_keys: Iterable[str] = (),
                                     category_col: str = "product_category_name", weight_mode: str = "items",
                                     rows: DataFrame | None = None) -> DataFrame:
    """A4 (+J4, J5, A2, A3): category x period revenue-weighted means of the four changes.

    Input is the output of ``price_vars_from_partials``: each product row fans out to every
    category it had in the period; the category's own revenue (for A5) is carried along
    (or, for the distinct-order weight, computed from ``rows`` and joined: J6).
    """
    keys = [*series_keys, time_col]
    fan = price_vars.select(*keys, *PRICE_VARS, "revenue", F.explode("__cats").alias("__c")) \
        .where(F.col("__c.category").isNotNull())
    mean_price = F.sum("__c.price_sum") / F.nullif(F.sum("__c.price_n"), F.lit(0))
    if weight_mode == "items":
        rev_cat = F.sum("__c.n_items") * mean_price
    elif weight_mode == "sum":
        rev_cat = F.sum("__c.price_sum").cast("double")
    else:
        rev_cat = F.lit(None).cast("double")
    out = fan.groupBy(*series_keys, F.col("__c.category").alias(category_col), time_col).agg(
        *[masked_wavg(v, "revenue").alias(f"{v}_mean") for v in PRICE_VARS], rev_cat.alias("revenue_cat"))
    if weight_mode == "orders":
        w = _order_weights(rows, [*series_keys, category_col, time_col], "revenue_cat")
        out = out.drop("revenue_cat").join(w, [*series_keys, category_col, time_col], "left")
    return out


def aggregate_price_vars_to_time(price_cat: DataFrame, time_col: str, series_keys: Iterable[str] = ()) -> DataFrame:
    """A5: period-level means of the category means, weighted by category revenue."""
    return price_cat.groupBy(*series_keys, time_col).agg(
        *[masked_wavg(m, "revenue_cat").alias(m) for m in PRICE_MEANS])


# ---------------------------------------------------------------------------------------
# Time branch
# ---------------------------------------------------------------------------------------
def region_period_partials(df: DataFrame, time_col: str, series_keys: Iterable[str] = (),
                           region_col: str = "customer_region") -> DataFrame:
    """(region, period) means of the three deltas, the sales weight and the item count
    for the target.  The null region is kept as a group so the target counts every row."""
    mode = _weight_mode(df)
    if mode == "items":
        sales = F.count(F.lit(1))
        target = F.count("order_item_id")
    elif mode == "orders":
        sales = F.count_distinct("order_id")
        target = F.lit(None).cast("bigint")
    else:
        sales = F.count(F.lit(1))
        target = F.lit(None).cast("bigint")
    return (df.where(F.col(time_col).isNotNull())
            .groupBy(*dict.fromkeys([*series_keys, region_col, time_col]))
            .agg(*[_order_free_mean(src).alias(dst) for src, dst in DELTA_COLS.items()],
                 sales.alias("sales"), target.alias("__target")))


def _order_free_mean(col: str) -> Column:
    """Mean that does not depend on the order of summation (see :func:`_delta_sums`)."""
    if _in_days(col):
        return F.avg(col)
    return F.try_divide(F.sum(F.round(F.col(col) * 3.6e9).cast("bigint")) / F.lit(3.6e9), F.count(col))


def _suffix(region: str, suffix_map: Mapping[str, str]) -> str:
    return suffix_map.get(region, region.lower())


#: As Spark's own pivot refuses more values.
MAX_REGIONS = 10_000


def regions_in(df: DataFrame, region_col: str = "customer_region", suffix_map: Mapping[str, str] = REGION_SUFFIX) -> list[str]:
    """A7's regions: those of the map and, after them, those in the data beyond it.  One small
    distinct at plan time; a pivot needs its columns."""
    found = {r[0] for r in df.select(region_col).where(F.col(region_col).isNotNull()).distinct().limit(MAX_REGIONS + 1).collect()}
    if len(found) > MAX_REGIONS:
        raise ValueError(f"more than {MAX_REGIONS} regions: pass the wanted ones as regions=")
    return [*suffix_map, *sorted(found - set(suffix_map))]


def wide_weighted_from_partials(per_reg: DataFrame, time_col: str, series_keys: Iterable[str] = (),
                                region_col: str = "customer_region",
                                suffix_map: Mapping[str, str] = REGION_SUFFIX,
                                regions: Iterable[str] | None = None,
                                with_target: bool = True) -> DataFrame:
    """A7 + A8 (+ A10 when ``with_target``) in one ``groupBy(period)``.

    The pivot is over ``regions``; by default those of the map and any others in the data, which
    get their lower-cased name as suffix.  The weighted mean propagates a null regional mean (A8)."""
    regions = regions_in(per_reg, region_col, suffix_map) if regions is None else list(regions)
    reg = F.col(region_col)
    aggs: list[Column] = []
    if with_target:
        aggs.append(F.sum("__target").cast("bigint").alias("sales_qty"))
    for metric in DELTA_COLS.values():
        for r in regions:
            aggs.append(F.max(F.when(reg == r, F.col(metric))).alias(f"{metric}_{_suffix(r, suffix_map)}"))
    known = reg.isNotNull()
    for metric, out in WEIGHTED_COLS.items():
        aggs.append(propagating_wavg(metric, "sales", known).alias(out))
    return per_reg.groupBy(*series_keys, time_col).agg(*aggs)


def aggregate_time_metrics_wide_weighted(df: DataFrame, time_col: str, series_keys: Iterable[str] = (),
                                         region_col: str = "customer_region",
                                         suffix_map: Mapping[str, str] = REGION_SUFFIX,
                                         regions: Iterable[str] | None = None) -> DataFrame:
    """Wide regional means and sales-weighted means per period."""
    require_columns(df, [region_col, time_col, *DELTA_COLS])
    per_reg = region_period_partials(df, time_col, series_keys, region_col)
    per_reg = per_reg if regions is not None else materialize(per_reg)
    return wide_weighted_from_partials(per_reg, time_col, series_keys, region_col, suffix_map, regions,
                                       with_target=False)


def aggregate_sales_target(df: DataFrame, time_col: str, series_keys: Iterable[str] = ()) -> DataFrame:
    """A10: items per period; else distinct orders; else rows."""
    require_columns(df, [time_col])
    if "order_item_id" in df.columns:
        agg = F.count("order_item_id")
    elif "order_id" in df.columns:
        agg = F.count_distinct("order_id")
    else:
        agg = F.count(F.lit(1))
    return df.where(F.col(time_col).isNotNull()).groupBy(*series_keys, time_col) \
        .agg(agg.cast("bigint").alias("sales_qty"))


def period_table_from_keyed(df: DataFrame, time_col: str, series_keys: Iterable[str] = (),
                            suffix_map: Mapping[str, str] = REGION_SUFFIX,
                            regions: Iterable[str] | None = None) -> DataFrame:
    """A12 body on rows that already carry deltas and the period key.  Unless the weights need
    distinct orders, which do not add up, the rows are read and aggregated once."""
    series_keys = list(series_keys)
    mode = _weight_mode(df)
    keys = [*series_keys, time_col]
    if mode == "orders":
        # each of the five aggregates below reads these few columns, not the joins again
        used = [*keys, "order_id", "product_id", "product_category_name", "customer_region", "price", *DELTA_COLS]
        rows = df = materialize(df.where(F.col(time_col).isNotNull()).select(*dict.fromkeys(used)))
        partials = product_period_partials(df, time_col, series_keys)
        per_reg = materialize(region_period_partials(df, time_col, series_keys))
    else:
        rows = None
        once = materialize(item_partials(df, time_col, series_keys))
        partials = products_of_partials(once, time_col, series_keys)
        per_reg = regions_of_partials(once, time_col, series_keys)
        regions = regions_in(once, suffix_map=suffix_map) if regions is None else regions
    price_vars = price_vars_from_partials(partials, time_col, series_keys, weight_mode=mode, rows=rows)
    price_cat = aggregate_price_vars_to_category(price_vars, time_col, series_keys, weight_mode=mode, rows=rows)
    price_time = aggregate_price_vars_to_time(price_cat, time_col, series_keys)
    if mode == "sum":
        per_reg = per_reg.withColumn("__target", F.col("sales"))
    wide = wide_weighted_from_partials(per_reg, time_col, series_keys, suffix_map=suffix_map, regions=regions,
                                       with_target=mode != "orders")
    target_time = wide if mode != "orders" else aggregate_sales_target(df, time_col, series_keys).join(wide, keys, "left")
    out = target_time.join(price_time, keys, "left")
    front = [*keys, "sales_qty", *PRICE_MEANS]
    return out.select(*front, *[c for c in out.columns if c not in front])


def build_period_table(merged: DataFrame, freq: str = "W", series_keys: Iterable[str] = (),
                       suffix_map: Mapping[str, str] = REGION_SUFFIX,
                       regions: Iterable[str] | None = None) -> DataFrame:
    """One row per (series, period) with target, price changes and delivery metrics.
    Periods without sales do not appear (no gap filling)."""
    require_columns(merged, ["order_purchase_timestamp", "order_estimated_delivery_date",
                             "order_delivered_customer_date", "order_approved_at", "product_id",
                             "product_category_name", "price", "customer_region"])
    df = calc_time_deltas(merged)
    df, time_col = add_time_key(df, freq)
    return period_table_from_keyed(df, time_col, series_keys, suffix_map, regions)


def build_weekly_aggregation(merged: DataFrame, **kw) -> DataFrame:
    return build_period_table(merged, "W", **kw)


def build_daily_aggregation(merged: DataFrame, **kw) -> DataFrame:
    return build_period_table(merged, "D", **kw)
