"""Projection, cleaning and the item-grain merge."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOG = logging.getLogger(__name__)

# The raw tables' column names.
ORDERS_COLS = [
    "order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
    "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date",
]
PRODUCTS_COLS = ["product_id", "product_category_name"]
CUSTOMERS_COLS = ["customer_id", "customer_unique_id", "customer_state"]
DATE_COLS = [
    "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
    "order_delivered_customer_date", "order_estimated_delivery_date", "shipping_limit_date",
]
ID_COLS = ["order_id", "customer_id", "product_id"]

# Brazilian state codes of each region (customer_region).
REGION_STATES = {
    "Norte": ["AC", "AP", "AM", "PA", "RO", "RR", "TO"],
    "Nordeste": ["AL", "BA", "CE", "MA", "PB", "PE", "PI", "RN", "SE"],
    "Centro-Oeste": ["DF", "GO", "MT", "MS"],
    "Sudeste": ["ES", "MG", "RJ", "SP"],
    "Sul": ["PR", "RS", "SC"],
}
INVALID_STATE_LABEL = "estado inválido"

DEDUP_KEYS = ("order_id", "order_item_id")
DEDUP_ORDER = ("order_purchase_timestamp", "product_id", "seller_id", "price",
               "order_delivered_carrier_date", "freight_value")


def safe_select(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Keep the listed columns that exist; warn about the others."""
    cols = list(cols)
    missing = [c for c in cols if c not in df.columns]
    if missing:
        LOG.warning("columns missing in selection: %s", missing)
    return df.select(*[c for c in cols if c in df.columns])


def require_columns(df: DataFrame, cols: Iterable[str]) -> None:
    """Plan-time check; raises ``KeyError`` naming the missing columns."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"required columns missing: {missing}")


def coerce_datetime(df: DataFrame, cols: Iterable[str] = DATE_COLS) -> DataFrame:
    """Parse present date columns to TIMESTAMP_NTZ; unparseable text becomes null."""
    out = {}
    for c in cols:
        if c not in df.columns:
            continue
        dtype = df.schema[c].dataType
        if isinstance(dtype, T.StringType):
            # straight to NTZ: by way of a zoned timestamp, times in a zone's gap would move
            out[c] = F.col(c).try_cast("timestamp_ntz")
        elif isinstance(dtype, (T.DateType, T.TimestampType)):
            out[c] = F.col(c).cast("timestamp_ntz")
    return df.withColumns(out) if out else df


def cast_ids_to_str(df: DataFrame, cols: Iterable[str] = ID_COLS) -> DataFrame:
    """Id columns to string; nulls stay null (they never join)."""
    out = {c: F.col(c).cast("string") for c in cols if c in df.columns}
    return df.withColumns(out) if out else df


def add_customer_region(df: DataFrame, mapping: Mapping[str, Iterable[str]] | DataFrame | None = None,
                        state_col: str = "customer_state", out_col: str = "customer_region",
                        default: str | None = None, upper: bool = False) -> DataFrame:
    """P5: map a state code to its region.

    ``mapping`` is either {region: [states]} (compiled into a literal map expression, no
    join at all) or a (state, region) dimension DataFrame, joined left on the state (AQE
    broadcasts it when its measured size is under the broadcast threshold).  Unknown
    states map to ``default`` (null in the pipeline; ``"estado inválido"`` in the
    exploration variant, which also upper-cases the state).
    """
    if state_col not in df.columns:
        LOG.warning("column %s not found; region not added", state_col)
        return df
    key = F.upper(F.col(state_col)) if upper else F.col(state_col)
    mapping = REGION_STATES if mapping is None else mapping
    if isinstance(mapping, DataFrame):
        dim = mapping.select(F.col("state").alias("__state"), F.col("region").alias(out_col)) \
            .dropDuplicates(["__state"])
        joined = df.join(dim, key == F.col("__state"), "left").drop("__state")
        return joined.withColumn(out_col, F.coalesce(F.col(out_col), F.lit(default))) if default else joined
    pairs = []
    for region, states in mapping.items():
        for state in states:
            pairs += [F.lit(state), F.lit(region)]
    lookup = F.create_map(*pairs)[key]
    if default is not None:
        lookup = F.coalesce(lookup, F.lit(default))
    return df.withColumn(out_col, lookup)


def delivered_filter(df: DataFrame) -> DataFrame:
    """Delivered orders with category, approval and both delivery dates present.
    A clause whose column is absent is skipped."""
    conds = []
    if "order_status" in df.columns:
        conds.append(F.col("order_status") == "delivered")
    for c in ("product_category_name", "order_approved_at", "order_delivered_customer_date",
              "order_delivered_carrier_date"):
        if c in df.columns:
            conds.append(F.col(c).isNotNull())
    if not conds:
        return df
    cond = conds[0]
    for c in conds[1:]:
        cond = cond & c
    return df.where(cond)


def dedupe_items(df: DataFrame, keys: Iterable[str] = DEDUP_KEYS,
                 order_by: Iterable[str] = DEDUP_ORDER) -> DataFrame:
    """One row per key, the first in the total order ``order_by`` (nulls first),
    then the remaining columns as tie breakers.

    The first row of a window: Spark keeps one row per key in each task before a shuffle (window
    group limit), so a hot key does not reach one task, and rows travel once.
    """
    keys = [k for k in keys if k in df.columns]
    if not keys:
        return df
    order_cols = [c for c in order_by if c in df.columns and c not in keys]
    tie = [c for c in df.columns if c not in keys and c not in order_cols and not isinstance(df.schema[c].dataType, (T.MapType,))]
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*order_cols, *tie))
    return df.withColumn("__nth", nth).where(F.col("__nth") == 1).drop("__nth")


def dedupe_report(df: DataFrame, keys: Iterable[str] = DEDUP_KEYS) -> DataFrame:
    """P7's count of removed rows, in one pass with partial aggregation: ``rows``, ``kept`` and
    ``removed``."""
    per = df.groupBy(*[k for k in keys if k in df.columns]).agg(F.count(F.lit(1)).alias("__n"))
    return per.agg(F.coalesce(F.sum("__n"), F.lit(0)).cast("bigint").alias("rows"), F.count(F.lit(1)).cast("bigint").alias("kept"),
                   F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).cast("bigint").alias("removed"))


def filter_top_categories(df: DataFrame, state: str | None = "SP", k: int = 7,
                          state_col: str = "customer_state",
                          category_col: str = "product_category_name") -> DataFrame:
    """Rows of one state, restricted to the ``k`` categories with most rows there.

    Ties are broken by category name.  The top-k list has ``k`` rows by construction, so
    broadcasting it for the semi join is bounded.
    """
    scoped = df.where(F.col(state_col) == state) if state is not None else df
    counts = scoped.where(F.col(category_col).isNotNull()).groupBy(category_col) \
        .agg(F.count("product_id").alias("__n"))
    top = counts.orderBy(F.desc("__n"), F.asc(category_col)).limit(k).select(category_col)
    return scoped.join(F.broadcast(top), category_col, "left_semi")


def build_merged(orders: DataFrame, items: DataFrame, products: DataFrame, customers: DataFrame,
                 region_mapping: Mapping[str, Iterable[str]] | DataFrame | None = None,
                 filter_state: str | None = None, top_k: int = 7, dedupe: bool = True) -> DataFrame:
    """J1-J3 + P1-P8: the cleaned item-grain table.

    Join order differs from the textbook orders->items->products->customers: items meet
    products first (shuffle on product_id), then the order side (orders with their
    customers, both order grain, region already mapped on the customers) on order_id.  The final shuffle is on order_id, which
    already clusters the (order_id, order_item_id) deduplication, so the item-grain data
    is shuffled twice instead of four times.  Inner/left semantics are the same.  A state filter
    is applied to the customers, so that items of other states drop out in the first join
    with the orders (an order has one customer).
    """
    orders = cast_ids_to_str(safe_select(orders, ORDERS_COLS))
    products = cast_ids_to_str(safe_select(products, PRODUCTS_COLS))
    customers = cast_ids_to_str(safe_select(customers, CUSTOMERS_COLS))
    items = cast_ids_to_str(items)
    # The region depends on the customer's state only: map it on the customers table, before
    # any item-grain join, so item rows are never shuffled by state (a handful of keys).
    customers = add_customer_region(customers, region_mapping)

    item_cols = [c for c in items.columns if c != "order_id"]
    prod_cols = [c for c in products.columns if c != "product_id"]
    cust_cols = [c for c in customers.columns if c != "customer_id"]  # includes customer_region
    order_cols = list(orders.columns)

    items_p = items.join(products, "product_id", "left")
    if filter_state is not None:
        customers = customers.where(F.col("customer_state") == filter_state)
    order_side = orders.join(customers, "customer_id", "left" if filter_state is None else "inner")
    df = order_side.join(items_p, "order_id", "inner")
    df = df.select(*order_cols, *item_cols, *prod_cols, *cust_cols)
    df = coerce_datetime(df, DATE_COLS)
    df = delivered_filter(df)
    if dedupe:
        df = dedupe_items(df)
    if filter_state is not None:
        df = filter_top_categories(df, None, top_k)  # the state is filtered already
    return df
