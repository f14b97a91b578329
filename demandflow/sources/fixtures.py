"""Stand-in input: the driver's TPC-H-like tables presented in the raw retail schemas.

These builders only rename, cast and plant nulls (the source has none) so that the rows
have the schema the library's operators expect.  They do none of the library's work:
joins across the four raw tables, region mapping, filtering, deduplication and all
aggregation happen in ``demandflow.operators``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the stand-in mapping (FIXTURES.md section 3).
STATUS_MAP = {"F": "delivered", "O": "shipped"}          # anything else -> "processing"
APPROVED_NULL_MOD = 97      # order_approved_at is null when order key % 97 = 0
APPROVED_MINUTES = (37, 4000)    # approved = purchase + (key*37 % 4000) minutes
DELIVERED_NULL_MOD = 89     # delivered-customer date null when order key % 89 = 0
DELIVERED_HOURS = (53, 400)      # delivered = ship date + (key*53 % 400) hours
ESTIMATED_DAYS = 30
CATEGORY_NULL_MOD = 83      # category null when part key % 83 = 0
REVIEW_DUP_MOD = 50         # second review row for order key % 50 = 0
# Region names of the driver data and their column suffixes.
FIXTURE_REGION_SUFFIX = {"AFRICA": "n", "AMERICA": "ne", "ASIA": "se", "EUROPE": "s", "MIDDLE EAST": "co"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _minutes(n: Column) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), n.cast("int"), F.lit(0))


def _hours(n: Column) -> Column:
    return F.make_dt_interval(F.lit(0), n.cast("int"), F.lit(0), F.lit(0))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    status = F.when(F.col("o_orderstatus") == "F", "delivered") \
        .when(F.col("o_orderstatus") == "O", "shipped").otherwise("processing")
    approved = F.when(key % APPROVED_NULL_MOD != 0,
                      F.col("o_orderdate") + _minutes((key * APPROVED_MINUTES[0]) % APPROVED_MINUTES[1]))
    return o.select(
        key.cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        status.alias("order_status"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
        approved.alias("order_approved_at"),
        (F.col("o_orderdate") + F.make_dt_interval(F.lit(ESTIMATED_DAYS))).alias("order_estimated_delivery_date"),
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items; the two delivery dates live at line grain in the driver data."""
    li = table(spark, sf_dir, "lineitem")
    key = F.col("l_orderkey")
    delivered = F.when(key % DELIVERED_NULL_MOD != 0,
                       F.col("l_shipdate") + _hours((key * DELIVERED_HOURS[0]) % DELIVERED_HOURS[1]))
    return li.select(
        key.cast("string").alias("order_id"),
        F.col("l_linenumber").cast("bigint").alias("order_item_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_suppkey").cast("string").alias("seller_id"),
        F.col("l_extendedprice").alias("price"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("freight_value"),
        F.col("l_shipdate").alias("order_delivered_carrier_date"),
        delivered.alias("order_delivered_customer_date"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.when(F.col("p_partkey") % CATEGORY_NULL_MOD != 0, F.col("p_brand")).alias("product_category_name"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with the nation name as their state code."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")   # 25 rows by the TPC-H definition
    return c.join(n, c.c_nationkey == n.n_nationkey, "left").select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.col("c_custkey").cast("string").alias("customer_unique_id"),
        F.col("n_name").alias("customer_state"),
    )


def state_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State -> region dimension (nation name -> region name)."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")   # 5 rows by the TPC-H definition
    return n.join(r, n.n_regionkey == r.r_regionkey, "left").select(
        F.col("n_name").alias("state"), F.col("r_name").alias("region"))


def order_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One review per order (score = first digit of the priority), a second one for some."""
    o = table(spark, sf_dir, "orders")
    score = F.substring("o_orderpriority", 1, 1).cast("int")
    first = o.select(F.col("o_orderkey").cast("string").alias("review_id"),
                     F.col("o_orderkey").cast("string").alias("order_id"), score.alias("review_score"))
    second = o.where(F.col("o_orderkey") % REVIEW_DUP_MOD == 0).select(
        F.concat(F.col("o_orderkey").cast("string"), F.lit("b")).alias("review_id"),
        F.col("o_orderkey").cast("string").alias("order_id"),
        (6 - score).alias("review_score"))
    return first.unionByName(second)


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The catalog the pipeline reads: orders, order_items, products, customers."""
    return {
        "orders": orders(spark, sf_dir),
        "order_items": order_items(spark, sf_dir),
        "products": products(spark, sf_dir),
        "customers": customers(spark, sf_dir),
    }
