"""Micro fixtures for cleaning, deltas, period keys, price changes and weighted means."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandflow.functions.stats import masked_wavg, propagating_wavg
from demandflow.functions.timecols import black_friday, cyber_monday
from demandflow.operators import clean, period

D = dt.datetime


def test_f1_floor_days(spark):
    df = spark.createDataFrame([(D(2018, 1, 1, 23), D(2018, 1, 2, 0), D(2018, 1, 1, 0), D(2018, 1, 1, 14, 34))],
                               "order_estimated_delivery_date timestamp_ntz, order_delivered_customer_date timestamp_ntz, "
                               "order_purchase_timestamp timestamp_ntz, order_approved_at timestamp_ntz")
    row = period.calc_time_deltas(df).first()
    assert row["delivery_diff_estimated"] == -1
    assert row["estimated_delivery_lead_days"] == 0
    assert row["approval_time_hours"] == pytest.approx(14 + 34 / 60)


def test_f2_week_monday(spark):
    df = spark.createDataFrame([(D(2018, 3, 25, 10),), (D(2018, 3, 26),)], "order_purchase_timestamp timestamp_ntz")
    out, key = period.add_time_key(df, "W")
    assert key == "order_week"
    assert [r[0] for r in out.select(key).collect()] == [dt.date(2018, 3, 19), dt.date(2018, 3, 26)]
    with pytest.raises(ValueError):
        period.add_time_key(df, "M")


def test_f6_black_friday(spark):
    df = spark.createDataFrame([(y,) for y in (2016, 2017, 2018, 2019, 2024)], "y int")
    rows = df.select(black_friday(F.col("y")).alias("bf"), cyber_monday(F.col("y")).alias("cm")).collect()
    assert [r.bf.day for r in rows] == [25, 24, 30, 29, 29]
    assert all(r.cm.weekday() == 0 for r in rows)


def _price_series(spark, prices):
    rows = [("p", dt.date(2018, 1, 1) + dt.timedelta(weeks=i), float(x) if x is not None else None, i + 1, "c")
            for i, x in enumerate(prices)]
    return spark.createDataFrame(rows, "product_id string, order_week date, price double, order_item_id bigint, "
                                       "product_category_name string")


def test_w2_zero_base_and_w3(spark):
    pv = period.compute_price_vars_by_product(_price_series(spark, [10, 20, 0, 5]), "order_week") \
        .orderBy("order_week").collect()
    assert [r.price_var_w1_point for r in pv] == [None, 1.0, -1.0, None]
    pv = period.compute_price_vars_by_product(_price_series(spark, [1, 2, 3, 4, 5]), "order_week") \
        .orderBy("order_week").collect()
    assert [r.price_roll4_mean for r in pv] == [None, None, None, 2.5, 3.5]


def test_w5_smooth(spark):
    pv = period.compute_price_vars_by_product(_price_series(spark, [10, 20, 10]), "order_week") \
        .orderBy("order_week").collect()
    assert [r.price_var_w1_smooth for r in pv] == [None, 1.0, pytest.approx(0.25)]


def test_a3_a8_weighted_means(spark):
    df = spark.createDataFrame([(1.0, 1.0), (None, 5.0), (3.0, 3.0)], "v double, w double")
    row = df.agg(masked_wavg("v", "w").alias("a3"), propagating_wavg("v", "w").alias("a8")).first()
    assert row.a3 == 2.5 and row.a8 is None
    none = spark.createDataFrame([(None, 1.0)], "v double, w double").agg(masked_wavg("v", "w")).first()[0]
    assert none is None


def test_p7_dedupe_keeps_first_in_order(spark):
    rows = [("o1", 1, "b", 2.0), ("o1", 1, "a", 9.0), ("o2", 1, "z", 1.0)]
    df = spark.createDataFrame(rows, "order_id string, order_item_id bigint, product_id string, price double")
    out = {(r.order_id, r.product_id) for r in clean.dedupe_items(df, order_by=["product_id", "price"]).collect()}
    assert out == {("o1", "a"), ("o2", "z")}


def test_p5_region_variants(spark):
    df = spark.createDataFrame([("sp",), ("XX",), (None,)], "customer_state string")
    plain = [r.customer_region for r in clean.add_customer_region(df).collect()]
    assert plain == [None, None, None]
    variant = [r.customer_region for r in clean.add_customer_region(df, default="estado inválido", upper=True).collect()]
    assert variant == ["Sudeste", "estado inválido", "estado inválido"]


def test_p6_skips_absent_columns(spark):
    df = spark.createDataFrame([("delivered", None), ("shipped", 1)], "order_status string, order_approved_at int")
    assert clean.delivered_filter(df).count() == 0
    assert clean.delivered_filter(df.drop("order_approved_at")).count() == 1


def test_p8_top_k_ties_by_name(spark):
    rows = [("SP", c, "p") for c in ["b", "a", "c", "c"]] + [("RJ", "z", "p")] * 5
    df = spark.createDataFrame(rows, "customer_state string, product_category_name string, product_id string")
    out = clean.filter_top_categories(df, "SP", 2)
    assert sorted(r.product_category_name for r in out.collect()) == ["a", "c", "c"]


def test_merged_matches_fixture_counts(spark):
    from demandflow.plans.common import merged
    m = merged(spark, "/root/testdata/sf0.01")
    assert m.count() == 14596
    row = m.agg(F.countDistinct("product_id").alias("p"), F.countDistinct("product_category_name").alias("c"),
                F.countDistinct("customer_state").alias("s"),
                F.countDistinct(F.trunc(F.col("order_purchase_timestamp").cast("date"), "week")).alias("w")).first()
    assert (row.p, row.c, row.s, row.w) == (1972, 25, 25, 345)
