"""Work that must not be repeated and tasks that must not grow with the input."""

from collections import defaultdict

from demandflow.operators import period, profile, ranks
from demandflow.plans import queries
from demandflow.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_folds_read_a_written_weekly_target(spark):
    """F4"""
    assert "lineitem" not in _plan(QUERIES["b5_backtest_seasonal_naive"](spark, SF))


def test_all_forecasters_share_one_weekly_target(spark, monkeypatch):
    """F1; the trees, slow to fit, are stood in for by the naive forecast."""
    built, keep = [], queries.weekly_target
    monkeypatch.setattr(queries, "weekly_target", lambda *a: (built.append(a), keep(*a))[1])
    monkeypatch.setattr(queries, "_gbt_predictions", lambda *a: queries._naive_predictions(queries._weekly_input(*a)))
    plan = _plan(QUERIES["b11_model_metrics"](spark, SF))
    assert len(built) == 2 and "lineitem" not in plan  # one of them the stand-in's


def test_order_weights_read_the_items_once(spark, monkeypatch):
    """F6"""
    written, keep = [], period.materialize
    monkeypatch.setattr(period, "materialize", lambda df: (written.append(_plan(df)), keep(df))[1])
    rest = _plan(QUERIES["a12_period_table_weekly_order_weights"](spark, SF))
    assert "lineitem" in written[0] and not any("lineitem" in p for p in [*written[1:], rest])


def test_previous_values_move_the_written_rows_once(spark):
    """of the rows as written one exchange by their partition and key, and none by the columns
    that only order them."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(QUERIES["w8_item_price_changes"](spark, SF))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    rows = plan[plan.index("SortMergeJoin"):]
    assert rows[:rows.index("FileScan")].count("Exchange") == 1 and "freight_value" not in plan and "seller_id" not in plan


def test_previous_values_with_null_keys_and_equal_rows(spark):
    rows = [("a", None, 1, 5.0), ("a", None, 2, None), ("a", None, 3, 7.0), (None, True, 1, 1.0), (None, True, 1, 1.0),
            (None, None, 4, 2.0), ("a", True, 9, 3.0)]
    df = spark.createDataFrame(rows, "k string, s boolean, t int, v double").repartition(4)
    got = ranks.previous_values(df, ["k", "s"], ["t", "v"], "v", "p", total=("v", ["k"], "n"), keep=["k", "s", "t"])
    assert got.columns == ["k", "s", "t", "p", "n"]
    by_t = lambda r: (str(r[0]), str(r[1]), r[2], str(r[3]))
    assert sorted(map(tuple, got.collect()), key=by_t) == sorted(
        [("a", None, 1, None, 3), ("a", None, 2, 5.0, 3), ("a", None, 3, None, 3), (None, True, 1, None, 3),
         (None, True, 1, 1.0, 3), (None, None, 4, None, 3), ("a", True, 9, None, 3)], key=by_t)


ITEMS = [("o1", "p1"), ("o1", "p1"), ("o1", "p2"), ("o2", "p1"), ("o3", None), ("o4", "p3"), (None, "p4"), ("o5", "p5")]
REVIEWS = [("r1", "o1", 5), ("r2", "o1", 4), ("r2", "o1", 4), ("r3", "o2", 1), (None, "o3", 2), ("r4", None, 3), ("r5", "o9", 3), (None, "o5", 1)]


def _reviewed(spark):
    return (spark.createDataFrame(ITEMS, "order_id string, product_id string"),
            spark.createDataFrame(REVIEWS, "review_id string, order_id string, review_score int"))


def test_reviews_are_counted_per_order_in_parts_of_a_fixed_size(spark, monkeypatch):
    """F2, F3"""
    items, reviews = _reviewed(spark)
    monkeypatch.setattr(profile, "partitions_for", lambda df: 77)
    for df in (profile.review_multiplicity(items, reviews), profile.review_examples(items, reviews, 2)):
        plan = _plan(df)
        assert "Expand" not in plan and ", 77), REPARTITION_BY_NUM" in plan and "hashpartitioning(order_id#" in plan


def test_review_tables_match_the_n_to_m_join(spark):
    items, reviews = _reviewed(spark)
    joined = [(o, p, r, s) for o, p in ITEMS for r, q, s in ([x for x in REVIEWS if o is not None and x[1] == o] or [(None, None, None)])]
    ids = defaultdict(set)
    for o, p, r, _ in joined:
        ids[o, p] |= {r} - {None}
    want = {n: (len({o for (o, _), v in ids.items() if len(v) == n} - {None}), len({p for (_, p), v in ids.items() if len(v) == n} - {None}))
            for n in map(len, ids.values())}
    assert {r["n_reviews"]: (r["orders"], r["products"]) for r in profile.review_multiplicity(items, reviews).collect()} == want
    for n in (0, 1, 2, 3):
        got = profile.review_examples(items, reviews, n)
        assert got.columns == ["order_id", "product_id", "review_id", "review_score", "n_reviews"]
        rows = [(*x, n) for x in joined if None not in x[:2] and len(ids[x[0], x[1]]) == n]
        assert sorted(map(tuple, got.collect()), key=str) == sorted(rows, key=str)


def test_products_per_order_in_parts_of_a_fixed_size(spark, monkeypatch):
    """join and both group-bys lie in one exchange of each side."""
    monkeypatch.setattr(queries, "partitions_for", lambda df: 77)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(QUERIES["a13_products_per_order"](spark, SF))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange hashpartitioning") == plan.count(", 77), REPARTITION_BY_NUM") == 2
