"""Physical-plan properties of the registered queries: no Cartesian products or nested-loop
joins, no Python UDF evaluation in the hot path, and the item-grain merge shuffles its rows
only twice."""

import pytest

SF = "/root/testdata/sf0.001"
# tree fits run eagerly while the DataFrame is built
SKIP = {"b3_gbt_random_search", "b4_gbt_backtest", "b6_feature_importance", "b6_feature_subset_sweep", "b11_model_metrics"}
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "ExistingRDD"]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _names():
    from demandflow.plans.queries import QUERIES
    return [n for n in QUERIES if n not in SKIP]


@pytest.mark.parametrize("name", _names())
def test_no_cartesian_no_python(spark, name):
    from demandflow.plans.queries import QUERIES
    plan = _plan(QUERIES[name](spark, SF))
    bad = [op for op in FORBIDDEN if op in plan]
    assert not bad, f"{name}: {bad}"


def test_python_runs_only_in_the_nearest_neighbour_estimator(spark):
    from demandflow.operators.analysis import compute_mutual_information
    df = spark.createDataFrame([(i, float(i), float(i % 7)) for i in range(50)], "t int, x double, y double")
    knn = _plan(compute_mutual_information(df, "y", ["x"], "t", method="knn"))
    assert "FlatMapGroupsInPandas" in knn and "BatchEvalPython" not in knn
    binned = _plan(compute_mutual_information(df, "y", ["x"]))
    assert "Pandas" not in binned and "Python" not in binned


@pytest.fixture
def static_plans(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_period_table_reads_and_dedups_the_items_once(spark, static_plans, monkeypatch):
    """Both branches are rolled up from one written aggregate of the item rows."""
    from demandflow.operators import period
    from demandflow.plans.queries import period_table
    written = []
    keep = period.materialize
    monkeypatch.setattr(period, "materialize", lambda df: (written.append(df), keep(df))[1])
    rest = _plan(period_table(spark, SF))
    assert len(written) == 1
    once = _plan(written[0])
    assert once.count("l_extendedprice") and once.count("lineitem.parquet") == 1
    assert once.count("WindowGroupLimit") >= 1 and once.count("Window [row_number()") == 1
    assert "lineitem" not in rest and "row_number" not in rest


def test_previous_sales_read_the_items_once(spark, monkeypatch):
    from demandflow.operators import ranks
    from demandflow.plans.queries import QUERIES
    written = []
    keep = ranks.materialize
    monkeypatch.setattr(ranks, "materialize", lambda df: (written.append(df), keep(df))[1])
    rest = _plan(QUERIES["w8_item_price_changes"](spark, SF))
    assert len(written) == 1 and _plan(written[0]).count("lineitem.parquet") == 1 and "lineitem" not in rest


def test_state_filter_reaches_the_customers(spark, static_plans):
    from demandflow.plans.common import merged
    lines = _plan(merged(spark, SF, filter_state="NATION_11", top_k=7)).splitlines()
    state = [i for i, line in enumerate(lines) if "NATION_11" in line and "Filter" in line]
    dedup = [i for i, line in enumerate(lines) if "Window [row_number()" in line]
    # the rows and the list that selects them; the second one's customers may be a reused exchange
    assert len(dedup) == 2 and state and min(state) > dedup[0]
    above = max(i for i, line in enumerate(lines[:state[0]]) if "hashpartitioning(customer_id" in line)
    assert above > dedup[0]  # the filter lies below the join with the customers


def test_merge_shuffles_item_rows_twice(spark):
    """With broadcasts disabled the merge plan has one exchange on product_id and one on
    order_id over line items, and the deduplication reuses the order_id partitioning."""
    from demandflow.plans.common import merged
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(merged(spark, SF))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = plan.splitlines()
    dedup = [i for i, line in enumerate(lines) if "Window [row_number()" in line]
    assert len(dedup) == 1, plan
    below = lines[dedup[0] + 1:dedup[0] + 5]
    assert not any("Exchange" in line for line in below), "dedup should reuse the join partitioning"
    assert sum("hashpartitioning(order_id" in line for line in lines) == 2    # both sides of the order join
    assert sum("hashpartitioning(product_id" in line for line in lines) == 2  # both sides of the product join
