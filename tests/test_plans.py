"""Plan-shape checks: the physical strategies the marts are designed for."""

import re

from tidemark.queries import QUERIES


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_cartesian_products(spark, sf_small):
    for name in ["customer_360", "order_enriched", "inventory_snapshot", "material_consumption", "supplier_performance"]:
        p = _plan(QUERIES[name](spark, sf_small))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_inventory_totals_are_not_a_window(spark, sf_small):
    p = _plan(QUERIES["inventory_snapshot"](spark, sf_small))
    # the only windows are the row_number() of the deduplications
    for line in p.splitlines():
        if "Window [" in line:
            assert "row_number()" in line, line


def test_rolling_window_runs_on_daily_aggregate(spark, sf_small):
    p = _plan(QUERIES["rolling_90d_spend"](spark, sf_small))
    i = p.index("Window [sum(")
    assert "partial_sum" in p[i:]


def test_scans_are_pruned(spark, sf_small):
    p = _plan(QUERIES["customer_order_metrics"](spark, sf_small))
    orders_scan = [l for l in p.splitlines() if "FileScan parquet" in l and "o_orderkey" in l][0]
    assert "o_comment" not in orders_scan
    li_scan = [l for l in p.splitlines() if "FileScan parquet" in l and "l_orderkey" in l][0]
    assert "l_extendedprice" not in li_scan and "l_discount" not in li_scan


def test_incremental_filter_pushed_to_scan(spark, sf_small):
    p = _plan(QUERIES["incremental_filter"](spark, sf_small))
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThan(l_shipdate" in p


def test_split_rank_shuffles_rows_once(spark):
    """Sub-bucket ranking: the rows' exchange feeds both the window and the
    offset join (sort-merge); only the small offsets side is shuffled again."""
    import datetime as dt

    from pyspark.sql import functions as F

    from tidemark.operators.windows import split_rank
    from tidemark.plans.customer import recency_order, recency_split

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(1000).select(
            (F.col("id") % 3).alias("customer_id"),
            F.col("id").alias("order_id"),
            F.date_add(F.lit(dt.date(2020, 1, 1)), (F.col("id") % 40).cast("int")).alias("order_date"),
        )
        plan = split_rank(df, ["customer_id"], recency_order(), "r", recency_split())._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    lines = plan.splitlines()
    j = next(i for i, l in enumerate(lines) if "SortMergeJoin" in l)
    child_prefix = " " * (lines[j].index("SortMergeJoin") - 3 + 3) + ":"
    left = [l for l in lines[j + 1:] if l.startswith(child_prefix)]
    assert "Window [row_number()" in left[0]  # the join reads the window output directly
    assert sum("Exchange" in l for l in left) == 1  # the rows' only shuffle


def test_inventory_totals_do_not_repeat_dimension_joins(spark, sf_small):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = QUERIES["inventory_snapshot"](spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # one sort-merge join with products: its inventory side and its products side
    assert len(re.findall(r"Exchange hashpartitioning\(product_id#\d+L?,", plan)) == 2


def test_rolling_spend_repeats_no_fact_level_join(spark, sf_small):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = QUERIES["material_consumption"](spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # one sort-merge join with suppliers (purchase-order side + supplier side)
    assert len(re.findall(r"Exchange hashpartitioning\(supplier_id#\d+L?,", plan)) == 2


def test_marts_without_hot_keys_carry_no_salt(spark, sf_small):
    """No key of the small tables is hot: plain joins and windows, each fact read for its own columns only."""
    for name in ("order_enriched", "inventory_snapshot", "supplier_performance", "material_consumption"):
        plan = QUERIES[name](spark, sf_small)._jdf.queryExecution().executedPlan().toString()
        assert "__tm_piece" not in plan and "__tm_h0" not in plan, name


def test_no_python_evaluation_in_any_query(spark, sf_small):
    """Every registered query stays on the JVM: no Python UDF / pandas nodes."""
    for name, q in QUERIES.items():
        plan = q(spark, sf_small)._jdf.queryExecution().executedPlan().toString()
        for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF"):
            assert node not in plan, (name, node)


def test_trailing_spend_is_attached_before_the_joins(spark, sf_small):
    """The rows shuffled by material and day carry no column of a material, and the result is that of the joined base."""
    from tidemark import fixtures as fx
    from tidemark.plans import supply as su

    d = fx.domain(spark, sf_small, "purchase_orders", "raw_materials", "suppliers")
    po, mat, sup = su.po_parts(d["purchase_orders"], d["raw_materials"], d["suppliers"])
    with_spend = su.with_rolling_spend(po, mat)
    assert with_spend.columns == [*po.columns, su.ROLLING]
    got = QUERIES["material_consumption"](spark, sf_small).drop("_etl_loaded_at")
    want = su.material_consumption(su.join_base(po, mat, sup), rolling=su.material_rolling_spend(po, mat)).drop("_etl_loaded_at")
    assert got.schema == want.schema and got.exceptAll(want).isEmpty() and got.count() == want.count()


def test_consumption_shuffles_purchase_orders_by_material_once(spark, sf_small):
    """The trailing sum and the join share one shuffle of the rows, suppliers are joined to the materials."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = QUERIES["material_consumption"](spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # purchase orders; materials, once deduplicated and once with their suppliers
    assert len(re.findall(r"Exchange hashpartitioning\(material_id#\d+L?,", plan)) == 3
    assert not re.findall(r"Exchange hashpartitioning\([^)]*__tm_day", plan) and plan.count("SortMergeJoin") == 2
