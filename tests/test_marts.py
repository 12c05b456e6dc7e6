import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark import fixtures as fx
from tidemark.plans import customer as cu
from tidemark.plans import inventory as inv
from tidemark.plans import supply as su

D = dt.date


def test_customer_without_orders_and_text_user_ids(spark):
    customers = spark.createDataFrame([(1, " Ann "), (2, "Bob"), (3, "Cy")], "customer_id bigint, customer_name string")
    orders = spark.createDataFrame(
        [
            (10, 1, Decimal("6000.00"), D(2020, 1, 1)),
            (10, 1, Decimal("6000.00"), D(2020, 1, 1)),  # duplicate order row: counted once
            (11, 1, Decimal("4000.00"), D(2020, 6, 1)),
            (12, 3, Decimal("999.99"), None),
        ],
        "order_id bigint, customer_id bigint, order_amount decimal(18,2), order_date date",
    )
    reviews = spark.createDataFrame(
        [(1, "1", 5), (2, "1", 4), (3, "abc", 1), (4, None, 3)], "review_id bigint, user_id string, rating int"
    )
    out = {r.customer_id: r for r in cu.customer_360(customers, orders, reviews, as_of=D(2021, 1, 1)).collect()}
    a, b, c = out[1], out[2], out[3]
    assert a.customer_name == "Ann" and a.total_orders == 2 and a.lifetime_value == Decimal("10000.00")
    assert a.customer_segment == "platinum" and a.avg_review_rating == Decimal("4.500000") and a.total_reviews == 2
    assert a.customer_tenure_days == 366 and a.days_since_last_order == 214
    assert b.total_orders is None and b.lifetime_value is None and b.customer_segment == "bronze"
    assert b.total_reviews is None
    assert c.customer_segment == "bronze" and c.last_order_date is None and c.days_since_last_order is None


def test_customer_360_without_reviews_has_no_review_columns(spark):
    customers = spark.createDataFrame([(1, "A")], "customer_id bigint, customer_name string")
    orders = spark.createDataFrame([(1, 1, Decimal("1"), D(2020, 1, 1))], "order_id bigint, customer_id bigint, order_amount decimal(18,2), order_date date")
    cols = cu.customer_360(customers, orders).columns
    assert "avg_review_rating" not in cols and cols[-2:] == ["_etl_loaded_at", "_etl_row_hash"]


def test_order_rank_ties_broken_by_order_id(spark):
    orders = spark.createDataFrame(
        [(2, 7, 1, Decimal(1), D(2020, 5, 1)), (1, 7, 1, Decimal(1), D(2020, 5, 1)), (3, 7, 2, Decimal(1), D(2020, 1, 1))],
        "order_id bigint, customer_id bigint, product_id bigint, order_amount decimal(18,2), order_date date",
    )
    products = spark.createDataFrame([(1, "p1"), (1, "p1-dup"), (2, "p2")], "product_id bigint, product_name string")
    e = cu.order_enriched(orders, products)
    got = {r.order_id: (r.order_rank, r.product_name, r.order_dow) for r in e.collect()}
    assert e.count() == 3  # duplicate product rows do not fan out
    assert got[1][0] == 1 and got[2][0] == 2 and got[3][0] == 3
    assert got[1][1] == "p1" and got[1][2] == 6  # 2020-05-01 is a Friday; 1 = Sunday


def _po(spark, rows, extra=""):
    return spark.createDataFrame(
        rows,
        "po_id bigint, material_id bigint, order_date date, received_date date, quantity_ordered int, "
        "quantity_received int, updated_at timestamp" + extra,
    )


def test_supplier_scorecard_edges(spark):
    ts = dt.datetime(2021, 1, 1)
    po = _po(
        spark,
        [
            (1, 100, D(2020, 1, 1), D(2020, 1, 11), 10, 10, ts),  # received on the expected day: on time
            (2, 100, D(2020, 1, 1), D(2020, 1, 12), 10, 9, ts),  # one day late, short
            (2, 100, D(2020, 1, 1), D(2020, 1, 30), 10, 9, dt.datetime(2020, 1, 1)),  # older version: ignored
            (3, 100, D(2020, 2, 1), None, 5, None, ts),  # open: counts as on time
            (4, 999, D(2020, 3, 1), D(2020, 3, 2), 1, 1, ts),  # unknown material -> NULL supplier
        ],
    )
    materials = spark.createDataFrame(
        [(100, Decimal("2.50"), 7, 10, 2001, 1), (100, Decimal("3.00"), 7, 10, 2001, 2)],
        "material_id bigint, unit_price decimal(18,2), supplier_id bigint, lead_time_days int, year int, month int",
    )
    suppliers = spark.createDataFrame([(7, "S7")], "supplier_id bigint, supplier_name string")
    base = su.po_base(po, materials, suppliers)
    assert base.count() == 4
    sc = {r.supplier_id: r for r in su.supplier_performance(base, as_of=D(2021, 1, 1)).collect()}
    s7, none = sc[7], sc[None]
    assert s7.total_orders == 3 and s7.total_spend == Decimal("75.00")  # latest material price 3.00
    assert s7.late_deliveries == 1 and s7.late_delivery_rate == Decimal("0.333333")
    assert s7.late_delivery_rate_received == Decimal("0.500000")
    assert s7.on_time_rate == Decimal("0.666667") and s7.supplier_tier == "under_review"
    assert s7.short_shipments == 1 and s7.unique_materials == 1
    assert s7.avg_delivery_variance_days == Decimal("0.500000")
    assert none.supplier_name is None and none.total_orders == 1 and none.total_spend is None


def test_po_with_its_own_supplier_column_uses_the_materials_supplier(spark):
    po = _po(spark, [(1, 100, D(2020, 1, 1), D(2020, 1, 2), 1, 1, dt.datetime(2021, 1, 1), 55)], ", supplier_id bigint")
    materials = spark.createDataFrame([(100, Decimal("1"), 7, 0, 2001, 1)], "material_id bigint, unit_price decimal(18,2), supplier_id bigint, lead_time_days int, year int, month int")
    suppliers = spark.createDataFrame([(7, "S7"), (55, "S55")], "supplier_id bigint, supplier_name string")
    base = su.po_base(po, materials, suppliers)
    r = base.first()
    assert r.supplier_id == 7 and r.po_supplier_id == 55 and r.supplier_name == "S7"
    assert su.supplier_performance(base).count() == 1
    assert su.material_consumption(base).count() == 1


def test_inventory_snapshot_totals_and_flags(spark):
    invdf = spark.createDataFrame(
        [(1, 10, 1, 0, None, Decimal("2.00"), D(2020, 1, 1)), (2, 11, 1, 5, 5, Decimal("1.00"), D(2020, 1, 1)),
         (3, 12, 2, 30, 5, Decimal("1.00"), None), (3, 12, 2, 30, 5, Decimal("1.00"), None)],
        "inventory_id bigint, product_id bigint, warehouse_id int, quantity_on_hand int, reorder_level int, unit_cost decimal(18,2), last_restock_date date",
    )
    products = spark.createDataFrame([(10, "a"), (11, "b")], "product_id bigint, product_name string")
    wh = spark.createDataFrame([(1, "W1")], "warehouse_id int, warehouse_name string")
    out = {r.inventory_id: r for r in inv.inventory_snapshot(invdf, products, wh).collect()}
    assert len(out) == 3
    assert out[1].stock_health == "out_of_stock" and out[1].needs_reorder is False
    assert out[2].stock_health == "low_stock" and out[2].needs_reorder is True
    assert out[3].stock_health == "overstock" and out[3].warehouse_name is None
    assert out[1].warehouse_total_value == Decimal("5.00") and out[1].warehouse_sku_count == 2
    assert out[3].warehouse_total_value == Decimal("30.00") and out[3].warehouse_sku_count == 1


def test_invariants_on_testdata(spark, sf_small):
    d = fx.domain(spark, sf_small, "purchase_orders", "raw_materials", "suppliers")
    base = su.po_base(d["purchase_orders"], d["raw_materials"], d["suppliers"])
    n_po = d["purchase_orders"].select("po_id").distinct().count()
    mc = su.material_consumption(base)
    sp = su.supplier_performance(base)
    assert mc.count() == n_po
    assert sp.agg(F.sum("total_orders")).first()[0] == n_po
    c = fx.customers(spark, sf_small)
    assert cu.customer_360(c, fx.orders(spark, sf_small)).count() == c.select("customer_id").distinct().count()


def test_typed_review_key_matches_string_comparison(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    texts = st.one_of(
        st.none(),
        st.integers(-20, 20).map(str),
        st.sampled_from(["007", " 7", "+7", "7 ", "abc", "", "-0", "1e1", "9223372036854775808"]),
    )

    @settings(max_examples=15, deadline=None)
    @given(st.lists(st.integers(-20, 20), max_size=6), st.lists(texts, max_size=6))
    def check(keys, users):
        left = spark.createDataFrame([(k,) for k in keys], "customer_id bigint")
        right = spark.createDataFrame([(u,) for u in users], "user_id string")
        typed = cu.text_key_as(right, "user_id", left.schema["customer_id"].dataType)
        got = sorted(left.join(typed, left["customer_id"] == typed["__tm_uid"]).select("customer_id", "user_id").collect())
        want = sorted(left.join(right, left["customer_id"].cast("string") == right["user_id"]).collect())
        assert got == want

    check()


def test_marts_accept_timestamp_order_dates(spark, sf_small):
    """DATE, TIMESTAMP and TIMESTAMP_NTZ order dates give the same day-level results."""
    d = fx.domain(spark, sf_small, "customers", "orders", "products", "purchase_orders", "raw_materials", "suppliers")
    results = {}
    for kind in ("date", "timestamp", "timestamp_ntz"):
        orders = d["orders"].withColumn("order_date", F.col("order_date").cast(kind))
        po = d["purchase_orders"].withColumn("order_date", F.col("order_date").cast(kind))
        c = cu.customer_360(d["customers"], orders).select(
            "customer_id", "customer_tenure_days", "days_since_last_order", "customer_segment"
        )
        r = cu.order_time_features(orders).select("order_id", "order_year", "order_month", "order_dow", "order_quarter")
        base = su.po_base(po, d["raw_materials"], d["suppliers"])
        m = su.material_consumption(base).select("po_id", "delivery_variance_days", "is_late", "rolling_90d_spend", "order_quarter")
        results[kind] = (sorted(c.collect()), sorted(r.collect()), sorted(m.collect()))
    assert results["date"] == results["timestamp"] == results["timestamp_ntz"]


def test_order_and_inventory_marts_keep_one_row_per_fact_key(spark, sf_small):
    d = fx.domain(spark, sf_small, "orders", "products", "inventory", "warehouses")
    e = cu.order_enriched(d["orders"], d["products"])
    assert e.count() == d["orders"].select("order_id").distinct().count() == e.select("order_id").distinct().count()
    s = inv.inventory_snapshot(d["inventory"], d["products"], d["warehouses"])
    assert s.count() == d["inventory"].select("inventory_id").distinct().count()
    # every customer's ranks are 1..n without gaps
    gaps = e.groupBy("customer_id").agg(F.max("order_rank").alias("m"), F.count("*").alias("n")).filter("m != n").count()
    assert gaps == 0


def test_rolling_from_priced_daily_quantities_equals_row_level(spark, sf_small):
    d = fx.domain(spark, sf_small, "purchase_orders", "raw_materials", "suppliers")
    po, mat, sup = su.po_parts(d["purchase_orders"], d["raw_materials"], d["suppliers"])
    base = su.join_base(po, mat, sup)
    generic = su.rolling_spend(base)
    priced = su.rolling_spend(base, rolling=su.material_rolling_spend(po, mat))
    key = lambda r: r.po_id
    assert sorted(generic.collect(), key=key) == sorted(priced.collect(), key=key)


def test_dimension_join_with_hot_key_split_equals_plain_join(spark, sf_small):
    from tidemark.plans.common import dim_latest, left_join_dim

    po = fx.purchase_orders(spark, sf_small).withColumn(
        "material_id", F.when(F.col("po_id") % 3 == 0, F.lit(7).cast("bigint")).otherwise(F.col("material_id"))
    )
    mat = dim_latest(fx.raw_materials(spark, sf_small), "material_id", ("year", "month"))
    plain = left_join_dim(po, mat, "material_id", "material")
    split = left_join_dim(po, mat, "material_id", "material", hot_source=po.select("material_id"), max_group_rows=100)
    assert split.columns == plain.columns
    assert "Union" not in split._jdf.queryExecution().executedPlan().toString()  # the fact is read once
    key = lambda r: (r.po_id, r.updated_at)
    assert sorted(split.collect(), key=key) == sorted(plain.collect(), key=key)


def test_hot_suppliers_found_through_counts_per_material(spark, sf_small):
    po = fx.purchase_orders(spark, sf_small).withColumn(
        "material_id", F.when(F.col("po_id") % 3 == 0, F.lit(7).cast("bigint")).otherwise(F.col("material_id"))
    )
    d = fx.domain(spark, sf_small, "raw_materials", "suppliers")
    p, mat, sup = su.po_parts(po, d["raw_materials"], d["suppliers"])
    hot = su.hot_purchase_keys(po.select("material_id"), mat, max_group_rows=500)
    supplier_of_7 = mat.filter("material_id = 7").first().supplier_id
    assert [r[0] for r in hot["supplier_id"].collect()] == [supplier_of_7]
    assert [r[0] for r in hot["material_id"].collect()] == [7]
    assert su.hot_purchase_keys(po.select("material_id"), mat) == {}  # fewer rows than one task takes
    nowhere = po.withColumn("material_id", F.lit(-5).cast("bigint"))  # unmatched: the NULL supplier
    assert [r[0] for r in su.hot_purchase_keys(nowhere.select("material_id"), mat, max_group_rows=500)["supplier_id"].collect()] == [None]
    from tidemark.plans.common import left_join_dim

    base = left_join_dim(p, mat, "material_id", "material")
    plain = left_join_dim(base, sup, "supplier_id", "supplier")
    split = left_join_dim(base, sup, "supplier_id", "supplier", hot=hot)
    key = lambda r: r.po_id
    assert sorted(split.collect(), key=key) == sorted(plain.collect(), key=key)


@pytest.mark.parametrize("price_type", ["double", "decimal(18,3)"])
def test_spend_is_summed_before_it_is_rounded(spark, price_type):
    """Three lines of 0.125: 0.375 shows as 0.38, the same by every path."""
    po = spark.createDataFrame([(i, 1, D(2020, 1, 1), None, 1, None) for i in range(3)], "po_id int, material_id int, order_date date, received_date date, quantity_ordered int, quantity_received int")
    mat = spark.createDataFrame([(1, 0.125, 9, 5)], "material_id int, unit_price double, supplier_id int, lead_time_days int").withColumn("unit_price", F.col("unit_price").cast(price_type))
    sup = spark.createDataFrame([(9, "s")], "supplier_id int, supplier_name string")
    p, m, s = su.po_parts(po, mat, sup)
    base = su.join_base(p, m, s)
    for rolling in (None, su.material_rolling_spend(p, m)):
        assert {str(r.rolling_90d_spend) for r in su.rolling_spend(base, rolling=rolling).collect()} == {"0.38"}
    assert str(su.supplier_performance(base).first().total_spend) == "0.38"


def test_tier_is_decided_on_counts(spark):
    from tidemark.functions.rules import tier_by_counts

    df = spark.createDataFrame([(2000001 - 100001, 2000001), (1900000, 2000000)], "ok bigint, n bigint")
    got = [r[0] for r in df.select(tier_by_counts(F.col("ok"), F.col("n"), F.lit(200000))).collect()]
    assert got == ["preferred", "strategic"]


def test_reviews_match_database_numerics(spark):
    customers = spark.createDataFrame([("7",), ("10",), ("0",)], "customer_id string").select(F.col("customer_id").cast("decimal(38,18)"))
    orders = spark.createDataFrame([], "order_id int, customer_id decimal(38,18), order_amount double, order_date date")
    reviews = spark.createDataFrame([(1, "7", 4), (2, "10", 5), (3, "0", 3), (4, "7.0", 1), (5, "07", 1)], "review_id int, user_id string, rating int")
    got = {int(r.customer_id): r.total_reviews for r in cu.customer_360(customers, orders, reviews).collect()}
    assert got == {7: 1, 10: 1, 0: 1}


def test_fine_quantities_are_not_rounded_before_the_product(spark):
    from tidemark.functions.stats import cost, exact_sum, quantity_type

    df = spark.createDataFrame([(0.125, 8.0), (3.0, 0.1)], "q double, p double")
    assert [str(r[0].normalize()) for r in df.select(cost("q", "p", quantity_type(df, "q"))).collect()] == ["1", "0.3"]
    assert str(df.agg(exact_sum(cost("q", "p", quantity_type(df, "q")))).first()[0]) == "1.30"
    whole = spark.createDataFrame([(3, 0.125)], "q int, p double")
    assert quantity_type(whole, "q").simpleString() == "decimal(17,2)" and str(whole.select(cost("q", "p")).first()[0].normalize()) == "0.375"


@pytest.mark.parametrize("kind", ["int", "decimal(12,2)", "double"])
def test_consumption_base_equals_sums_of_days_attached(spark, kind):
    """Windows over rows and sums of days give the same spend: NULL materials, days, quantities and prices, ties, prices of a purchase order's own."""
    rng = random.Random(4)
    day = dt.date(2024, 1, 1)
    rows = [
        (i, rng.choice([None, 1, 2, 3, 9]), rng.choice([None, *[day + dt.timedelta(days=d) for d in (0, 0, 1, 89, 90, 91, 200)]]), rng.choice([None, 1, 2, 7]), None, "2024-05-01")
        for i in range(200)
    ]
    po = spark.createDataFrame(rows, "po_id int, material_id int, order_date date, quantity_ordered int, received_date date, updated_at string")
    po = po.withColumn("quantity_ordered", F.col("quantity_ordered").cast(kind)).withColumn("quantity_received", F.col("quantity_ordered"))
    mat = spark.createDataFrame([(1, "m1", 1.25, 5, 3, "x"), (2, "m2", None, 6, 4, "y"), (3, "m3", 0.5, None, 5, "z")], "material_id int, material_name string, unit_price double, supplier_id int, lead_time_days int, updated_at string")
    sup = spark.createDataFrame([(5, "s5", "old", "2020"), (7, "s7", "new", "2021")], "supplier_id int, supplier_name string, material_name string, updated_at string")
    for orders in (po, po.withColumn("unit_price", F.lit(3.0)), po.withColumn("supplier_id", F.lit(7))):
        p, m, s = su.po_parts(orders, mat, sup)
        want = su.left_join_dim(su.left_join_dim(su.with_rolling_spend(p, m, 90), m, "material_id", "material"), s, "supplier_id", "supplier")
        for most in (su.WINDOW_ROWS, 10):  # 10: every material is a large one
            got = su.consumption_base(p, m, s, orders.select("material_id"), 90, most)
            assert got.columns == want.columns
            a, b = (x.withColumn(su.ROLLING, F.col(su.ROLLING).cast("decimal(38,2)")) for x in (got, want))
            assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    assert su.largest_material(po.select("material_id")) > 10 and su.largest_material(po.select("material_id").limit(0)) == 0
