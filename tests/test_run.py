import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tidemark import fixtures as fx
from tidemark.plans.run import LoadPlan, MissingInputs, Params, Target, build, check_inputs, run
from tidemark.session import scratch_path
from tidemark.sinks.tables import read_current
from tidemark.streaming.ingest import ingest_new_files


def test_missing_inputs_are_reported_together():
    with pytest.raises(MissingInputs) as e:
        check_inputs(["inventory_snapshot", "supplier_performance"], {"products"})
    msg = str(e.value)
    assert "inventory" in msg and "warehouses" in msg and "purchase_orders" in msg


def test_run_stages_and_loads_every_mart(spark, sf_small):
    inputs = fx.domain(spark, sf_small)
    work = scratch_path(spark, "run")
    out = scratch_path(spark, "targets")
    plan = LoadPlan(
        out,
        targets={
            "customer_360": Target(os.path.join(out, "customer_profiles"), "merge", ("customer_id",)),
            "order_enriched": Target(os.path.join(out, "order_rows"), "append"),
        },
    )
    counts = run(spark, inputs, work, plan, batch_id=1)
    assert set(counts) == {"customer_360", "order_enriched", "inventory_snapshot", "material_consumption", "supplier_performance"}
    assert counts["customer_360"] == inputs["customers"].count()
    assert read_current(spark, os.path.join(out, "customer_profiles")).count() == counts["customer_360"]
    assert spark.read.parquet(os.path.join(out, "order_rows")).count() == counts["order_enriched"]
    assert spark.read.parquet(os.path.join(out, "SUPPLIER_PERFORMANCE")).count() == counts["supplier_performance"]
    # a second run of the same batch leaves one copy of the appended facts and one row per merged key
    run(spark, inputs, scratch_path(spark, "run2"), plan, marts=["customer_360", "order_enriched"], batch_id=1)
    assert spark.read.parquet(os.path.join(out, "order_rows")).count() == counts["order_enriched"]
    assert read_current(spark, os.path.join(out, "customer_profiles")).count() == counts["customer_360"]


def test_purchasing_marts_share_one_base(spark, sf_small):
    marts = build(fx.domain(spark, sf_small), ["material_consumption", "supplier_performance"], Params())
    total = marts["supplier_performance"].agg(F.sum("total_orders")).first()[0]
    assert total == marts["material_consumption"].count()


def test_streaming_ingest_loads_only_new_files(spark):
    src = scratch_path(spark, "landing")
    tgt = scratch_path(spark, "ingested")
    ckpt = scratch_path(spark, "ingest_ckpt")
    schema = "k bigint, ts timestamp_ntz"
    from pyspark.sql.types import StructType

    st = StructType.fromDDL(schema)
    spark.createDataFrame([(1, dt.datetime(2020, 1, 1)), (2, dt.datetime(2020, 1, 2))], st).coalesce(1).write.mode("append").parquet(src)
    assert ingest_new_files(spark, src, "parquet", st, tgt, ckpt) == 1
    spark.createDataFrame([(3, dt.datetime(2020, 1, 3))], st).coalesce(1).write.mode("append").parquet(src)
    assert ingest_new_files(spark, src, "parquet", st, tgt, ckpt) == 1
    assert ingest_new_files(spark, src, "parquet", st, tgt, ckpt) == 0
    got = sorted((r.k, r.batch_id) for r in spark.read.parquet(tgt).collect())
    assert [k for k, _ in got] == [1, 2, 3] and len({b for _, b in got}) == 2


def test_staged_clean_orders_give_the_same_marts(spark, sf_small):
    d = fx.domain(spark, sf_small, "customers", "orders", "products")
    from tidemark.plans import customer as cu

    clean = cu.clean_orders(d["orders"])
    a = cu.order_enriched(d["orders"], d["products"]).drop("_etl_loaded_at")
    b = cu.order_enriched(clean, d["products"], orders_clean=True).drop("_etl_loaded_at")
    assert sorted(a.collect(), key=lambda r: r.order_id) == sorted(b.collect(), key=lambda r: r.order_id)
    at = {"as_of": dt.date(2002, 1, 1), "loaded_at": dt.datetime(2002, 1, 1)}
    c1 = cu.customer_360(d["customers"], d["orders"], **at)
    c2 = cu.customer_360(d["customers"], clean, orders_clean=True, **at)
    assert sorted(c1.collect(), key=lambda r: r.customer_id) == sorted(c2.collect(), key=lambda r: r.customer_id)


def test_streaming_ingest_csv_with_batch_transform(spark):
    from pyspark.sql.types import StructType

    from tidemark.functions.text import trim_strings
    from tidemark.operators.dedup import dedup_latest

    src = scratch_path(spark, "landing_csv")
    tgt = scratch_path(spark, "ingested_csv")
    ckpt = scratch_path(spark, "ingest_csv_ckpt")
    st = StructType.fromDDL("k bigint, name string, ts timestamp_ntz")
    rows = [(1, " a ", dt.datetime(2020, 1, 1)), (1, "b", dt.datetime(2020, 1, 2)), (2, "c ", dt.datetime(2020, 1, 1))]
    spark.createDataFrame(rows, st).coalesce(1).write.option("header", "true").mode("append").csv(src)

    def clean(batch):
        return dedup_latest(trim_strings(batch), ["k"], ["ts"])

    assert ingest_new_files(spark, src, "csv", st, tgt, ckpt, transform=clean) == 1
    got = sorted((r.k, r.name) for r in spark.read.parquet(tgt).collect())
    assert got == [(1, "b"), (2, "c")]


def test_run_config_from_file_datasets(spark, sf_small):
    from tidemark.plans.run import run_config

    landing = scratch_path(spark, "landing_cfg")
    datasets = []
    for name, df in fx.domain(spark, sf_small, "customers", "orders", "products", "product_reviews").items():
        fmt = "json" if name == "product_reviews" else "parquet"
        path = os.path.join(landing, name)
        df.write.format(fmt).save(path)
        ds = {"name": name, "path": path, "file_format": fmt}
        if fmt == "json":
            ds["schema"] = {"fields": [
                {"name": "review_id", "type": "long"}, {"name": "product_id", "type": "long"},
                {"name": "user_id", "type": "string"}, {"name": "rating", "type": "integer"},
                {"name": "verified", "type": "boolean"}, {"name": "review_date", "type": "date"},
            ]}
        datasets.append(ds)
    out = scratch_path(spark, "targets_cfg")
    cfg = {
        "datasets": datasets,
        "work_dir": scratch_path(spark, "work_cfg"),
        "marts": ["customer_360", "order_enriched"],
        "as_of": "2002-01-01",
        "batch_id": 7,
        "load": {"base_path": out, "write_mode": "overwrite", "tables": [
            {"source": "customer_360", "target": os.path.join(out, "customer_profiles"), "write_mode": "merge", "merge_keys": ["customer_id"]},
            {"source": "order_enriched", "target": os.path.join(out, "order_rows"), "write_mode": "append"},
        ]},
    }
    counts = run_config(spark, cfg)
    assert counts["customer_360"] == fx.customers(spark, sf_small).count()
    assert read_current(spark, os.path.join(out, "customer_profiles")).filter("avg_review_rating IS NOT NULL").count() > 0
    assert {r.batch_id for r in spark.read.parquet(os.path.join(out, "order_rows")).select("batch_id").distinct().collect()} == {7}


def test_run_config_advances_marks_after_a_successful_run(spark, sf_small):
    from pyspark.sql import functions as F

    from tidemark.plans.run import run_config
    from tidemark.sources.incremental import WatermarkStore

    landing = scratch_path(spark, "landing_inc")
    d = fx.domain(spark, sf_small, "purchase_orders", "raw_materials", "suppliers")
    po = d["purchase_orders"]
    mark = "2000-01-01 00:00:00"
    po.filter(F.col("updated_at") <= F.lit(mark).cast("timestamp_ntz")).write.parquet(os.path.join(landing, "po"))
    for n in ("raw_materials", "suppliers"):
        d[n].write.parquet(os.path.join(landing, n))
    store_path = scratch_path(spark, "marks_cfg")

    def cfg(batch):
        return {
            "datasets": [
                {"name": "purchase_orders", "path": os.path.join(landing, "po"), "incremental_column": "updated_at"},
                {"name": "raw_materials", "path": os.path.join(landing, "raw_materials")},
                {"name": "suppliers", "path": os.path.join(landing, "suppliers")},
            ],
            "watermark_store": store_path,
            "work_dir": scratch_path(spark, f"work_inc{batch}"),
            "marts": ["material_consumption"],
            "batch_id": batch,
            "load": {"base_path": scratch_path(spark, "out_inc"), "tables": [
                {"source": "material_consumption", "target": os.path.join(landing, "FACT"), "write_mode": "append"}]},
        }

    with pytest.raises(ValueError):
        run_config(spark, {**cfg(1), "batch_id": None})
    first = run_config(spark, cfg(1))["material_consumption"]
    store = WatermarkStore(spark, store_path)
    assert store.get("purchase_orders") == "2000-01-01 00:00:00"
    # new versions arrive; the second run reads only them
    po.filter(F.col("updated_at") > F.lit(mark).cast("timestamp_ntz")).write.mode("append").parquet(os.path.join(landing, "po"))
    profile = {}
    second = run_config(spark, cfg(2), profile)["material_consumption"]
    newest = po.agg(F.max("updated_at")).first()[0]
    assert store.get("purchase_orders") == str(newest)
    assert profile["material_consumption"]["po_id"] == 0 and profile["material_consumption"]["received_date"] > 0
    # one row per purchase order, the values of a full run
    got = read_current(spark, os.path.join(landing, "FACT")).drop("_etl_loaded_at")
    full = build(d, ["material_consumption"])["material_consumption"].drop("_etl_loaded_at")
    key = lambda r: r.po_id
    assert sorted(got.select(*full.columns).collect(), key=key) == sorted(full.collect(), key=key)
    assert first > 0 and second <= full.count()
    # a third run without new rows writes nothing and leaves the mark
    assert run_config(spark, cfg(3))["material_consumption"] == 0
    assert store.get("purchase_orders") == str(newest)


def test_incremental_orders_that_change_and_move(spark):
    """Updates, a moved order, an overlap and rows without a mark: equal to a full run after every slice."""
    from tidemark.plans.run import run_config

    base, out = scratch_path(spark, "landing_moves"), scratch_path(spark, "out_moves")
    schema = "order_id bigint, customer_id bigint, product_id bigint, order_amount decimal(18,3), order_date date, updated_at timestamp_ntz"
    day = lambda n: dt.date(2020, 1, n)
    at = lambda n: dt.datetime(2020, 2, n)
    slices = [
        [(1, 10, 5, 1, day(1), at(1)), (2, 10, 5, 1, day(2), at(1)), (3, 20, 6, 1, day(1), at(2)), (9, 30, 6, 1, day(1), None)],
        [(1, 20, 5, 2, day(3), at(3)), (4, 10, 6, 1, day(4), at(4))],  # order 1 moves to customer 20
        [(5, 30, 5, 1, day(9), at(5)), (2, 10, 5, 7, day(2), at(5)), (8, 20, 5, 1, day(8), None)],
    ]
    products = spark.createDataFrame([(5, "five"), (6, "six")], "product_id bigint, product_name string")
    products.write.parquet(f"{base}/products")
    seen = []
    for batch, rows in enumerate(slices, start=1):
        seen += rows
        spark.createDataFrame([(*r[:3], __import__("decimal").Decimal(r[3]), *r[4:]) for r in rows], schema).write.mode("append").parquet(f"{base}/orders")
        run_config(spark, {
            "datasets": [{"name": "orders", "path": f"{base}/orders", "incremental_column": "updated_at", "overlap_seconds": 86400}, {"name": "products", "path": f"{base}/products"}],
            "watermark_store": f"{base}/marks", "work_dir": scratch_path(spark, "work_moves"), "marts": ["order_enriched"],
            "loaded_at": "2020-03-01T00:00:00", "batch_id": 100 - batch,
            "load": {"base_path": out, "tables": [{"source": "order_enriched", "target": f"{out}/t", "write_mode": "append"}]},
        })
        full = build({"orders": spark.read.parquet(f"{base}/orders"), "products": products}, ["order_enriched"], Params(loaded_at=dt.datetime(2020, 3, 1)))["order_enriched"]
        got = read_current(spark, f"{out}/t").select(*full.columns)
        assert sorted(got.collect()) == sorted(full.collect())


def test_defaults_are_the_current_day_and_rules_can_be_set(spark):
    before = dt.datetime.now(dt.timezone.utc).date()
    assert before <= Params().as_of <= dt.datetime.now(dt.timezone.utc).date()
    inv = spark.createDataFrame([(1, 1, 1, 30, 10, 1.0, before)], "inventory_id int, product_id int, warehouse_id int, quantity_on_hand int, reorder_level int, unit_cost double, last_restock_date date")
    products = spark.createDataFrame([(1,)], "product_id int")
    warehouses = spark.createDataFrame([(1,)], "warehouse_id int")
    d = {"inventory": inv, "products": products, "warehouses": warehouses}
    row = build(d, ["inventory_snapshot"])["inventory_snapshot"].first()
    assert row.days_since_restock in (0, 1) and row.stock_health == "healthy"
    assert build(d, ["inventory_snapshot"], Params(overstock_factor=2))["inventory_snapshot"].first().stock_health == "overstock"


def test_files_are_read_in_place_and_pruned(spark):
    from tidemark.plans.run import run_config

    base = scratch_path(spark, "landing_pruned")
    rows = [(i, i % 3, 1, 5, 1, 2000 + i % 2) for i in range(20)]
    spark.createDataFrame(rows, "inventory_id int, product_id int, warehouse_id int, quantity_on_hand int, reorder_level int, year int").selectExpr(
        "*", "1.5D AS unit_cost", "DATE '2020-01-01' AS last_restock_date").write.partitionBy("year").parquet(f"{base}/inventory")
    spark.range(3).selectExpr("CAST(id AS INT) product_id").write.parquet(f"{base}/products")
    spark.range(3).selectExpr("CAST(id AS INT) warehouse_id").write.parquet(f"{base}/warehouses")
    work = scratch_path(spark, "work_pruned")
    n = run_config(spark, {
        "datasets": [{"name": "inventory", "path": f"{base}/inventory", "partitions": {"year": [2001]}}, {"name": "products", "path": f"{base}/products"}, {"name": "warehouses", "path": f"{base}/warehouses"}],
        "work_dir": work, "marts": ["inventory_snapshot"], "load": {"base_path": f"{base}/out"},
    })
    assert n == {"inventory_snapshot": 10} and not os.path.exists(os.path.join(work, "raw"))


def test_changed_dimension_keys_reach_their_facts(spark):
    from tidemark.plans import run as r

    fact = r.FACTS["material_consumption"]
    po = spark.createDataFrame([(1, 10), (2, 20), (3, 30), (4, None)], "po_id int, material_id int")
    mats = spark.createDataFrame([(10, 7), (20, 8), (30, 8)], "material_id int, supplier_id int")
    keys = lambda col, *ks: spark.createDataFrame([(k,) for k in ks], f"{col} int")
    d = {"purchase_orders": po, "raw_materials": mats}
    got = lambda changed: sorted({x.po_id for x in r.rows_of_changed_dims(d, fact, changed).collect()})
    assert got({"raw_materials": keys("material_id", 10)}) == [1]
    assert got({"suppliers": keys("supplier_id", 8)}) == [2, 3]
    assert got({"raw_materials": keys("material_id", 10, None), "suppliers": keys("supplier_id", 8)}) == [1, 2, 3, 4]
    assert got({"raw_materials": keys("material_id"), "suppliers": None}) == [1, 2, 3, 4]
    assert r.rows_of_changed_dims(d, fact, {}) is None


def test_a_price_change_alone_rebuilds_its_rows(spark):
    """One old order of material A; then only A's price changes and an order of B arrives: the target equals a full run."""
    from tidemark.plans.run import run_config

    land, out = scratch_path(spark, "dimland"), scratch_path(spark, "dimout")
    po_type = "po_id int, material_id int, quantity_ordered int, order_date date, updated_at timestamp_ntz, received_date date, quantity_received int, po_status string"
    day = dt.date(2024, 1, 1)
    po = lambda i, m, at: [(i, m, 10, day, at, None, None, "open")]
    mat = lambda price: [(1, "A", "c", price, 5, 3, 2024, 1), (2, "B", "c", 1.0, 5, 3, 2024, 1)]
    mat_type = "material_id int, material_name string, material_category string, unit_price double, supplier_id int, lead_time_days int, year int, month int"
    spark.createDataFrame([(5, "S", 1)], "supplier_id int, supplier_name string, supplier_nation_id int").write.parquet(f"{land}/suppliers")
    costs = {}
    for batch, (rows, price) in enumerate([(po(1, 1, dt.datetime(2024, 1, 2)), 2.0), (po(2, 2, dt.datetime(2024, 1, 3)), 3.0)], start=1):
        spark.createDataFrame(rows, po_type).write.mode("append").parquet(f"{land}/purchase_orders")
        spark.createDataFrame(mat(price), mat_type).write.mode("overwrite").parquet(f"{land}/raw_materials")
        run_config(spark, {
            "datasets": [{"name": n, "path": f"{land}/{n}", **({"incremental_column": "updated_at"} if n == "purchase_orders" else {})} for n in ("purchase_orders", "raw_materials", "suppliers")],
            "watermark_store": f"{land}/marks", "work_dir": scratch_path(spark, "dimwork"), "marts": ["material_consumption"],
            "loaded_at": "2024-06-30T00:00:00", "batch_id": batch, "load": {"base_path": out},
        })
        got = read_current(spark, f"{out}/MATERIAL_CONSUMPTION").collect()
        costs[batch] = {r.po_id: float(r.line_cost) for r in got}
    assert costs == {1: {1: 20.0}, 2: {1: 30.0, 2: 10.0}}


def test_a_run_that_is_wholly_or_mostly_new_narrows_nothing(spark, sf_small, monkeypatch):
    from tidemark.plans import run as r

    seen, real = [], r._key_set
    monkeypatch.setattr(r, "_key_set", lambda df, column, name: (seen.append(name), real(df, column, name))[1])
    history = spark.createDataFrame([(i, i % 5) for i in range(40)], "order_id bigint, customer_id bigint")
    fact = r.FACTS["order_enriched"]
    assert r.touched_history(history, history.filter("order_id >= 20"), fact).count() == 40
    assert seen == ["touched_keys"]
    assert r.touched_history(history, history.filter("order_id = 3"), fact).count() == 8
    assert seen[1:] == ["touched_keys", "touched_within", "touched_rows"]
    monkeypatch.setattr(r, "touched_history", lambda *_: pytest.fail("no mark: every row is new"))
    d = fx.domain(spark, sf_small, "orders", "products")
    assert r.build_affected(d, ["order_enriched"], Params(), {"orders": None})["order_enriched"].count() == d["orders"].count()


def test_a_run_whose_rows_share_most_values_reads_the_history_whole(spark, monkeypatch):
    from tidemark.plans import run as r

    seen, real = [], r._key_set
    monkeypatch.setattr(r, "_key_set", lambda df, column, name: (seen.append(name), real(df, column, name))[1])
    history = spark.createDataFrame([(i, i % 5 if i % 5 else None) for i in range(40)], "order_id bigint, customer_id bigint")
    fact = r.FACTS["order_enriched"]
    assert r.touched_history(history, history.filter("order_id in (0, 1, 2)"), fact).count() == 40
    assert seen == ["touched_keys", "touched_within"]  # three of five customers, NULL among them, have most rows
    assert r.touched_history(history, history.filter("order_id in (0, 1)"), fact).count() == 16
    assert r.mostly_sharing(history, "customer_id", real(history.filter("order_id in (3, 8)"), "customer_id", "touched_within")) is False
