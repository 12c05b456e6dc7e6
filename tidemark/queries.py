"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Every query reads the testdata tables of ``sf_dir`` (through the domain
tables of ``tidemark.fixtures``) in full. Write/read queries perform their
round trip in a fresh folder under the shared ``spark.checkpoint.dir`` and
return a DataFrame over what was written.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import fixtures as fx
from tidemark.functions.hashing import add_audit_columns, row_hash
from tidemark.functions.text import trim_strings
from tidemark.operators.changes import row_changes
from tidemark.operators.dedup import dedup_latest
from tidemark.operators.quality import drop_nulls, table_profile
from tidemark.operators.windows import rank_within
from tidemark.plans import customer as cu
from tidemark.plans import inventory as inv
from tidemark.plans import supply as su
from tidemark.plans.common import dim_latest, left_join_dim
from tidemark.plans.run import FACTS, run_config
from tidemark.session import scratch_path
from tidemark.sinks.tables import PACKED, append_batch, read_current, stage, upsert_table, write_overwrite
from tidemark.sources.files import read_checked, read_dataset
from tidemark.sources.incremental import incremental_filter, new_watermark, typed_mark
from tidemark.sources.schema import load_schema, validate_schema

SCHEMAS = Path(__file__).parent / "sources" / "schemas"

# fixed values: parameters of the registered queries
AS_OF = dt.date(2002, 1, 1)  # the evaluation day and load instant
LOADED_AT = dt.datetime(2002, 1, 1, 0, 0, 0)
SEGMENT_THRESHOLDS = (3500000, 2500000, 1500000)  # spreads the testdata over all four segments
PO_MARK = dt.datetime(2000, 1, 1, 0, 0, 0)  # high-water mark on purchase_orders.updated_at
ORDER_MARK = dt.date(1997, 1, 1)  # high-water mark on orders.order_date
TOP_K = 3

Query = Callable[[SparkSession, str], DataFrame]


def _po_base(spark: SparkSession, sf: str, trim: bool = True) -> DataFrame:
    d = fx.domain(spark, sf, "purchase_orders", "raw_materials", "suppliers")
    return su.po_base(d["purchase_orders"], d["raw_materials"], d["suppliers"], trim=trim)


# ---- customer marts -------------------------------------------------------

def q_customer_order_metrics(spark, sf):
    return cu.customer_order_metrics(cu.clean_orders(fx.orders(spark, sf)))


def q_customer_review_metrics(spark, sf):
    return cu.customer_review_metrics(fx.product_reviews(spark, sf))


def q_customer_segment(spark, sf):
    return cu.customer_segments(fx.customers(spark, sf), fx.orders(spark, sf), SEGMENT_THRESHOLDS)


def q_customer_360(spark, sf):
    d = fx.domain(spark, sf, "customers", "orders", "product_reviews")
    return cu.customer_360(d["customers"], d["orders"], d["product_reviews"], as_of=AS_OF, loaded_at=LOADED_AT, thresholds=SEGMENT_THRESHOLDS)


def q_order_recency_rank(spark, sf):
    return cu.order_recency_rank(fx.orders(spark, sf))


def q_latest_orders_top3(spark, sf):
    return cu.latest_orders(fx.orders(spark, sf), TOP_K)


def q_order_time_features(spark, sf):
    return cu.order_time_features(fx.orders(spark, sf))


def q_order_enriched(spark, sf):
    return cu.order_enriched(fx.orders(spark, sf), fx.products(spark, sf), loaded_at=LOADED_AT)


# ---- inventory ------------------------------------------------------------

def q_stock_health(spark, sf):
    e = inv.stock_flags(inv.clean_inventory(fx.inventory(spark, sf)), as_of=AS_OF)
    return e.select("inventory_id", "warehouse_id", "quantity_on_hand", "reorder_level", "stock_value", "needs_reorder", "stock_health")


def q_warehouse_totals(spark, sf):
    return inv.warehouse_totals(inv.stock_flags(inv.clean_inventory(fx.inventory(spark, sf)), as_of=AS_OF))


def q_inventory_snapshot(spark, sf):
    d = fx.domain(spark, sf, "inventory", "products", "warehouses")
    return inv.inventory_snapshot(d["inventory"], d["products"], d["warehouses"], as_of=AS_OF, loaded_at=LOADED_AT)


# ---- purchasing -----------------------------------------------------------

def q_delivery_variance(spark, sf):
    b = su.delivery_columns(_po_base(spark, sf))
    return b.select("po_id", "material_id", "supplier_id", "expected_delivery_date", "delivery_variance_days", "is_late")


def _po_parts(spark: SparkSession, sf: str):
    """Deduplicated purchase orders, materials, suppliers, and the joined base."""
    d = fx.domain(spark, sf, "purchase_orders", "raw_materials", "suppliers")
    po, mat, sup = su.po_parts(d["purchase_orders"], d["raw_materials"], d["suppliers"])
    return po, mat, su.join_base(po, mat, sup, hot_source=d["purchase_orders"].select("material_id"))


def q_rolling_90d_spend(spark, sf):
    po, mat, base = _po_parts(spark, sf)
    return su.rolling_spend(base, rolling=su.material_rolling_spend(po, mat))


def q_material_consumption(spark, sf):
    d = fx.domain(spark, sf, "purchase_orders", "raw_materials", "suppliers")
    po, mat, sup = su.po_parts(d["purchase_orders"], d["raw_materials"], d["suppliers"])
    base = su.consumption_base(po, mat, sup, d["purchase_orders"].select("material_id"))
    return su.material_consumption(base, loaded_at=LOADED_AT)


def q_supplier_performance(spark, sf):
    return su.supplier_performance(_po_base(spark, sf), as_of=AS_OF, loaded_at=LOADED_AT)


def q_supplier_tier(spark, sf):
    return q_supplier_performance(spark, sf).select("supplier_id", "total_spend", "on_time_rate", "supplier_tier")


# ---- quality helpers ------------------------------------------------------

def q_dedup_latest(spark, sf):
    return dedup_latest(fx.purchase_orders(spark, sf), ["po_id"], ["updated_at"])


def q_drop_nulls(spark, sf):
    return drop_nulls(fx.orders(spark, sf), ["product_id", "order_date"])


def q_trim_strings(spark, sf):
    return trim_strings(fx.customers(spark, sf))


def q_row_hash(spark, sf):
    o = fx.orders(spark, sf)
    cols = list(o.columns)
    return add_audit_columns(o, LOADED_AT).select("*", row_hash(cols, strict=True).alias("row_hash_strict"))


def q_table_profile(spark, sf):
    return table_profile(fx.purchase_orders(spark, sf), "purchase_orders")


# ---- incremental ----------------------------------------------------------

def q_incremental_filter(spark, sf):
    return incremental_filter(fx.purchase_orders(spark, sf), "updated_at", PO_MARK)


def q_incremental_new_watermark(spark, sf):
    batch = incremental_filter(fx.purchase_orders(spark, sf), "updated_at", PO_MARK)
    return new_watermark(batch, "purchase_orders", "updated_at", PO_MARK)


def _two_slices(spark, sf, mart, source, column, mark, others, overlap_seconds=None, earlier=None, history=None, params=None):
    """Run ``run_config`` on the rows up to ``mark``, land the rest, run it again; the target.

    ``earlier``: per dimension, what its rows were in the first run; ``history``:
    the source's rows with their earlier versions."""
    landing, out, work = (scratch_path(spark, f"{folder}_{mart}") for folder in ("landing", "target", "work"))
    d = fx.domain(spark, sf, source, *others)
    if source == "orders":  # a join: computed once for both slices
        d[source] = stage(d[source], scratch_path(spark, f"source_{mart}"))
    if history:
        d[source] = history(d[source])
    mode = "append" if mart in FACTS else "overwrite"
    value = F.col(column)
    later = F.coalesce(value > F.lit(str(mark)).cast(d[source].schema[column].dataType), F.lit(False))
    datasets = [{"name": n, "path": f"{landing}/{n}"} for n in (source, *others)]
    datasets[0] |= {"incremental_column": column, **({"overlap_seconds": overlap_seconds} if overlap_seconds else {})}
    for batch, rows in enumerate((d[source].filter(~later), d[source].filter(later)), start=1):
        rows.write.mode("append").options(**PACKED).parquet(f"{landing}/{source}")
        for n in others:
            write_overwrite((earlier or {}).get(n, lambda x: x)(d[n]) if batch == 1 else d[n], f"{landing}/{n}")
        run_config(spark, {
            "datasets": datasets, "watermark_store": f"{landing}/marks", "work_dir": work,
            "marts": [mart], "as_of": AS_OF.isoformat(), "loaded_at": LOADED_AT.isoformat(), "batch_id": batch, "params": params or {},
            "load": {"base_path": out, "tables": [{"source": mart, "target": f"{out}/t", "write_mode": mode}]},
        })
    return read_current(spark, f"{out}/t")


def q_incremental_material_consumption(spark, sf):
    """Two slices with updated purchase orders and an overlap equal one full run."""
    return _two_slices(spark, sf, "material_consumption", "purchase_orders", "updated_at", PO_MARK, ("raw_materials", "suppliers"), 86400)


def q_incremental_order_enriched(spark, sf):
    """Later orders change the ranks of earlier ones: two slices equal one full run."""
    return _two_slices(spark, sf, "order_enriched", "orders", "order_date", ORDER_MARK, ("products",))


def q_incremental_product_change(spark, sf):
    """Products renamed, moved, and new between two runs: the rows of old orders follow."""

    def earlier(p):
        return p.filter("product_id % 7 != 0").withColumn("product_name", F.when(F.col("product_id") % 3 == 0, F.lit("old name")).otherwise(F.col("product_name")))

    return _two_slices(spark, sf, "order_enriched", "orders", "order_date", ORDER_MARK, ("products",), earlier={"products": earlier})


def _earlier_materials(m):
    price = F.when(F.col("material_id") % 3 == 0, F.col("unit_price") * 2).otherwise(F.col("unit_price")).cast(m.schema["unit_price"].dataType)
    return m.withColumn("unit_price", price)


def _earlier_suppliers(s):
    return s.filter("supplier_id % 5 != 0").withColumn("supplier_name", F.concat("supplier_name", F.when(F.col("supplier_id") % 2 == 0, F.lit(" (old)")).otherwise(F.lit(""))))


def q_incremental_price_change(spark, sf):
    """Prices, materials' suppliers and suppliers' rows change between two runs: old purchase orders follow."""
    return _two_slices(
        spark, sf, "material_consumption", "purchase_orders", "updated_at", PO_MARK, ("raw_materials", "suppliers"), 86400,
        earlier={"raw_materials": _earlier_materials, "suppliers": _earlier_suppliers},
    )


def q_incremental_customer_360(spark, sf):
    """Orders first land with other amounts, customers and days: the second run takes
    these out of the kept states, the ends of the days that go with them included."""

    def with_earlier_versions(orders):
        now = orders.withColumn("updated_at", F.col("order_date").cast("timestamp_ntz"))
        before = now.filter((F.col("order_date") > F.lit(ORDER_MARK)) & (F.col("order_id") % 3 == 0)).select(*[
            (F.col("order_amount") * 2).cast(f.dataType).alias(f.name) if f.name == "order_amount"
            else (F.col("customer_id") + F.col("order_id") % 2).cast(f.dataType).alias(f.name) if f.name == "customer_id"
            else F.date_sub("order_date", 3650).cast(f.dataType).alias(f.name) if f.name == "order_date"
            else F.lit(dt.datetime(1990, 1, 1)).cast("timestamp_ntz").alias(f.name) if f.name == "updated_at"
            else F.col(f.name)
            for f in now.schema.fields
        ])
        return now.unionByName(before)

    return _two_slices(
        spark, sf, "customer_360", "orders", "updated_at", ORDER_MARK, ("customers", "product_reviews"),
        history=with_earlier_versions, params={"segment_thresholds": list(SEGMENT_THRESHOLDS)},
    )


def q_incremental_supplier_performance(spark, sf):
    """Purchase orders are updated, prices change and suppliers are renamed between two
    runs: the scorecard from kept states equals one full run."""
    return _two_slices(
        spark, sf, "supplier_performance", "purchase_orders", "updated_at", PO_MARK, ("raw_materials", "suppliers"), 86400,
        earlier={"raw_materials": _earlier_materials, "suppliers": _earlier_suppliers},
    )


def q_run_config_customer_360(spark, sf):
    """The configured run over file datasets (ORC among them), merged into a target."""
    landing, out = scratch_path(spark, "landing_c360"), scratch_path(spark, "target_c360")
    d = fx.domain(spark, sf, "customers", "orders", "product_reviews")
    datasets = []
    for n, fmt in (("customers", "orc"), ("orders", "parquet"), ("product_reviews", "orc")):
        d[n].write.format(fmt).save(f"{landing}/{n}")
        datasets.append({"name": n, "path": f"{landing}/{n}", "file_format": fmt})
    run_config(spark, {
        "datasets": datasets, "work_dir": scratch_path(spark, "work_c360"), "marts": ["customer_360"],
        "as_of": AS_OF.isoformat(), "loaded_at": LOADED_AT.isoformat(), "params": {"segment_thresholds": list(SEGMENT_THRESHOLDS)},
        "load": {"base_path": out, "tables": [{"source": "customer_360", "target": f"{out}/c360", "write_mode": "merge", "merge_keys": ["customer_id"]}]},
    })
    return read_current(spark, f"{out}/c360")


def q_order_enriched_split(spark, sf):
    """The hot-key paths forced: every key above 5 rows is salted or ranked in pieces."""
    orders = cu.clean_orders(fx.orders(spark, sf))
    e = left_join_dim(orders, dim_latest(fx.products(spark, sf), "product_id"), "product_id", "product", hot_source=orders.select("product_id"), max_group_rows=5)
    return rank_within(
        e, ["customer_id"], cu.recency_order(), "order_rank", split=cu.recency_split(), hot_source=orders.select("customer_id"), max_group_rows=5
    ).select("order_id", "customer_id", "product_id", "product_name", "order_rank")


# ---- sinks (round trips) --------------------------------------------------

def _up_to_mark(po):
    """The rows that ``incremental_filter`` leaves out, those without a mark included."""
    return po.filter(~F.coalesce(F.col("updated_at") > typed_mark(po, "updated_at", PO_MARK), F.lit(False)))


def q_merge_into_overwritten(spark, sf):
    """A merge into a table that an overwrite wrote: its rows are the target."""
    po = fx.purchase_orders(spark, sf)
    path = scratch_path(spark, "merge_overwritten")
    write_overwrite(dedup_latest(_up_to_mark(po), ["po_id"], ["updated_at"]), path)
    later = dedup_latest(incremental_filter(po, "updated_at", PO_MARK), ["po_id"], ["updated_at"])
    return upsert_table(spark, later, path, ["po_id"], check_unique=False)


def q_merge_partial_columns(spark, sf):
    """A batch with the key and one column: the other columns keep the target's values."""
    orders = fx.orders(spark, sf)
    path = scratch_path(spark, "merge_partial")
    write_overwrite(orders.withColumn("order_amount", F.col("order_amount").cast("decimal(19,2)")), path)
    batch = orders.filter("order_id % 3 = 0").select("order_id", (F.col("order_amount") + 1).cast("decimal(19,2)").alias("order_amount"))
    return upsert_table(spark, batch, path, ["order_id"])


def q_merge_upsert(spark, sf):
    """Load purchase orders up to the mark, then merge the later slice in.

    Result: the latest version of every purchase order (equal to a full
    deduplication of all versions)."""
    po = fx.purchase_orders(spark, sf)
    path = scratch_path(spark, "merge_upsert")
    first = dedup_latest(_up_to_mark(po), ["po_id"], ["updated_at"])
    upsert_table(spark, first, path, ["po_id"], check_unique=False)  # unique: deduplicated on po_id
    later = stage(dedup_latest(incremental_filter(po, "updated_at", PO_MARK), ["po_id"], ["updated_at"]), scratch_path(spark, "merge_later"))
    return upsert_table(spark, later, path, ["po_id"], check_unique=False)


def q_merge_changes(spark, sf):
    """What a batch does to a table of orders: every second order comes again, some with
    another amount, and some with a new id; keys and stored row hashes are compared."""
    orders = fx.orders(spark, sf).withColumn("order_amount", F.col("order_amount").cast("decimal(19,2)"))
    more = F.when(F.col("order_id") % 6 == 0, 1).otherwise(0)
    again = orders.filter("order_id % 2 = 0").withColumn("order_amount", (F.col("order_amount") + more).cast("decimal(19,2)"))
    new = orders.filter("order_id % 10 = 1").withColumn("order_id", -F.col("order_id"))
    return row_changes(add_audit_columns(orders, LOADED_AT), add_audit_columns(again.unionByName(new), LOADED_AT), ["order_id"])


def q_merge_unchanged(spark, sf):
    """A batch in which only every tenth row is new or different is merged by its changed rows."""
    orders = fx.orders(spark, sf).withColumn("order_amount", F.col("order_amount").cast("decimal(19,2)"))
    path = scratch_path(spark, "merge_unchanged")
    upsert_table(spark, orders.filter("order_id % 20 != 0"), path, ["order_id"], check_unique=False)
    more = F.when(F.col("order_id") % 10 == 0, 1).otherwise(0)
    batch = orders.withColumn("order_amount", (F.col("order_amount") + more).cast("decimal(19,2)"))
    return upsert_table(spark, batch, path, ["order_id"], check_unique=False)


def q_write_overwrite(spark, sf):
    path = scratch_path(spark, "write_overwrite")
    write_overwrite(fx.customers(spark, sf), path)  # an older table at the path
    write_overwrite(fx.orders(spark, sf), path)
    return spark.read.parquet(path)


def q_write_append(spark, sf):
    po = fx.purchase_orders(spark, sf)
    path = scratch_path(spark, "write_append")
    old = _up_to_mark(po)
    new = incremental_filter(po, "updated_at", PO_MARK)
    append_batch(old, path, 1)
    append_batch(new, path, 2)
    append_batch(new, path, 2)  # a retried batch replaces itself
    return spark.read.parquet(path)


def q_stage_parquet(spark, sf):
    return stage(q_supplier_performance(spark, sf), scratch_path(spark, "stage"))


# ---- sources --------------------------------------------------------------

def q_read_parquet_schema(spark, sf):
    path = scratch_path(spark, "inventory_parquet")
    fx.inventory(spark, sf).write.parquet(path)
    return read_dataset(spark, path, "parquet", SCHEMAS / "inventory.json")


def q_read_csv_schema(spark, sf):
    path = scratch_path(spark, "po_csv")
    fx.purchase_orders(spark, sf).write.option("header", "true").csv(path)
    return read_dataset(spark, path, "csv", SCHEMAS / "purchase_orders.json")


def q_read_json_schema(spark, sf):
    path = scratch_path(spark, "reviews_json")
    fx.product_reviews(spark, sf).write.json(path)
    return read_dataset(spark, path, "json", SCHEMAS / "product_reviews.json")


def q_read_csv_rejected(spark, sf):
    """Purchase orders written as CSV, some with words where numbers and days belong: the records refused, and why."""
    path = scratch_path(spark, "po_bad_csv")
    po = fx.purchase_orders(spark, sf)
    text = po.select(*[F.col(c).cast("string").alias(c) for c in po.columns]).withColumns({
        "quantity_ordered": F.when(F.col("po_id") % 11 == 0, F.lit("n/a")).otherwise(F.col("quantity_ordered")),
        "order_date": F.when(F.col("po_id") % 13 == 0, F.lit("soon")).otherwise(F.col("order_date")),
        "material_id": F.when(F.col("po_id") % 17 != 0, F.col("material_id")),
    })
    text.write.option("header", "true").csv(path)
    return read_checked(spark, path, "csv", SCHEMAS / "purchase_orders.json")[1].select("po_id", "quoted_price", "_reject_reason")


def q_read_json_rejected(spark, sf):
    """Reviews written as JSON lines, some with a word as rating and some cut off: the records refused, and why."""
    path = scratch_path(spark, "reviews_bad_json")
    r = fx.product_reviews(spark, sf)
    line = F.to_json(F.struct(*r.columns))
    line = F.when(F.col("review_id") % 5 == 0, F.regexp_replace(line, '"rating":[0-9]+', '"rating":"five"')).otherwise(line)
    r.select(F.when(F.col("review_id") % 7 == 0, F.substring(line, 1, 30)).otherwise(line)).write.text(path)
    rejected = read_checked(spark, path, "json", SCHEMAS / "product_reviews.json")[1]
    number = F.regexp_extract("_corrupt_record", '"review_id":([0-9]+)', 1).cast("bigint")
    return rejected.select(number.alias("review_id"), "product_id", "_reject_reason")


def q_validate_schema(spark, sf):
    """Purchase orders checked against a contract that requires a received
    quantity and date: open orders are rejected, with the reason."""
    contract = json.loads((SCHEMAS / "purchase_orders.json").read_text())
    for f in contract["fields"]:
        if f["name"] in ("received_date", "quantity_received"):
            f["nullable"] = False
    _valid, rejected = validate_schema(fx.purchase_orders(spark, sf), load_schema(contract))
    return rejected


QUERIES: dict[str, Query] = {
    "customer_360": q_customer_360,
    "order_enriched": q_order_enriched,
    "inventory_snapshot": q_inventory_snapshot,
    "material_consumption": q_material_consumption,
    "supplier_performance": q_supplier_performance,
    "customer_order_metrics": q_customer_order_metrics,
    "customer_review_metrics": q_customer_review_metrics,
    "customer_segment": q_customer_segment,
    "order_recency_rank": q_order_recency_rank,
    "latest_orders_top3": q_latest_orders_top3,
    "order_time_features": q_order_time_features,
    "stock_health": q_stock_health,
    "warehouse_totals": q_warehouse_totals,
    "delivery_variance": q_delivery_variance,
    "rolling_90d_spend": q_rolling_90d_spend,
    "supplier_tier": q_supplier_tier,
    "dedup_latest": q_dedup_latest,
    "drop_nulls": q_drop_nulls,
    "trim_strings": q_trim_strings,
    "row_hash": q_row_hash,
    "table_profile": q_table_profile,
    "incremental_filter": q_incremental_filter,
    "incremental_new_watermark": q_incremental_new_watermark,
    "incremental_material_consumption": q_incremental_material_consumption,
    "incremental_order_enriched": q_incremental_order_enriched,
    "incremental_product_change": q_incremental_product_change,
    "incremental_price_change": q_incremental_price_change,
    "incremental_customer_360": q_incremental_customer_360,
    "incremental_supplier_performance": q_incremental_supplier_performance,
    "run_config_customer_360": q_run_config_customer_360,
    "order_enriched_split": q_order_enriched_split,
    "merge_upsert": q_merge_upsert,
    "merge_into_overwritten": q_merge_into_overwritten,
    "merge_partial_columns": q_merge_partial_columns,
    "merge_changes": q_merge_changes,
    "merge_unchanged": q_merge_unchanged,
    "write_overwrite": q_write_overwrite,
    "write_append": q_write_append,
    "stage_parquet": q_stage_parquet,
    "read_parquet_schema": q_read_parquet_schema,
    "read_csv_schema": q_read_csv_schema,
    "read_json_schema": q_read_json_schema,
    "read_csv_rejected": q_read_csv_rejected,
    "read_json_rejected": q_read_json_rejected,
    "validate_schema": q_validate_schema,
}
