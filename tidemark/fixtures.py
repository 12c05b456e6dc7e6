"""Domain tables derived from the driver's TPC-H-like testdata.

The marts speak about customers, orders, products, suppliers, warehouses,
purchase orders, raw materials, inventory and product reviews. The testdata
holds ``region nation customer supplier part orders lineitem events``. Each
function below derives one domain table from those, as a lazy DataFrame, so
its size grows with the testdata. The same derivations exist as SQL text in
``tidemark.oracle`` for the DuckDB check; the two are written independently.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MONEY = "decimal(18,2)"


_SCHEMAS: dict[tuple, StructType] = {}


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """Read one testdata table; its schema is inferred once per file version
    (inference runs a Spark job over the footers), then passed to the reader."""
    path = f"{sf_dir.rstrip('/')}/{table}.parquet"
    try:
        st = os.stat(path)
        key = (path, st.st_size, st.st_mtime_ns)
    except OSError:  # not a local path: infer every time
        return spark.read.parquet(path)
    if key not in _SCHEMAS:
        _SCHEMAS[key] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[key]).parquet(path)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer; names padded with spaces (exercises trimming)."""
    c = _read(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("customer_id"),
        F.concat(F.lit(" "), F.col("c_name"), F.lit(" ")).alias("customer_name"),
        F.col("c_mktsegment").alias("market_segment"),
        F.col("c_nationkey").alias("nation_id"),
        F.col("c_acctbal").cast(MONEY).alias("account_balance"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the part of their first line item as ``product_id``.

    The first line is the smallest (l_linenumber, l_partkey), packed into one
    BIGINT (part keys below 2**40), so that the minimum is a hash aggregate
    that combines map-side and needs no sort. Orders without line items keep a NULL ``product_id``.
    """
    li = _read(spark, sf_dir, "lineitem")
    first = li.groupBy("l_orderkey").agg(
        F.min(F.shiftleft(F.col("l_linenumber").cast("bigint"), 40) + F.col("l_partkey")).alias("m")
    ).select("l_orderkey", F.col("m").bitwiseAND((1 << 40) - 1).alias("l_partkey"))
    o = _read(spark, sf_dir, "orders")
    j = o.join(first, o["o_orderkey"] == first["l_orderkey"], "left")
    return j.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("o_totalprice").cast(MONEY).alias("order_amount"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderpriority").alias("order_priority"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _read(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("product_category"),
        F.col("p_retailprice").cast(MONEY).alias("list_price"),
    )


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _read(spark, sf_dir, "supplier")
    return s.select(
        F.col("s_suppkey").alias("supplier_id"),
        F.col("s_name").alias("supplier_name"),
        F.col("s_nationkey").alias("supplier_nation_id"),
    )


def warehouses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One warehouse per nation (few keys: whole-warehouse totals stay small)."""
    n = _read(spark, sf_dir, "nation")
    r = _read(spark, sf_dir, "region")
    j = n.join(r, n["n_regionkey"] == r["r_regionkey"], "inner")
    return j.select(
        F.col("n_nationkey").alias("warehouse_id"),
        F.col("n_name").alias("warehouse_name"),
        F.col("r_name").alias("warehouse_region"),
    )


def _not_received() -> Column:
    return (F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O")


def purchase_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One purchase-order version per line item; ``po_id`` repeats (real duplicates)."""
    li = _read(spark, sf_dir, "lineitem")
    ship = F.col("l_shipdate").cast("date")
    qty = F.col("l_quantity").cast("int")
    open_po = _not_received()
    return li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("po_id"),
        F.col("l_partkey").alias("material_id"),
        F.date_sub(ship, qty).alias("order_date"),
        F.when(open_po, F.lit(None).cast("date")).otherwise(ship).alias("received_date"),
        qty.alias("quantity_ordered"),
        F.when(open_po, F.lit(None).cast("int"))
        .when(F.col("l_returnflag") == "R", qty - 1)
        .otherwise(qty)
        .alias("quantity_received"),
        F.col("l_shipdate").alias("updated_at"),
        F.col("l_suppkey").alias("buyer_code"),
        F.col("l_extendedprice").cast(MONEY).alias("quoted_price"),
    )


def raw_materials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Materials snapshotted per month: even parts appear in months 1 and 2.

    The supplier of a material is ``p_partkey mod (number of suppliers)``; key 0
    matches no supplier, which exercises the NULL supplier group downstream.
    """
    p = _read(spark, sf_dir, "part")
    n_sup = _read(spark, sf_dir, "supplier").select(F.count(F.lit(1))).scalar()
    sup = F.col("p_partkey") % n_sup
    months = p.withColumn("month", F.explode(F.array(F.lit(1), F.lit(2))))
    months = months.filter((F.col("month") == 2) | (F.col("p_partkey") % 2 == 0))
    return months.select(
        F.col("p_partkey").alias("material_id"),
        F.col("p_name").alias("material_name"),
        F.col("p_type").alias("material_category"),
        F.col("p_retailprice").cast(MONEY).alias("unit_price"),
        sup.alias("supplier_id"),
        (F.col("p_size") + (sup % 7) * 10).cast("int").alias("lead_time_days"),
        F.lit(2001).alias("year"),
        F.col("month").cast("int").alias("month"),
    )


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stock per (part, warehouse = supplier's nation), from shipped quantities."""
    li = _read(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_quantity", "l_shipdate")
    s = _read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    p = _read(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")
    j = li.join(s, li["l_suppkey"] == s["s_suppkey"]).join(p, li["l_partkey"] == p["p_partkey"])
    g = j.groupBy("l_partkey", "s_nationkey").agg(
        F.sum("l_quantity").alias("q"),
        F.max("p_size").alias("size"),
        F.max("p_retailprice").alias("price"),
        F.max("l_shipdate").alias("last_ship"),
    )
    return g.select(
        (F.col("l_partkey") * 100 + F.col("s_nationkey")).alias("inventory_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("s_nationkey").alias("warehouse_id"),
        F.greatest(F.lit(0), F.col("q").cast("int") - 20).alias("quantity_on_hand"),
        F.when(F.col("l_partkey") % 17 == 0, F.lit(None).cast("int"))
        .otherwise(F.col("size"))
        .alias("reorder_level"),
        F.col("price").cast(MONEY).alias("unit_cost"),
        F.col("last_ship").cast("date").alias("last_restock_date"),
    )


def product_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews from events; ``user_id`` is a string, unlike ``customer_id``."""
    e = _read(spark, sf_dir, "events")
    n_parts = _read(spark, sf_dir, "part").select(F.count(F.lit(1))).scalar()
    return e.select(
        F.col("event_id").alias("review_id"),
        (F.col("event_id") % n_parts).alias("product_id"),
        F.col("user_id").cast("string").alias("user_id"),
        (F.lit(1) + F.col("event_id") % 5).cast("int").alias("rating"),
        (F.col("event_type") == "purchase").alias("verified"),
        F.col("ts").cast("date").alias("review_date"),
    )


BUILDERS = {
    "customers": customers,
    "orders": orders,
    "products": products,
    "suppliers": suppliers,
    "warehouses": warehouses,
    "purchase_orders": purchase_orders,
    "raw_materials": raw_materials,
    "inventory": inventory,
    "product_reviews": product_reviews,
}


def domain(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    """Build the named domain tables (all of them when no name is given)."""
    wanted = names or tuple(BUILDERS)
    return {n: BUILDERS[n](spark, sf_dir) for n in wanted}
