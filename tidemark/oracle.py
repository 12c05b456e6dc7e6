"""Independent SQL statements of every registered query, for DuckDB.

Run against the testdata tables registered as views (``region nation customer
supplier part orders lineitem events ...``). The domain tables are inlined as
CTEs (the adapter texts of FIXTURES.md). Exactness rules shared with the Spark
side: money sums are DECIMAL(38,2); averages are the exact quotient rounded
half away from zero at 6 decimals, DECIMAL(38,6) (written here with integer
arithmetic, because DuckDB divides decimals as DOUBLE); date parts, ranks and
day differences are INTEGER; ``dayofweek`` is 1 = Sunday.
"""

from __future__ import annotations

# ---- adapters: testdata -> domain tables (fixed texts of FIXTURES.md) -------

ADAPTERS: dict[str, str] = {
    "customers": """
SELECT c_custkey AS customer_id, concat(' ', c_name, ' ') AS customer_name, c_mktsegment AS market_segment,
       c_nationkey AS nation_id, CAST(c_acctbal AS DECIMAL(18,2)) AS account_balance
FROM customer""",
    "orders_d": """
SELECT o.o_orderkey AS order_id, o.o_custkey AS customer_id, f.l_partkey AS product_id,
       CAST(o.o_totalprice AS DECIMAL(18,2)) AS order_amount, CAST(o.o_orderdate AS DATE) AS order_date,
       o.o_orderstatus AS order_status, o.o_orderpriority AS order_priority
FROM orders o LEFT JOIN (
  SELECT l_orderkey, l_partkey FROM (
    SELECT l_orderkey, l_partkey, row_number() OVER (PARTITION BY l_orderkey
           ORDER BY l_linenumber, l_partkey, l_shipdate) AS rn FROM lineitem) x
  WHERE rn = 1) f ON o.o_orderkey = f.l_orderkey""",
    "products": """
SELECT p_partkey AS product_id, p_name AS product_name, p_brand AS brand, p_type AS product_category,
       CAST(p_retailprice AS DECIMAL(18,2)) AS list_price
FROM part""",
    "suppliers": """
SELECT s_suppkey AS supplier_id, s_name AS supplier_name, s_nationkey AS supplier_nation_id
FROM supplier""",
    "warehouses": """
SELECT n_nationkey AS warehouse_id, n_name AS warehouse_name, r_name AS warehouse_region
FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "purchase_orders": """
SELECT l_orderkey * 10 + l_linenumber AS po_id, l_partkey AS material_id,
       CAST(l_shipdate AS DATE) - CAST(l_quantity AS INT) AS order_date,
       CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN NULL ELSE CAST(l_shipdate AS DATE) END AS received_date,
       CAST(l_quantity AS INT) AS quantity_ordered,
       CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN NULL
            WHEN l_returnflag = 'R' THEN CAST(l_quantity AS INT) - 1
            ELSE CAST(l_quantity AS INT) END AS quantity_received,
       l_shipdate AS updated_at, l_suppkey AS buyer_code, CAST(l_extendedprice AS DECIMAL(18,2)) AS quoted_price
FROM lineitem""",
    "raw_materials": """
SELECT p.p_partkey AS material_id, p.p_name AS material_name, p.p_type AS material_category,
       CAST(p.p_retailprice AS DECIMAL(18,2)) AS unit_price, p.p_partkey % s.n AS supplier_id,
       CAST(p.p_size + ((p.p_partkey % s.n) % 7) * 10 AS INT) AS lead_time_days,
       2001 AS year, m.month AS month
FROM part p CROSS JOIN (SELECT count(*) AS n FROM supplier) s
     CROSS JOIN (SELECT 1 AS month UNION ALL SELECT 2 AS month) m
WHERE m.month = 2 OR p.p_partkey % 2 = 0""",
    "inventory": """
SELECT l.l_partkey * 100 + s.s_nationkey AS inventory_id, l.l_partkey AS product_id, s.s_nationkey AS warehouse_id,
       greatest(0, CAST(sum(l.l_quantity) AS INT) - 20) AS quantity_on_hand,
       CASE WHEN l.l_partkey % 17 = 0 THEN NULL ELSE max(p.p_size) END AS reorder_level,
       CAST(max(p.p_retailprice) AS DECIMAL(18,2)) AS unit_cost,
       CAST(max(l.l_shipdate) AS DATE) AS last_restock_date
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN part p ON l.l_partkey = p.p_partkey
GROUP BY l.l_partkey, s.s_nationkey""",
    "product_reviews": """
SELECT event_id AS review_id, event_id % (SELECT count(*) FROM part) AS product_id,
       CAST(user_id AS VARCHAR(20)) AS user_id, CAST(1 + event_id % 5 AS INT) AS rating,
       event_type = 'purchase' AS verified, CAST(ts AS DATE) AS review_date
FROM events""",
}

COLUMNS: dict[str, list[str]] = {
    "customers": ["customer_id", "customer_name", "market_segment", "nation_id", "account_balance"],
    "orders_d": ["order_id", "customer_id", "product_id", "order_amount", "order_date", "order_status", "order_priority"],
    "products": ["product_id", "product_name", "brand", "product_category", "list_price"],
    "suppliers": ["supplier_id", "supplier_name", "supplier_nation_id"],
    "warehouses": ["warehouse_id", "warehouse_name", "warehouse_region"],
    "purchase_orders": ["po_id", "material_id", "order_date", "received_date", "quantity_ordered",
                        "quantity_received", "updated_at", "buyer_code", "quoted_price"],
    "raw_materials": ["material_id", "material_name", "material_category", "unit_price", "supplier_id",
                      "lead_time_days", "year", "month"],
    "inventory": ["inventory_id", "product_id", "warehouse_id", "quantity_on_hand", "reorder_level", "unit_cost",
                  "last_restock_date"],
    "product_reviews": ["review_id", "product_id", "user_id", "rating", "verified", "review_date"],
}

AS_OF = "DATE '2002-01-01'"
LOADED_AT = "TIMESTAMP '2002-01-01 00:00:00'"
PO_MARK = "TIMESTAMP '2000-01-01 00:00:00'"


# ---- SQL helpers ------------------------------------------------------------

def with_ctes(adapters: list[str], ctes: list[tuple[str, str]], body: str) -> str:
    parts = [f"{a} AS ({ADAPTERS[a]}\n)" for a in adapters] + [f"{n} AS (\n{s}\n)" for n, s in ctes]
    return "WITH " + ",\n".join(parts) + "\n" + body


def dedup(src: str, cols: list[str], keys: list[str], recency: list[str] = ()) -> str:
    order = [f"{r} DESC NULLS LAST" for r in recency]
    order += [f"{c} ASC NULLS FIRST" for c in cols if c not in keys and c not in recency]
    return (
        f"SELECT {', '.join(cols)} FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(keys)} "
        f"ORDER BY {', '.join(order)}) AS rn__ FROM {src}) d__ WHERE rn__ = 1"
    )


def avg6(expr: str, scale: int) -> str:
    """Exact average at 6 decimals, half away from zero (integer arithmetic)."""
    a = f"sum(CAST(({expr}) * {10 ** scale} AS HUGEINT))"
    n = f"count({expr})"
    q = f"((2 * {a} * {10 ** (6 - scale)} + sign({a}) * {n}) // (2 * {n}))"
    return f"CAST(CAST({q} AS DECIMAL(32,0)) * CAST(0.000001 AS DECIMAL(6,6)) AS DECIMAL(38,6))"


def money_sum(expr: str) -> str:
    return f"CAST(sum({expr}) AS DECIMAL(38,2))"


def days(start: str, end: str) -> str:
    return f"CAST(date_diff('day', {start}, {end}) AS INTEGER)"


def rhash(cols: list[str]) -> str:
    return "sha256(concat_ws('|', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in cols) + "))"


def rhash_strict(cols: list[str]) -> str:
    enc = [
        f"CASE WHEN {c} IS NULL THEN 'N' ELSE CAST(length(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR) END"
        for c in cols
    ]
    return "sha256(concat_ws('|', " + ", ".join(enc) + "))"


def audit(cols: list[str], exclude: tuple[str, ...] = ()) -> str:
    hashed = [c for c in cols if c not in exclude]
    return f"CAST({LOADED_AT} AS TIMESTAMP) AS _etl_loaded_at, {rhash(hashed)} AS _etl_row_hash"


def segment(ltv: str, t=(3500000, 2500000, 1500000)) -> str:
    return (
        f"CASE WHEN {ltv} >= {t[0]} THEN 'platinum' WHEN {ltv} >= {t[1]} THEN 'gold' "
        f"WHEN {ltv} >= {t[2]} THEN 'silver' ELSE 'bronze' END"
    )


# ---- reusable CTE bodies ----------------------------------------------------

ORD_TRIM = (
    "SELECT order_id, customer_id, product_id, order_amount, order_date, trim(order_status) AS order_status, "
    "trim(order_priority) AS order_priority FROM orders_d"
)
ORD = ("ord", dedup("ord_t", COLUMNS["orders_d"], ["order_id"]))
ORD_T = ("ord_t", ORD_TRIM)

METRICS = (
    "m",
    f"SELECT customer_id, count(order_id) AS total_orders, {money_sum('order_amount')} AS lifetime_value, "
    f"{avg6('order_amount', 2)} AS avg_order_value, max(order_date) AS last_order_date, "
    f"min(order_date) AS first_order_date FROM ord GROUP BY customer_id",
)

INV = ("inv", dedup("inventory", COLUMNS["inventory"], ["inventory_id"]))
STOCK = (
    "stock",
    "SELECT inv.*, quantity_on_hand * unit_cost AS raw_value, CAST(quantity_on_hand * unit_cost AS DECIMAL(38,2)) AS stock_value, "
    "coalesce(quantity_on_hand <= reorder_level, false) AS needs_reorder, "
    f"{days('last_restock_date', AS_OF)} AS days_since_restock, "
    "CASE WHEN quantity_on_hand = 0 THEN 'out_of_stock' "
    "WHEN coalesce(quantity_on_hand <= reorder_level, false) THEN 'low_stock' "
    "WHEN quantity_on_hand > reorder_level * 5 THEN 'overstock' ELSE 'healthy' END AS stock_health FROM inv",
)

PO_BASE_CTES = [
    ("po_t", dedup("purchase_orders", COLUMNS["purchase_orders"], ["po_id"], ["updated_at"])),
    ("mat", dedup("raw_materials", COLUMNS["raw_materials"], ["material_id"], ["year", "month"])),
    ("sup", dedup("suppliers", COLUMNS["suppliers"], ["supplier_id"])),
    (
        "base",
        "SELECT mat.supplier_id, po_t.material_id, po_t.po_id, po_t.order_date, po_t.received_date, "
        "po_t.quantity_ordered, po_t.quantity_received, po_t.updated_at, po_t.buyer_code, po_t.quoted_price, "
        "mat.material_name, mat.material_category, mat.unit_price, mat.lead_time_days, mat.year, mat.month, "
        "sup.supplier_name, sup.supplier_nation_id "
        "FROM po_t LEFT JOIN mat ON po_t.material_id = mat.material_id "
        "LEFT JOIN sup ON mat.supplier_id = sup.supplier_id",
    ),
    (
        "dlv0",
        "SELECT base.*, quantity_ordered * unit_price AS raw_cost, CAST(quantity_ordered * unit_price AS DECIMAL(38,2)) AS line_cost, "
        "CAST(order_date + CAST(lead_time_days AS INTEGER) AS DATE) AS expected_delivery_date FROM base",
    ),
    (
        "dlv",
        f"SELECT dlv0.*, {days('expected_delivery_date', 'received_date')} AS delivery_variance_days, "
        f"coalesce({days('expected_delivery_date', 'received_date')} > 0, false) AS is_late FROM dlv0",
    ),
]
PO_ADAPTERS = ["purchase_orders", "raw_materials", "suppliers"]

ROLLING = (
    "roll",
    "SELECT dlv.*, CAST(sum(raw_cost) OVER (PARTITION BY material_id ORDER BY order_date "
    "RANGE BETWEEN INTERVAL 90 DAY PRECEDING AND CURRENT ROW) AS DECIMAL(38,2)) AS rolling_90d_spend FROM dlv",
)

SCORE_COLS = [
    "supplier_id", "supplier_name", "total_orders", "total_spend", "avg_order_value", "unique_materials",
    "avg_delivery_variance_days", "late_deliveries", "late_delivery_rate", "avg_qty_variance", "short_shipments",
    "last_order_date", "first_order_date", "on_time_rate", "relationship_tenure_days", "supplier_tier",
    "late_delivery_rate_received",
]
SCORE_CTES = [
    ("pb", "SELECT dlv.*, quantity_received - quantity_ordered AS qty_variance FROM dlv"),
    (
        "agg",
        "SELECT supplier_id, supplier_name, count(po_id) AS total_orders, "
        f"{money_sum('raw_cost')} AS total_spend, sum(raw_cost) AS raw_spend, count(*) AS n_all, {avg6('raw_cost', 2)} AS avg_order_value, "
        "count(DISTINCT material_id) AS unique_materials, "
        f"{avg6('delivery_variance_days', 0)} AS avg_delivery_variance_days, "
        "CAST(sum(CAST(is_late AS INTEGER)) AS BIGINT) AS late_deliveries, "
        f"{avg6('CAST(is_late AS INTEGER)', 0)} AS late_delivery_rate, "
        f"{avg6('qty_variance', 0)} AS avg_qty_variance, "
        "count(*) FILTER (WHERE qty_variance < 0) AS short_shipments, "
        "max(order_date) AS last_order_date, min(order_date) AS first_order_date, "
        f"{avg6('CASE WHEN received_date IS NOT NULL THEN CAST(is_late AS INTEGER) END', 0)} AS late_delivery_rate_received "
        "FROM pb GROUP BY supplier_id, supplier_name",
    ),
    (
        "score",
        "SELECT supplier_id, supplier_name, total_orders, total_spend, avg_order_value, unique_materials, "
        "avg_delivery_variance_days, late_deliveries, late_delivery_rate, avg_qty_variance, short_shipments, "
        "last_order_date, first_order_date, CAST(1 - late_delivery_rate AS DECIMAL(38,6)) AS on_time_rate, "
        f"{days('first_order_date', AS_OF)} AS relationship_tenure_days, "
        "CASE WHEN late_deliveries * 100 <= 5 * n_all AND raw_spend >= 100000 THEN 'strategic' "
        "WHEN late_deliveries * 100 <= 15 * n_all THEN 'preferred' "
        "WHEN late_deliveries * 100 <= 30 * n_all THEN 'approved' ELSE 'under_review' END AS supplier_tier, "
        "late_delivery_rate_received FROM agg",
    ),
]

TIME_PARTS = {
    "year": "CAST(year({d}) AS INTEGER)",
    "month": "CAST(month({d}) AS INTEGER)",
    "dow": "CAST(dayofweek({d}) + 1 AS INTEGER)",
    "quarter": "CAST(quarter({d}) AS INTEGER)",
}


def parts(d: str, prefix: str, names: tuple[str, ...]) -> str:
    return ", ".join(f"{TIME_PARTS[n].format(d=d)} AS {prefix}_{n}" for n in names)


RANK = "CAST(row_number() OVER (PARTITION BY customer_id ORDER BY order_date DESC NULLS LAST, order_id ASC NULLS FIRST) AS INTEGER)"


# ---- the statements ---------------------------------------------------------

def _customer_360() -> str:
    cust_t = (
        "cust_t",
        "SELECT customer_id, trim(customer_name) AS customer_name, trim(market_segment) AS market_segment, "
        "nation_id, account_balance FROM customers",
    )
    cust = ("cust", dedup("cust_t", COLUMNS["customers"], ["customer_id"]))
    rev = (
        "r",
        f"SELECT user_id, {avg6('rating', 0)} AS avg_review_rating, count(review_id) AS total_reviews "
        "FROM product_reviews GROUP BY user_id",
    )
    j = (
        "j",
        "SELECT c.*, m.total_orders, m.lifetime_value, m.avg_order_value, m.last_order_date, m.first_order_date, "
        "r.avg_review_rating, r.total_reviews, "
        f"{days('m.first_order_date', AS_OF)} AS customer_tenure_days, "
        f"{days('m.last_order_date', AS_OF)} AS days_since_last_order, "
        f"{segment('m.lifetime_value')} AS customer_segment "
        "FROM cust c LEFT JOIN m ON c.customer_id = m.customer_id "
        "LEFT JOIN r ON CAST(c.customer_id AS VARCHAR) = r.user_id",
    )
    cols = COLUMNS["customers"] + [
        "total_orders", "lifetime_value", "avg_order_value", "last_order_date", "first_order_date",
        "avg_review_rating", "total_reviews", "customer_tenure_days", "days_since_last_order", "customer_segment",
    ]
    body = f"SELECT j.*, {audit(cols, ('customer_tenure_days', 'days_since_last_order'))} FROM j"
    return with_ctes(["customers", "orders_d", "product_reviews"], [cust_t, cust, ORD_T, ORD, METRICS, rev, j], body)


def _order_enriched() -> str:
    prod = ("prod", dedup("products", COLUMNS["products"], ["product_id"]))
    e = (
        "e",
        "SELECT o.product_id, o.order_id, o.customer_id, o.order_amount, o.order_date, o.order_status, "
        "o.order_priority, p.product_name, p.brand, p.product_category, p.list_price, "
        f"{RANK} AS order_rank, {parts('o.order_date', 'order', ('year', 'month', 'dow'))} "
        "FROM ord o LEFT JOIN prod p ON o.product_id = p.product_id",
    )
    cols = [
        "product_id", "order_id", "customer_id", "order_amount", "order_date", "order_status", "order_priority",
        "product_name", "brand", "product_category", "list_price", "order_rank", "order_year", "order_month",
        "order_dow",
    ]
    return with_ctes(["orders_d", "products"], [ORD_T, ORD, prod, e], f"SELECT e.*, {audit(cols)} FROM e")


def _inventory_snapshot() -> str:
    prod = ("prod", dedup("products", COLUMNS["products"], ["product_id"]))
    wh = ("wh", dedup("warehouses", COLUMNS["warehouses"], ["warehouse_id"]))
    j = (
        "j",
        "SELECT i.warehouse_id, i.product_id, i.inventory_id, i.quantity_on_hand, i.reorder_level, i.unit_cost, "
        "i.last_restock_date, p.product_name, p.brand, p.product_category, p.list_price, w.warehouse_name, "
        "w.warehouse_region, i.stock_value, i.raw_value, i.needs_reorder, i.days_since_restock, i.stock_health "
        "FROM stock i LEFT JOIN prod p ON i.product_id = p.product_id "
        "LEFT JOIN wh w ON i.warehouse_id = w.warehouse_id",
    )
    t = (
        "t",
        "SELECT j.*, CAST(sum(raw_value) OVER (PARTITION BY warehouse_id) AS DECIMAL(38,2)) AS warehouse_total_value, "
        "count(product_id) OVER (PARTITION BY warehouse_id) AS warehouse_sku_count FROM j",
    )
    cols = [
        "warehouse_id", "product_id", "inventory_id", "quantity_on_hand", "reorder_level", "unit_cost",
        "last_restock_date", "product_name", "brand", "product_category", "list_price", "warehouse_name",
        "warehouse_region", "stock_value", "needs_reorder", "days_since_restock", "stock_health",
        "warehouse_total_value", "warehouse_sku_count",
    ]
    body = f"SELECT {', '.join(cols)}, {audit(cols, ('days_since_restock',))} FROM t"
    return with_ctes(["inventory", "products", "warehouses"], [INV, STOCK, prod, wh, j, t], body)


MC_COLS = [
    "supplier_id", "material_id", "po_id", "order_date", "received_date", "quantity_ordered", "quantity_received",
    "updated_at", "buyer_code", "quoted_price", "material_name", "material_category", "unit_price",
    "lead_time_days", "year", "month", "supplier_name", "supplier_nation_id", "line_cost", "expected_delivery_date",
    "delivery_variance_days", "is_late", "rolling_90d_spend", "order_year", "order_month", "order_quarter",
]


def _material_consumption() -> str:
    mc = ("mc", f"SELECT roll.*, {parts('order_date', 'order', ('year', 'month', 'quarter'))} FROM roll")
    return with_ctes(PO_ADAPTERS, PO_BASE_CTES + [ROLLING, mc], f"SELECT {', '.join(MC_COLS)}, {audit(MC_COLS)} FROM mc")


def _supplier_performance() -> str:
    body = f"SELECT score.*, {audit(SCORE_COLS, ('relationship_tenure_days',))} FROM score"
    return with_ctes(PO_ADAPTERS, PO_BASE_CTES + SCORE_CTES, body)


def _sql() -> dict[str, str]:
    po_cols = COLUMNS["purchase_orders"]
    sql = {
        "customer_360": _customer_360(),
        "order_enriched": _order_enriched(),
        "inventory_snapshot": _inventory_snapshot(),
        "material_consumption": _material_consumption(),
        "supplier_performance": _supplier_performance(),
        "customer_order_metrics": with_ctes(["orders_d"], [ORD_T, ORD, METRICS], "SELECT * FROM m"),
        "customer_review_metrics": with_ctes(
            ["product_reviews"], [],
            f"SELECT user_id, {avg6('rating', 0)} AS avg_review_rating, count(review_id) AS total_reviews "
            "FROM product_reviews GROUP BY user_id",
        ),
        "customer_segment": with_ctes(
            ["customers", "orders_d"], [ORD_T, ORD, METRICS],
            f"SELECT c.customer_id, m.lifetime_value, {segment('m.lifetime_value')} AS customer_segment "
            "FROM (SELECT DISTINCT customer_id FROM customers) c LEFT JOIN m ON c.customer_id = m.customer_id",
        ),
        "order_recency_rank": with_ctes(
            ["orders_d"], [ORD_T, ORD], f"SELECT customer_id, order_id, order_date, {RANK} AS order_rank FROM ord"
        ),
        "latest_orders_top3": with_ctes(
            ["orders_d"], [ORD_T, ORD],
            f"SELECT * FROM (SELECT customer_id, order_id, order_date, order_amount, {RANK} AS order_rank FROM ord) x "
            "WHERE order_rank <= 3",
        ),
        "order_time_features": with_ctes(
            ["orders_d"], [ORD_T, ORD],
            f"SELECT order_id, order_date, {parts('order_date', 'order', ('year', 'month', 'dow', 'quarter'))} FROM ord",
        ),
        "stock_health": with_ctes(
            ["inventory"], [INV, STOCK],
            "SELECT inventory_id, warehouse_id, quantity_on_hand, reorder_level, stock_value, needs_reorder, "
            "stock_health FROM stock",
        ),
        "warehouse_totals": with_ctes(
            ["inventory"], [INV, STOCK],
            f"SELECT warehouse_id, {money_sum('raw_value')} AS warehouse_total_value, "
            "count(product_id) AS warehouse_sku_count FROM stock GROUP BY warehouse_id",
        ),
        "delivery_variance": with_ctes(
            PO_ADAPTERS, PO_BASE_CTES,
            "SELECT po_id, material_id, supplier_id, expected_delivery_date, delivery_variance_days, is_late FROM dlv",
        ),
        "rolling_90d_spend": with_ctes(
            PO_ADAPTERS, PO_BASE_CTES + [ROLLING],
            "SELECT po_id, material_id, order_date, line_cost, rolling_90d_spend FROM roll",
        ),
        "supplier_tier": with_ctes(
            PO_ADAPTERS, PO_BASE_CTES + SCORE_CTES,
            "SELECT supplier_id, total_spend, on_time_rate, supplier_tier FROM score",
        ),
        "dedup_latest": with_ctes(["purchase_orders"], [], dedup("purchase_orders", po_cols, ["po_id"], ["updated_at"])),
        "drop_nulls": with_ctes(
            ["orders_d"], [], "SELECT * FROM orders_d WHERE product_id IS NOT NULL AND order_date IS NOT NULL"
        ),
        "trim_strings": with_ctes(
            ["customers"], [],
            "SELECT customer_id, trim(customer_name) AS customer_name, trim(market_segment) AS market_segment, "
            "nation_id, account_balance FROM customers",
        ),
        "row_hash": with_ctes(
            ["orders_d"], [],
            f"SELECT orders_d.*, {audit(COLUMNS['orders_d'])}, {rhash_strict(COLUMNS['orders_d'])} AS row_hash_strict "
            "FROM orders_d",
        ),
        "table_profile": with_ctes(
            ["purchase_orders"], [],
            " UNION ALL ".join(
                f"SELECT 'purchase_orders' AS table_name, '{c}' AS column_name, CAST({i + 1} AS INTEGER) AS column_position, "
                f"count(*) AS row_count, count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM purchase_orders"
                for i, c in enumerate(po_cols)
            ),
        ),
        "incremental_filter": with_ctes(
            ["purchase_orders"], [], f"SELECT * FROM purchase_orders WHERE updated_at > {PO_MARK}"
        ),
        "incremental_new_watermark": with_ctes(
            ["purchase_orders"], [],
            f"SELECT 'purchase_orders' AS table_name, 'updated_at' AS watermark_column, "
            f"{PO_MARK} AS previous_watermark, coalesce(max(updated_at), {PO_MARK}) AS new_watermark, "
            f"count(*) AS new_rows FROM purchase_orders WHERE updated_at > {PO_MARK}",
        ),
        "merge_upsert": with_ctes(["purchase_orders"], [], dedup("purchase_orders", po_cols, ["po_id"], ["updated_at"])),
        "incremental_material_consumption": _material_consumption(),
        "incremental_order_enriched": _order_enriched(),
        "incremental_product_change": _order_enriched(),
        "incremental_price_change": _material_consumption(),
        "incremental_customer_360": _customer_360(),
        "incremental_supplier_performance": _supplier_performance(),
        "run_config_customer_360": _customer_360(),
        "order_enriched_split": with_ctes(
            ["orders_d", "products"], [ORD_T, ORD, ("prod", dedup("products", COLUMNS["products"], ["product_id"]))],
            f"SELECT o.order_id, o.customer_id, o.product_id, p.product_name, {RANK} AS order_rank "
            "FROM ord o LEFT JOIN prod p ON o.product_id = p.product_id",
        ),
        "merge_into_overwritten": with_ctes(["purchase_orders"], [], dedup("purchase_orders", po_cols, ["po_id"], ["updated_at"])),
        "merge_partial_columns": with_ctes(
            ["orders_d"], [],
            "SELECT order_id, customer_id, product_id, CASE WHEN order_id % 3 = 0 THEN CAST(order_amount + 1 AS DECIMAL(19,2)) "
            "ELSE CAST(order_amount AS DECIMAL(19,2)) END AS order_amount, order_date, order_status, order_priority FROM orders_d",
        ),
        "merge_changes": with_ctes(
            ["orders_d"], [],
            "SELECT order_id, CASE WHEN order_id % 2 != 0 THEN 'absent' WHEN order_id % 6 = 0 AND order_amount IS NOT NULL THEN 'updated' "
            "ELSE 'unchanged' END AS change FROM orders_d UNION ALL SELECT -order_id, 'inserted' FROM orders_d WHERE order_id % 10 = 1",
        ),
        "merge_unchanged": with_ctes(
            ["orders_d"], [],
            "SELECT order_id, customer_id, product_id, CAST(order_amount + CASE WHEN order_id % 10 = 0 THEN 1 ELSE 0 END AS DECIMAL(19,2)) "
            "AS order_amount, order_date, order_status, order_priority FROM orders_d",
        ),
        "write_overwrite": with_ctes(["orders_d"], [], "SELECT * FROM orders_d"),
        "write_append": with_ctes(
            ["purchase_orders"], [],
            f"SELECT *, CAST(CASE WHEN updated_at > {PO_MARK} THEN 2 ELSE 1 END AS INTEGER) AS batch_id FROM purchase_orders",
        ),
        "stage_parquet": _supplier_performance(),
        "read_parquet_schema": with_ctes(["inventory"], [], "SELECT * FROM inventory"),
        "read_csv_schema": with_ctes(["purchase_orders"], [], "SELECT * FROM purchase_orders"),
        "read_json_schema": with_ctes(["product_reviews"], [], "SELECT * FROM product_reviews"),
        "read_csv_rejected": with_ctes(
            ["purchase_orders"], [],
            "SELECT * FROM (SELECT po_id, quoted_price, nullif(concat_ws('; ', "
            "CASE WHEN po_id % 13 = 0 THEN 'order_date: not a date' END, "
            "CASE WHEN po_id % 11 = 0 THEN 'quantity_ordered: not a int' END, "
            "CASE WHEN po_id % 17 = 0 THEN 'material_id: null' END), '') AS _reject_reason "
            "FROM purchase_orders) v WHERE _reject_reason IS NOT NULL",
        ),
        "read_json_rejected": with_ctes(
            ["product_reviews"], [],
            "SELECT review_id, CASE WHEN review_id % 7 != 0 THEN product_id END AS product_id, "
            "CASE WHEN review_id % 7 = 0 THEN 'malformed record' ELSE 'rating: not a int' END AS _reject_reason "
            "FROM product_reviews WHERE review_id % 7 = 0 OR review_id % 5 = 0",
        ),
        "validate_schema": with_ctes(
            ["purchase_orders"], [],
            "SELECT * FROM (SELECT *, nullif(concat_ws('; ', "
            "CASE WHEN received_date IS NULL THEN 'received_date: null' END, "
            "CASE WHEN quantity_received IS NULL THEN 'quantity_received: null' END), '') AS _reject_reason "
            "FROM purchase_orders) v WHERE _reject_reason IS NOT NULL",
        ),
    }
    return sql


ORACLE_SQL: dict[str, str] = _sql()
