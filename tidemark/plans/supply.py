"""Purchasing marts: material consumption and the supplier scorecard."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tidemark.functions.dates import as_date, date_parts, day_literal, days_between
from tidemark.functions.hashing import add_audit_columns
from tidemark.functions.rules import ON_TIME_THRESHOLDS, STRATEGIC_SPEND, is_late, tier_by_counts
from tidemark.functions.stats import QUANTITY_TYPE, WIDE_TYPE, cost, exact_avg, exact_sum, money, quantity_type
from tidemark.functions.text import trim_strings
from tidemark.operators.aggregates import StateSpec, state_avg, state_sum
from tidemark.operators.dedup import dedup_latest
from tidemark.operators.windows import (
    DAY,
    MAX_GROUP_ROWS,
    SUMMARY_GROUPS,
    attach_by_day,
    day_number,
    range_window_over_days,
    rolling_range_sum,
)
from tidemark.plans.common import dim_latest, left_join_dim, now, present, today

PO_RECENCY = ("updated_at",)
MATERIAL_RECENCY = ("year", "month", "updated_at")
ROLLING_DAYS = 90


def po_parts(
    po: DataFrame, materials: DataFrame, suppliers: DataFrame, *, trim: bool = True
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Latest version of each purchase order, latest snapshot of each
    material, one row per supplier: the three inputs of ``po_base``."""
    if trim:
        po = trim_strings(po)
    if "supplier_id" in po.columns:
        po = po.withColumnRenamed("supplier_id", "po_supplier_id")
    po = dedup_latest(po, ["po_id"], present(po, PO_RECENCY))
    return po, dim_latest(materials, "material_id", MATERIAL_RECENCY), dim_latest(suppliers, "supplier_id")


def hot_purchase_keys(
    po_material_ids: DataFrame, materials: DataFrame, max_group_rows: int = MAX_GROUP_ROWS, keys: tuple[str, ...] = ("material_id", "supplier_id")
) -> dict[str, DataFrame]:
    """Hot materials and hot suppliers of the purchase orders, the NULL supplier
    of unmatched materials included, from one pass over the raw material ids.

    The purchase orders are counted per material (partial aggregation); only
    these counts are joined with the materials and summed per supplier - no
    join of all purchase orders. Of each column the ``SUMMARY_GROUPS`` largest
    counts come to the driver, which holds every key above ``1/SUMMARY_GROUPS``
    of all rows. A table of at most ``max_group_rows`` rows has no hot key, and
    its row count alone (no column read) says so.
    """
    total = po_material_ids.count()
    if total <= max_group_rows:
        return {}
    per_material = po_material_ids.groupBy("material_id").agg(F.count(F.lit(1)).alias("n"))
    per_supplier = (
        per_material.join(materials.select("material_id", "supplier_id"), on="material_id", how="left")
        .groupBy("supplier_id").agg(F.sum("n").alias("n"))
    )
    hot = {}
    for key, counts in (("material_id", per_material), ("supplier_id", per_supplier)):
        if key not in keys:
            continue
        large = counts.where(F.col("n") > max_group_rows).orderBy(F.desc("n")).limit(SUMMARY_GROUPS)
        rows = [(r[key], -(-r["n"] // max_group_rows)) for r in large.collect() if r["n"] * SUMMARY_GROUPS > total]
        if rows:
            schema = StructType([StructField("__tm_h0", counts.schema[key].dataType), StructField("__tm_pieces", IntegerType())])
            hot[key] = F.broadcast(counts.sparkSession.createDataFrame(rows, schema))
    return hot


def largest_material(po_material_ids: DataFrame) -> int:
    """How many purchase orders (versions included) the material with the most of them has, NULL included."""
    counts = po_material_ids.groupBy("material_id").agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.max("n")).first()[0] or 0


def with_suppliers(po: DataFrame, materials: DataFrame, suppliers: DataFrame) -> DataFrame:
    """The materials with their supplier, under the names that they get beside purchase orders.

    Joined here, the purchase orders meet one dimension and are not shuffled by
    supplier; materials are far fewer."""
    named = materials.select(*[F.col(f"`{c}`").alias(f"material_{c}" if c != "material_id" and c in po.columns else c) for c in materials.columns])
    clash = {*po.columns, *named.columns}
    named_suppliers = suppliers.select(*[F.col(f"`{c}`").alias(f"supplier_{c}" if c != "supplier_id" and c in clash else c) for c in suppliers.columns])
    return named.join(named_suppliers, on="supplier_id", how="left")


def join_base(
    po: DataFrame, materials: DataFrame, suppliers: DataFrame, hot_source: DataFrame | None = None, largest: int | None = None
) -> DataFrame:
    """Purchase orders with their material and the material's supplier.

    ``hot_source`` (the raw purchase orders' ``material_id``) salts the join
    of materials with very many purchase orders (``left_join_dim``); none has
    where ``largest`` (``largest_material``) is small. A purchase order's row
    meets its supplier through its material, so a supplier with very many of
    them is never a key of its join."""
    no_hot = hot_source is None or (largest is not None and largest <= MAX_GROUP_ROWS)
    hot = None if no_hot else hot_purchase_keys(hot_source, materials, keys=("material_id",))
    dim = with_suppliers(po, materials, suppliers)
    base = left_join_dim(po, dim, "material_id", "material", hot=hot)
    of_materials = [f"material_{c}" if c in po.columns else c for c in materials.columns if c not in ("material_id", "supplier_id")]
    first = ["supplier_id", "material_id", *[c for c in po.columns if c != "material_id"], *of_materials]
    return base.select(*[f"`{c}`" for c in first], *[f"`{c}`" for c in base.columns if c not in first])


def po_base(po: DataFrame, materials: DataFrame, suppliers: DataFrame, *, trim: bool = True) -> DataFrame:
    """Latest version of each purchase order, with its material and the
    material's supplier.

    The supplier always comes from the material; a ``supplier_id`` carried by
    the purchase order itself is kept as ``po_supplier_id``. Materials are
    reduced to their latest (year, month) snapshot and suppliers to one row per
    key, so neither join can multiply purchase orders.
    """
    return join_base(*po_parts(po, materials, suppliers, trim=trim), hot_source=po.select("material_id"))


def material_rolling_spend(po: DataFrame, materials: DataFrame, window_days: int = ROLLING_DAYS) -> DataFrame:
    """Trailing spend per (material, day), from deduplicated purchase orders
    and the latest material snapshot (the first two outputs of ``po_parts``).

    A row's spend is ``quantity_ordered * unit_price`` and the price is one per
    material, so a day's spend is the price times the day's summed quantity -
    exactly, in decimals that are rounded only at the output. The quantities are a partial aggregate of the
    purchase orders (sharing their deduplication shuffle); only that small
    daily table is joined with the materials. Unlike windowing the joined
    base, no purchase-order-level join is repeated.
    """
    fine = quantity_type(po, "quantity_ordered")
    daily_qty = po.groupBy(F.col("material_id"), day_number("order_date").alias(DAY)).agg(
        F.sum(F.col("quantity_ordered").cast(fine)).alias("__tm_qty")
    )
    priced = daily_qty.join(materials.select("material_id", "unit_price"), on="material_id", how="left")
    daily = priced.select("material_id", DAY, cost("__tm_qty", "unit_price", fine).alias("__tm_spend"))
    return range_window_over_days(daily, ["material_id"], "__tm_spend", window_days, "rolling_90d_spend")


#: The trailing spend of a purchase order, where it is attached before the joins (``with_rolling_spend``).
ROLLING = "__tm_rolling"


def with_rolling_spend(po: DataFrame, materials: DataFrame, window_days: int = ROLLING_DAYS) -> DataFrame:
    """Deduplicated purchase orders with ``ROLLING``, the trailing spend of their material and day.

    Attached here and not to the joined base, the rows that this join shuffles
    carry no column of a material or supplier."""
    rolling = material_rolling_spend(po, materials, window_days).withColumnRenamed("rolling_90d_spend", ROLLING)
    return attach_by_day(po, ["material_id"], "order_date", rolling, ROLLING)


#: Purchase orders of a material that one task takes in a window over its rows, a quarter of a hot material's.
WINDOW_ROWS = MAX_GROUP_ROWS // 4
#: The trailing quantity of a purchase order's material and day, before it is priced.
TRAILING = "__tm_trailing"


def consumption_base(
    po: DataFrame, materials: DataFrame, suppliers: DataFrame, hot_source: DataFrame, window_days: int = ROLLING_DAYS, window_rows: int = WINDOW_ROWS
) -> DataFrame:
    """The joined base (``join_base``) with ``ROLLING``, the trailing spend.

    Where no material has more than ``window_rows`` purchase orders, one shuffle
    by material serves both the trailing sum and the join: the window sums
    quantities over a material's days, its one price follows after the join
    (exact in decimals, as in ``material_rolling_spend``). Larger materials
    would be one task's work: then the sums of their days are attached
    (``with_rolling_spend``), as also where a purchase order has a price of its
    own or quantities finer than two decimals."""
    largest = largest_material(hot_source)
    of = quantity_type(po, "quantity_ordered")
    if largest > window_rows or of != QUANTITY_TYPE or "unit_price" in po.columns:
        return join_base(with_rolling_spend(po, materials, window_days), materials, suppliers, hot_source, largest)
    w = Window.partitionBy("material_id").orderBy(day_number("order_date")).rangeBetween(-window_days, 0)
    trailing = po.withColumn(TRAILING, F.sum(F.col("quantity_ordered").cast(of)).over(w))
    base = join_base(trailing, materials, suppliers, hot_source, largest)
    spend = cost(TRAILING, "unit_price", of).alias(ROLLING)
    return base.select(*[spend if c == TRAILING else F.col(f"`{c}`") for c in base.columns])


def line_cost(base: DataFrame) -> Column:
    return cost("quantity_ordered", "unit_price", quantity_type(base, "quantity_ordered"))


def delivery_columns(base: DataFrame) -> DataFrame:
    """line_cost, expected_delivery_date, delivery_variance_days, is_late."""
    expected = F.date_add(as_date("order_date"), F.col("lead_time_days").cast("int"))
    with_expected = base.select(
        "*",
        money(line_cost(base)).alias("line_cost"),
        expected.alias("expected_delivery_date"),
    )
    variance = days_between(as_date("received_date"), F.col("expected_delivery_date"))
    return with_expected.select("*", variance.alias("delivery_variance_days")).select(
        "*", is_late(F.col("delivery_variance_days")).alias("is_late")
    )


def material_consumption(
    base: DataFrame,
    *,
    window_days: int = ROLLING_DAYS,
    loaded_at: dt.datetime | None = None,
    rolling: DataFrame | None = None,
) -> DataFrame:
    """One row per purchase order: cost, delivery variance, trailing spend of
    its material over ``window_days`` days, and date parts.

    ``rolling``: the per-(material, day) spend from ``material_rolling_spend``;
    without it the spend is the one that ``base`` carries (``with_rolling_spend``),
    else computed from ``base`` (``rolling_range_sum``)."""
    b = delivery_columns(base)
    if ROLLING in base.columns:
        b = b.select(*[F.col(f"`{c}`") for c in b.columns if c != ROLLING], F.col(ROLLING).alias("rolling_90d_spend"))
    elif rolling is None:
        b = rolling_range_sum(b, ["material_id"], "order_date", line_cost(b), window_days, "rolling_90d_spend")
    else:
        b = attach_by_day(b, ["material_id"], "order_date", rolling, "rolling_90d_spend")
    b = b.withColumn("rolling_90d_spend", money("rolling_90d_spend"))
    b = b.select("*", *date_parts("order_date", "order", ("year", "month", "quarter")))
    return add_audit_columns(b, now(loaded_at))


def rolling_spend(base: DataFrame, window_days: int = ROLLING_DAYS, rolling: DataFrame | None = None) -> DataFrame:
    b = delivery_columns(base).select("po_id", "material_id", "order_date", "line_cost", "quantity_ordered", "unit_price")
    if rolling is None:
        b = rolling_range_sum(b, ["material_id"], "order_date", line_cost(b), window_days, "rolling_90d_spend")
    else:
        b = attach_by_day(b, ["material_id"], "order_date", rolling, "rolling_90d_spend")
    return b.withColumn("rolling_90d_spend", money("rolling_90d_spend")).drop("quantity_ordered", "unit_price")


def supplier_performance(
    base: DataFrame,
    *,
    as_of: dt.date | None = None,
    loaded_at: dt.datetime | None = None,
    spend=STRATEGIC_SPEND,
    on_time=ON_TIME_THRESHOLDS,
) -> DataFrame:
    """One scorecard row per supplier (unmatched materials: one NULL supplier).

    ``late_delivery_rate`` counts open purchase orders as on time (the
    documented KPI); ``late_delivery_rate_received`` is the rate over received
    ones only. One hash aggregate with partial aggregation; the exact distinct
    material count adds one (supplier, material) aggregation level.
    """
    b = delivery_columns(base).select(
        "*", (F.col("quantity_received") - F.col("quantity_ordered")).alias("qty_variance")
    )
    late = F.col("is_late").cast("int")
    sc = b.groupBy("supplier_id", "supplier_name").agg(
        F.count("po_id").alias("total_orders"),
        exact_sum(line_cost(b)).alias("total_spend"),
        exact_avg(line_cost(b)).alias("avg_order_value"),
        F.count_distinct("material_id").alias("unique_materials"),
        exact_avg("delivery_variance_days").alias("avg_delivery_variance_days"),
        F.sum(late).cast("bigint").alias("late_deliveries"),
        exact_avg(late).alias("late_delivery_rate"),
        exact_avg("qty_variance").alias("avg_qty_variance"),
        F.count_if(F.col("qty_variance") < 0).alias("short_shipments"),
        F.max("order_date").alias("last_order_date"),
        F.min("order_date").alias("first_order_date"),
        exact_avg(F.when(F.col("received_date").isNotNull(), late)).alias("late_delivery_rate_received"),
        F.count(F.lit(1)).alias("__tm_all"),
        F.sum(line_cost(b)).alias("__tm_spend"),
    )
    return scorecard(sc, as_of, loaded_at, spend, on_time)


def scorecard(aggregates: DataFrame, as_of: dt.date | None, loaded_at: dt.datetime | None, spend, on_time) -> DataFrame:
    """The scorecard's derived columns, their order and the audit columns."""
    on_time_rate = (F.lit(1) - F.col("late_delivery_rate")).cast("decimal(38,6)")
    sc = aggregates.select(
        "supplier_id", "supplier_name", "total_orders", "total_spend", "avg_order_value", "unique_materials",
        "avg_delivery_variance_days", "late_deliveries", "late_delivery_rate", "avg_qty_variance",
        "short_shipments", "last_order_date", "first_order_date",
        on_time_rate.alias("on_time_rate"),
        days_between(day_literal(today(as_of)), as_date("first_order_date")).alias("relationship_tenure_days"),
        tier_by_counts(F.col("__tm_all") - F.col("late_deliveries"), F.col("__tm_all"), F.col("__tm_spend"), spend, on_time).alias("supplier_tier"),
        "late_delivery_rate_received",
    )
    return add_audit_columns(sc, now(loaded_at), exclude=("relationship_tenure_days",))


#: What an incremental run keeps of the purchase orders, per supplier and
#: material: the materials that still have rows are the distinct ones.
PURCHASE_STATE = StateSpec(
    "po_id", ("supplier_id", "supplier_name", "material_id"),
    ("placed", "cost", "shown_cost", "variance", "late", "late_received", "qty_variance", "short"), ("order_date",),
)


def purchase_measures(base: DataFrame) -> DataFrame:
    """What each purchase order adds to its ``PURCHASE_STATE``."""
    b = delivery_columns(base)
    late, qty = F.col("is_late").cast("int"), F.col("quantity_received") - F.col("quantity_ordered")
    return b.select(
        "po_id", "supplier_id", "supplier_name", "material_id",
        F.col("po_id").isNotNull().cast("int").alias("placed"),
        line_cost(b).alias("cost"),
        line_cost(b).cast(WIDE_TYPE).alias("shown_cost"),
        F.col("delivery_variance_days").alias("variance"),
        late.alias("late"),
        F.when(F.col("received_date").isNotNull(), late).alias("late_received"),
        qty.cast(WIDE_TYPE).alias("qty_variance"),
        F.coalesce(qty < 0, F.lit(False)).cast("int").alias("short"),
        "order_date",
    )


def scorecard_of_states(
    states: DataFrame, *, as_of: dt.date | None = None, loaded_at: dt.datetime | None = None, spend=STRATEGIC_SPEND, on_time=ON_TIME_THRESHOLDS
) -> DataFrame:
    """``supplier_performance`` from the kept states."""
    added = states.groupBy("supplier_id", "supplier_name").agg(
        *[F.sum(c).alias(c) for c in PURCHASE_STATE.added_up()],
        F.count("material_id").alias("unique_materials"),
        F.max("max_order_date").alias("last_order_date"),
        F.min("min_order_date").alias("first_order_date"),
    )
    sc = added.select(
        "supplier_id", "supplier_name", "unique_materials", "last_order_date", "first_order_date",
        F.col("sum_placed").alias("total_orders"),
        state_sum("shown_cost").alias("total_spend"),
        state_avg("shown_cost").alias("avg_order_value"),
        state_avg("variance").alias("avg_delivery_variance_days"),
        F.when(F.col("count_late") > 0, F.col("sum_late")).alias("late_deliveries"),
        state_avg("late").alias("late_delivery_rate"),
        state_avg("qty_variance").alias("avg_qty_variance"),
        F.col("sum_short").alias("short_shipments"),
        state_avg("late_received").alias("late_delivery_rate_received"),
        F.col("rows").alias("__tm_all"),
        F.when(F.col("count_cost") > 0, F.col("sum_cost")).alias("__tm_spend"),
    )
    return scorecard(sc, as_of, loaded_at, spend, on_time)
