"""Business classification rules (searched CASE, first match wins)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: default thresholds of the marts
SEGMENT_THRESHOLDS = (10000, 5000, 1000)  # platinum, gold, silver lifetime value
OVERSTOCK_FACTOR = 5
STRATEGIC_SPEND = 100000
ON_TIME_THRESHOLDS = (0.95, 0.85, 0.70)  # strategic/preferred, approved, under_review cut-offs


def customer_segment(ltv: Column, thresholds=SEGMENT_THRESHOLDS) -> Column:
    """platinum / gold / silver by lifetime value, else bronze (NULL -> bronze)."""
    plat, gold, silver = thresholds
    return (
        F.when(ltv >= plat, "platinum")
        .when(ltv >= gold, "gold")
        .when(ltv >= silver, "silver")
        .otherwise("bronze")
    )


def needs_reorder(qty: Column, level: Column) -> Column:
    """Stock at or below the reorder level; unknown level or quantity -> false."""
    return F.coalesce(qty <= level, F.lit(False))


def stock_health(qty: Column, level: Column, overstock_factor=OVERSTOCK_FACTOR) -> Column:
    """out_of_stock, low_stock, overstock, healthy - in that order of precedence."""
    return (
        F.when(qty == 0, "out_of_stock")
        .when(needs_reorder(qty, level), "low_stock")
        .when(qty > level * overstock_factor, "overstock")
        .otherwise("healthy")
    )


def is_late(variance_days: Column) -> Column:
    """Delivered after the expected day; not delivered (NULL) counts as not late."""
    return F.coalesce(variance_days > 0, F.lit(False))


def tier_by_counts(
    on_time: Column,
    total: Column,
    total_spend: Column,
    spend=STRATEGIC_SPEND,
    thresholds=ON_TIME_THRESHOLDS,
) -> Column:
    """``supplier_tier`` decided on the counts (``on_time >= threshold * total``,
    exact decimals), not on a rate rounded for display."""
    top, mid, low = (F.lit(Decimal(str(t))) * total for t in thresholds)
    return (
        F.when((on_time >= top) & (total_spend >= spend), "strategic")
        .when(on_time >= mid, "preferred")
        .when(on_time >= low, "approved")
        .otherwise("under_review")
    )


def supplier_tier(
    on_time_rate: Column,
    total_spend: Column,
    spend=STRATEGIC_SPEND,
    on_time=ON_TIME_THRESHOLDS,
) -> Column:
    """strategic needs both the top on-time rate and the spend; then by rate only."""
    top, mid, low = on_time
    return (
        F.when((on_time_rate >= top) & (total_spend >= spend), "strategic")
        .when(on_time_rate >= mid, "preferred")
        .when(on_time_rate >= low, "approved")
        .otherwise("under_review")
    )
