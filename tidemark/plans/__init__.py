"""The five marts and the runner that reads, builds, stages and writes them."""

from tidemark.plans.customer import customer_360, order_enriched
from tidemark.plans.inventory import inventory_snapshot
from tidemark.plans.supply import material_consumption, po_base, supplier_performance

__all__ = [
    "customer_360",
    "inventory_snapshot",
    "material_consumption",
    "order_enriched",
    "po_base",
    "supplier_performance",
]
