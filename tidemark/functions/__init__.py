"""Column builders: everything here returns a ``Column`` or a projected DataFrame
and stays inside whole-stage codegen (no Python UDFs)."""

from tidemark.functions.dates import as_date, date_parts, days_between
from tidemark.functions.hashing import add_audit_columns, row_hash
from tidemark.functions.rules import customer_segment, is_late, stock_health, supplier_tier
from tidemark.functions.stats import exact_avg, exact_sum, money
from tidemark.functions.text import trim_strings

__all__ = [
    "add_audit_columns",
    "as_date",
    "customer_segment",
    "date_parts",
    "days_between",
    "exact_avg",
    "exact_sum",
    "is_late",
    "money",
    "row_hash",
    "stock_health",
    "supplier_tier",
    "trim_strings",
]
