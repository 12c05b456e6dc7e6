"""Column references by name, safe for names with dots or spaces."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ident(name: str) -> str:
    """A quoted identifier for SQL text."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    """``F.col`` of a plain column name (never parsed as a nested path)."""
    return F.col(ident(name))
