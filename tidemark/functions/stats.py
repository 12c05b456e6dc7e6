"""Exact money sums and averages.

Sums and averages are computed in DECIMAL, not DOUBLE: a double sum depends
on the order rows are added in, i.e. on the partitioning, so the same input
would give different values (and different row hashes) on different cluster
layouts. Decimal sums are exact; averages are the exact quotient rounded
HALF_UP at ``scale`` digits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegralType

SUM_TYPE = DecimalType(38, 2)
AVG_SCALE = 6
# Digits kept before the one rounding at the end; products of these are exact DECIMAL(38,10).
WIDE_TYPE = DecimalType(38, 10)
QUANTITY_TYPE, FINE_QUANTITY_TYPE = DecimalType(17, 2), DecimalType(22, 8)
PRICE_TYPE = DecimalType(20, 8)


def quantity_type(df: DataFrame, column: str) -> DecimalType:
    """The decimal type that holds a quantity column's values: two digits for integers
    and decimals of up to two, eight digits for any other (DOUBLE) input."""
    t = df.schema[column].dataType
    if isinstance(t, IntegralType) or (isinstance(t, DecimalType) and t.scale <= QUANTITY_TYPE.scale and t.precision - t.scale <= 15):
        return QUANTITY_TYPE
    return FINE_QUANTITY_TYPE


def cost(quantity: Column | str, price: Column | str, of: DecimalType = QUANTITY_TYPE) -> Column:
    """``quantity * price`` with 10 decimals (11 for a fine ``of``), also for DOUBLE
    inputs (whose shortest decimal form counts); round only what is shown.

    ``of``: the quantity's ``quantity_type``."""
    q, p = (F.col(c) if isinstance(c, str) else c for c in (quantity, price))
    return q.cast(of) * p.cast(PRICE_TYPE)


def money(c: Column | str) -> Column:
    """Cast to the money type of mart outputs, DECIMAL(38,2)."""
    col = F.col(c) if isinstance(c, str) else c
    return col.cast(SUM_TYPE)


def exact_sum(c: Column | str) -> Column:
    """Exact sum as DECIMAL(38,2) (NULL when every input is NULL).

    Inputs keep 10 decimals; only the sum is rounded."""
    col = F.col(c) if isinstance(c, str) else c
    return F.sum(col.cast(WIDE_TYPE)).cast(SUM_TYPE)


def exact_avg(c: Column | str, scale: int = AVG_SCALE) -> Column:
    """Average of non-NULL values as DECIMAL(38, scale), rounded HALF_UP.

    Inputs keep 10 decimals, so Spark's decimal average has 14 before the
    rounding at ``scale``.
    """
    col = F.col(c) if isinstance(c, str) else c
    return F.avg(col.cast(DecimalType(28, 10))).cast(DecimalType(38, scale))
