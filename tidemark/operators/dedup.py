"""Deterministic deduplication by key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from tidemark.functions.names import ident


def orderable(dt: DataType) -> bool:
    """Whether Spark can sort by a value of this type (maps cannot)."""
    if isinstance(dt, MapType):
        return False
    if isinstance(dt, ArrayType):
        return orderable(dt.elementType)
    if isinstance(dt, StructType):
        return all(orderable(f.dataType) for f in dt.fields)
    return dt.typeName() != "variant"


def latest_first_order(df: DataFrame, keys: list[str], recency: list[str] | None) -> list[str]:
    """Total order inside a key, as SQL sort items: recency columns descending
    (NULLs last), then every other sortable column ascending (NULLs first) as
    the tie-break. Map columns cannot be sorted and take no part in it."""
    recency = list(recency or [])
    rest = [f.name for f in df.schema.fields if f.name not in keys and f.name not in recency and orderable(f.dataType)]
    return [f"{ident(c)} DESC NULLS LAST" for c in recency] + [f"{ident(c)} ASC NULLS FIRST" for c in rest]


def dedup_latest(df: DataFrame, keys: list[str], recency: list[str] | None = None) -> DataFrame:
    """Keep one row per ``keys``: the most recent by ``recency``, ties broken by
    all remaining columns, so the kept row does not depend on partitioning.

    Plan: ``row_number() = 1`` over the key. Catalyst inserts a partial
    ``WindowGroupLimit`` before the shuffle, so each map task sends at most one
    row per key; a key holding a third of the input costs one row per map
    task in the exchange, not a third of the data. The window is written as
    one SQL expression (one call into the JVM however wide the row).

    The tie-break reads every column of ``df``. Where versions of a key can
    never tie on ``recency`` (or any tied version will do), select the needed
    columns first: the scan then reads only those.
    """
    if set(df.columns) <= set(keys):
        # nothing but keys: any row of a key is the same row (a hash aggregate)
        return df.dropDuplicates(keys)
    order = latest_first_order(df, keys, recency)
    if not order:  # only map columns besides the keys: any fixed order will do
        order = [f"{ident(k)} ASC" for k in keys]
    rn = "__tm_rn"
    number = F.expr(f"row_number() OVER (PARTITION BY {', '.join(ident(k) for k in keys)} ORDER BY {', '.join(order)})")
    return df.withColumn(rn, number).filter(F.col(rn) == 1).drop(rn)
