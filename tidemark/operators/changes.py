"""Change detection: two versions of a table compared by key and row hash."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.hashing import AUDIT_PREFIX, row_hash

ROW_HASH = "_etl_row_hash"
INSERTED, UPDATED, UNCHANGED, ABSENT = "inserted", "updated", "unchanged", "absent"


def data_hash(df: DataFrame) -> Column:
    """Unambiguous hash of the columns that are not ``_etl_`` ones, whatever their order."""
    return row_hash(sorted(c for c in df.columns if not c.startswith(AUDIT_PREFIX)), strict=True)


def hashed_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """The keys and the row hash of each row: the table's own hash column, else a strict one over its data columns."""
    if ROW_HASH in df.columns:
        return df.select(*[F.col(f"`{k}`") for k in keys], ROW_HASH)
    return df.select(*[F.col(f"`{k}`") for k in keys], data_hash(df).alias(ROW_HASH))


def _same(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[f"__tm_c{i}"]) for i, k in enumerate(keys)])


def _beside(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys and hash of ``df`` under names of their own, and a marker that tells a missing row from NULL keys."""
    names = [F.col(f"`{k}`").alias(f"__tm_c{i}") for i, k in enumerate(keys)]
    return hashed_keys(df, keys).select(*names, F.col(ROW_HASH).alias("__tm_hash"), F.lit(True).alias("__tm_there"))


def row_changes(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, change``: what a merge of ``source`` into ``target`` does with each key.

    One full outer join of keys and hashes (no other column is read where the
    tables carry ``_etl_row_hash``); keys match null-safe and must be unique on
    both sides. ``absent``: in the target only, a merge leaves it alone.
    """
    new = hashed_keys(source, keys).withColumn("__tm_here", F.lit(True))
    old = _beside(target, keys)
    both = new.join(old, _same(new, old, keys), "full_outer")
    change = (
        F.when(F.col("__tm_there").isNull(), INSERTED)
        .when(F.col("__tm_here").isNull(), ABSENT)
        .when(F.col(ROW_HASH).eqNullSafe(F.col("__tm_hash")), UNCHANGED)
        .otherwise(UPDATED)
    )
    shown = [F.when(F.col("__tm_here"), F.col(f"`{k}`")).otherwise(F.col(f"__tm_c{i}")).alias(k) for i, k in enumerate(keys)]
    return both.select(*shown, change.alias("change"))


def changed_rows(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of ``source`` that the target does not hold as they are.

    All columns but the ``_etl_`` ones are compared, by their strict hash: the
    stored ``_etl_row_hash`` leaves out columns that change by themselves and
    takes NULL and '' for equal, so it would keep stale values.
    """
    names = [F.col(f"`{k}`").alias(f"__tm_c{i}") for i, k in enumerate(keys)]
    old = target.select(*names, data_hash(target).alias("__tm_hash"))
    new = source.withColumn("__tm_new", data_hash(source))
    same = _same(new, old, keys) & new["__tm_new"].eqNullSafe(old["__tm_hash"])
    return new.join(old, same, "left_anti").drop("__tm_new")


def changed_keys(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """The keys whose row came, went or changed between two versions."""
    changes = row_changes(before, after, keys)
    return changes.filter(F.col("change") != UNCHANGED).select(*[F.col(f"`{k}`") for k in keys])
