"""Row hashes and audit columns for change detection."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.names import ident

AUDIT_PREFIX = "_etl_"


def row_hash(cols: list[str], strict: bool = False) -> Column:
    """SHA-256 (hex) over the columns' text, joined by ``|``.

    Default encoding: ``coalesce(cast(c as string), '')`` - compatible with
    existing hashes, but NULL and '' collide and a ``|`` inside a value can
    shift columns. ``strict=True`` encodes each value as ``<length>:<text>``
    and NULL as ``N``, which is unambiguous.

    Built as one SQL expression (one call into the JVM however wide the row).
    """
    if strict:
        parts = [
            f"CASE WHEN {ident(c)} IS NULL THEN 'N' "
            f"ELSE concat(CAST(length(CAST({ident(c)} AS STRING)) AS STRING), ':', CAST({ident(c)} AS STRING)) END"
            for c in cols
        ]
    else:
        parts = [f"coalesce(CAST({ident(c)} AS STRING), '')" for c in cols]
    return F.expr(f"sha2(concat_ws('|', {', '.join(parts)}), 256)")


def add_audit_columns(
    df: DataFrame,
    loaded_at: dt.datetime,
    exclude: tuple[str, ...] = (),
    strict: bool = False,
) -> DataFrame:
    """Append ``_etl_loaded_at`` (a given instant, TIMESTAMP_NTZ) and ``_etl_row_hash``.

    The hash covers every column not starting with ``_etl_``, in column order,
    except ``exclude`` (columns that change by themselves, e.g. "days since").
    """
    cols = [c for c in df.columns if not c.startswith(AUDIT_PREFIX) and c not in exclude]
    return df.select(
        "*",
        F.lit(loaded_at.isoformat(sep=" ")).cast("timestamp_ntz").alias("_etl_loaded_at"),
        row_hash(cols, strict=strict).alias("_etl_row_hash"),
    )
