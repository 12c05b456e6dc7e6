"""Date handling that works for DATE, TIMESTAMP and TIMESTAMP_NTZ inputs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(c: Column | str) -> Column:
    """Calendar day of a DATE / TIMESTAMP / TIMESTAMP_NTZ column."""
    col = F.col(c) if isinstance(c, str) else c
    return F.to_date(col)


def days_between(end: Column, start: Column) -> Column:
    """Whole days from ``start`` to ``end`` (``datediff``), INT."""
    return F.datediff(end, start)


def day_literal(day: dt.date | str) -> Column:
    """A DATE literal; replaces ``current_date()`` so results are repeatable."""
    if isinstance(day, str):
        day = dt.date.fromisoformat(day)
    return F.lit(day)


# fixed values: output name -> Spark date-part function, as used by the marts
_PARTS = {
    "year": F.year,
    "month": F.month,
    "dow": F.dayofweek,  # 1 = Sunday ... 7 = Saturday
    "quarter": F.quarter,
}


def date_parts(c: Column | str, prefix: str, parts: tuple[str, ...]) -> list[Column]:
    """``[year(c) AS <prefix>_year, ...]`` for the requested parts (INT)."""
    col = as_date(c)
    return [_PARTS[p](col).cast("int").alias(f"{prefix}_{p}") for p in parts]
