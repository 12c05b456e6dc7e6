"""Data-quality operators: null filtering and table profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_nulls(df: DataFrame, columns: list[str]) -> DataFrame:
    """Drop rows where any of ``columns`` is NULL (a pushed-down filter)."""
    return df.dropna(how="any", subset=columns)


def table_profile(df: DataFrame, table: str) -> DataFrame:
    """Row count and NULL count per column, in one scan.

    One global aggregate (partial per task, one row per task shuffled) yields
    a single wide row, which is unpivoted to ``(table_name, column_name,
    column_position, row_count, null_count)``.
    """
    cols = df.columns
    aggs = [F.count(F.lit(1)).alias("row_count")]
    aggs += [F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(cols)]
    wide = df.agg(*aggs)
    pairs = [
        F.struct(F.lit(c).alias("column_name"), F.lit(i + 1).alias("column_position"), F.col(f"n{i}").alias("null_count"))
        for i, c in enumerate(cols)
    ]
    long = wide.select("row_count", F.explode(F.array(*pairs)).alias("p"))
    return long.select(
        F.lit(table).alias("table_name"),
        F.col("p.column_name").alias("column_name"),
        F.col("p.column_position").cast("int").alias("column_position"),
        F.col("row_count"),
        F.col("p.null_count").alias("null_count"),
    )
