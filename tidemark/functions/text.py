"""String cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def trim_strings(df: DataFrame) -> DataFrame:
    """Trim leading/trailing spaces of every top-level string column.

    One projection for all columns (not a ``withColumn`` chain). Columns keep
    their names and order. ``trim`` strips the space character only, as in SQL.
    """
    cols = [
        F.trim(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, StringType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ]
    return df.select(*cols)
