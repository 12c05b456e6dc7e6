"""Incremental slices by a high-water mark, and the marks' state table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, LongType, StringType, StructField, StructType, TimestampNTZType


def typed_mark(df: DataFrame, column: str, mark: Any) -> Column:
    """The mark as a literal of the column's own type (never a string compare)."""
    dtype: DataType = df.schema[column].dataType
    return F.lit(str(mark) if isinstance(mark, (dt.date, dt.datetime)) else mark).cast(dtype)


def incremental_filter(
    df: DataFrame,
    column: str,
    mark: Any | None,
    overlap: dt.timedelta | None = None,
) -> DataFrame:
    """Rows after the mark: ``column > mark`` (a filter pushed into the scan).

    With ``overlap``, rows from ``mark - overlap`` on (inclusive) are read
    again, so rows that arrive late with a value at or just below the mark are
    not lost; deduplicate by key afterwards. No mark: everything.
    """
    if mark is None:
        return df
    lit = typed_mark(df, column, mark)
    col = F.col(f"`{column}`")
    if overlap is None:
        return df.filter(col > lit)
    if isinstance(df.schema[column].dataType, DateType):
        lower = F.date_sub(lit, overlap.days)
    else:
        secs = overlap.seconds + overlap.microseconds / 1e6
        lower = lit - F.make_dt_interval(F.lit(overlap.days), F.lit(0), F.lit(0), F.lit(secs))
    return df.filter(col >= lower)


def new_watermark(batch: DataFrame, table: str, column: str, previous: Any | None) -> DataFrame:
    """One row: the mark after loading ``batch`` (its max, or the previous mark
    when the batch is empty) and the number of new rows. A global aggregate:
    one partial row per task, one row to the driver if collected."""
    prev = typed_mark(batch, column, previous) if previous is not None else F.lit(None).cast(batch.schema[column].dataType)
    return batch.agg(
        F.max(F.col(f"`{column}`")).alias("m"),
        F.count(F.lit(1)).alias("new_rows"),
    ).select(
        F.lit(table).alias("table_name"),
        F.lit(column).alias("watermark_column"),
        prev.alias("previous_watermark"),
        F.coalesce(F.col("m"), prev).alias("new_watermark"),
        F.col("new_rows"),
    )


STATE_SCHEMA = StructType(
    [
        StructField("table_name", StringType(), False),
        StructField("watermark_column", StringType(), False),
        StructField("watermark", StringType(), True),
        StructField("run_id", LongType(), False),
        StructField("committed_at", TimestampNTZType(), False),
    ]
)


class WatermarkStore:
    """High-water marks per table, kept as an append-only table in a shared path.

    ``commit`` is called only after the sink has written the batch, so a
    failed run leaves the old mark and the next run re-reads the same slice
    (the sinks are idempotent per batch). Marks are stored as text and turned
    back into the column's type by ``typed_mark``.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def _log(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(STATE_SCHEMA).json(self.path)
        except Exception as exc:  # the folder does not exist yet
            if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc):
                return None
            raise

    def get(self, table: str) -> str | None:
        log = self._log()
        if log is None:
            return None
        row = (
            log.filter(F.col("table_name") == table)
            .orderBy(F.col("committed_at").desc(), F.col("run_id").desc())  # the last commit, whatever its run id
            .select("watermark")
            .limit(1)
            .collect()
        )
        return row[0]["watermark"] if row else None

    def commit(self, table: str, column: str, mark: Any, run_id: int) -> None:
        row = [(table, column, None if mark is None else str(mark), int(run_id), dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))]
        self.spark.createDataFrame(row, STATE_SCHEMA).coalesce(1).write.mode("append").json(self.path)


def load_increment(
    df: DataFrame,
    table: str,
    column: str,
    store: WatermarkStore,
    write: Callable[[DataFrame, int], None],
    run_id: int,
    overlap: dt.timedelta | None = None,
) -> dict[str, Any]:
    """Load the rows of ``df`` after the stored mark and advance the mark.

    ``write(batch, run_id)`` is the sink (e.g. ``append_batch`` into a
    ``batch_id`` folder, which makes a retried run replace its own output).
    The new mark and the row count are observed during that write - the batch
    is computed once - and committed only after the write returned; a failed
    write leaves the old mark, so the next run reads the same slice again.
    """
    mark = store.get(table)
    batch = incremental_filter(df, column, mark, overlap)
    obs = Observation(f"increment_{table}_{run_id}")
    value = F.col(f"`{column}`")
    if mark is not None:  # rows of the overlap never lower the mark
        value = F.greatest(value, typed_mark(df, column, mark))
    observed = batch.observe(obs, F.max(value).alias("m"), F.count(F.lit(1)).alias("n"))
    write(observed, run_id)
    got = obs.get
    new_mark = got["m"] if got["m"] is not None else mark
    store.commit(table, column, new_mark, run_id)
    return {"table": table, "previous": mark, "new": None if new_mark is None else str(new_mark), "rows": int(got["n"])}
