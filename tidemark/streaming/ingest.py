"""Load only the files that arrived since the last run.

The batch job's high-water mark for file datasets is the set of files already
loaded. Spark's file stream source keeps exactly that set in its checkpoint,
so an ``availableNow`` trigger reads every new file once and stops. Each
micro-batch is written with ``append_batch`` under its own batch id: a batch
replayed after a failure replaces its own output instead of adding a copy.
Nothing here holds state beyond the checkpoint folder, which must be on
shared storage (``tidemark.session.scratch_path`` gives one under
``spark.checkpoint.dir``).
"""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tidemark.sinks.tables import append_batch
from tidemark.sources.schema import load_schema


def ingest_new_files(
    spark: SparkSession,
    source_path: str,
    fmt: str,
    schema: StructType | str | Path | dict,
    target_path: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    max_files_per_batch: int | None = None,
    options: dict[str, str] | None = None,
) -> int:
    """Ingest the files of ``source_path`` not seen by ``checkpoint``; return
    the number of micro-batches run. A declared schema is required (a stream
    cannot infer one safely)."""
    reader = spark.readStream.format(fmt).schema(load_schema(schema))
    if fmt == "csv":
        reader = reader.option("header", "true").option("enforceSchema", "false")
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_batch))
    if options:
        reader = reader.options(**options)
    stream = reader.load(source_path)

    done: list[int] = []  # Spark keeps the progress of the last batches only

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        done.append(batch_id)
        append_batch(transform(batch) if transform else batch, target_path, batch_id)

    q = (
        stream.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return len(done)
