"""Writers: overwrite, idempotent append by batch, versioned upsert, staging."""

from tidemark.sinks.tables import (
    append_batch,
    read_current,
    stage,
    upsert_table,
    write_overwrite,
    write_table,
)

__all__ = ["append_batch", "read_current", "stage", "upsert_table", "write_overwrite", "write_table"]
