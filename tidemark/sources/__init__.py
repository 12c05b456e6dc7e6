"""Readers: files with declared schemas, JDBC tables, incremental slices."""

from tidemark.sources.files import read_checked, read_dataset, read_datasets
from tidemark.sources.incremental import WatermarkStore, incremental_filter, load_increment, new_watermark
from tidemark.sources.jdbc import discover_bounds, jdbc_options, read_jdbc
from tidemark.sources.schema import flag_schema_violations, load_schema, validate_schema

__all__ = [
    "WatermarkStore",
    "discover_bounds",
    "flag_schema_violations",
    "incremental_filter",
    "load_increment",
    "jdbc_options",
    "load_schema",
    "new_watermark",
    "read_checked",
    "read_dataset",
    "read_datasets",
    "read_jdbc",
    "validate_schema",
]
