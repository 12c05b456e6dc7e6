"""File datasets (parquet, CSV, JSON, any Spark file format) with declared schemas."""

from __future__ import annotations

from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.session import scratch_path
from tidemark.sinks.tables import stage
from tidemark.sources.schema import load_schema


def read_dataset(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: StructType | str | Path | dict | None = None,
    *,
    multiline: bool = False,
    strict_header: bool = True,
    options: dict[str, Any] | None = None,
) -> DataFrame:
    """Read one dataset.

    - parquet (default), orc, text...: handed to Spark as is; Hive-style
      ``key=value`` folders become partition columns, filters on them prune
      folders.
    - CSV: header row, no type inference (types come from ``schema`` or all
      are strings). With a schema and ``strict_header`` the header must name
      the declared columns (``enforceSchema=false``): a reordered file fails
      instead of binding columns by position.
    - JSON: one record per line unless ``multiline`` (one document per file).
    """
    fmt = fmt.lower()
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(load_schema(schema))
    if fmt == "csv":
        reader = reader.option("header", "true").option("inferSchema", "false")
        if schema is not None and strict_header:
            reader = reader.option("enforceSchema", "false")
    elif fmt == "json":
        reader = reader.option("multiLine", "true" if multiline else "false")
    if options:
        reader = reader.options(**{k: str(v) for k, v in options.items()})
    return reader.load(path)


CORRUPT = "_corrupt_record"


def read_checked(
    spark: SparkSession,
    path: str,
    fmt: str,
    schema: StructType | str | Path | dict,
    *,
    multiline: bool = False,
    options: dict[str, Any] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """A CSV or JSON dataset as ``(valid, rejected)`` rows.

    A plain read turns a value that does not parse into NULL and loses the
    text. Here the reader keeps the text of each malformed record
    (``_corrupt_record``), and ``_reject_reason`` names every field whose text
    is not of its type, every missing field that must not be NULL, and records
    that cannot be parsed at all. ``valid`` has the declared columns;
    ``rejected`` adds the text and the reason.

    The judged rows are written once (readers parse only the columns that a
    query selects, and would find other errors for each query); both results
    read that copy.
    """
    fmt, schema = fmt.lower(), load_schema(schema)
    if fmt not in ("csv", "json"):
        raise ValueError(f"malformed records are told apart in csv and json, not {fmt}")
    read = StructType([*(StructField(f.name, f.dataType) for f in schema.fields), StructField(CORRUPT, StringType())])
    extra = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, **({"columnPruning": "false"} if fmt == "csv" else {})}
    rows = read_dataset(spark, path, fmt, read, multiline=multiline, options={**(options or {}), **extra})

    text = F.col(CORRUPT)
    if fmt == "csv":
        layout = ", ".join(f"`{f.name}` STRING" for f in schema.fields)
        parts = F.from_csv(text, layout, {k: str(v) for k, v in (options or {}).items()})
        given = {f.name: parts[f.name] for f in schema.fields}
    else:
        given = {f.name: F.get_json_object(text, f"$['{f.name}']") for f in schema.fields}
    wrong = [
        F.when(text.isNotNull() & F.col(f"`{f.name}`").isNull() & given[f.name].isNotNull(), F.lit(f"{f.name}: not a {f.dataType.simpleString()}"))
        for f in schema.fields
    ]
    missing = [
        F.when(F.col(f"`{f.name}`").isNull() & given[f.name].isNull(), F.lit(f"{f.name}: null")) for f in schema.fields if not f.nullable
    ]
    unread = text.isNotNull() & F.coalesce(*[given[f.name] for f in schema.fields]).isNull()
    found = F.nullif(F.concat_ws("; ", *wrong, *missing), F.lit(""))
    reason = F.when(unread, F.lit("malformed record")).otherwise(F.coalesce(found, F.when(text.isNotNull(), F.lit("malformed record"))))
    judged = stage(rows.withColumn("_reject_reason", reason), scratch_path(spark, "judged"))
    ok = F.col("_reject_reason").isNull()
    return judged.filter(ok).select(*[F.col(f"`{f.name}`") for f in schema.fields]), judged.filter(~ok)


def read_datasets(spark: SparkSession, datasets: list[dict[str, Any]], taken: set[str] | None = None) -> dict[str, DataFrame]:
    """Read every dataset of a list of ``{name, path, file_format, schema, multiline}``.

    A name that is already taken (e.g. by a JDBC table) is an error rather than
    a silent replacement.
    """
    taken = set(taken or ())
    out: dict[str, DataFrame] = {}
    for ds in datasets:
        name = ds["name"]
        if name in taken or name in out:
            raise ValueError(f"dataset name '{name}' is used twice")
        out[name] = read_dataset(
            spark,
            ds["path"],
            ds.get("file_format", "parquet"),
            ds.get("schema"),
            multiline=bool(ds.get("multiline", False)),
            options=ds.get("options"),
        )
    return out
