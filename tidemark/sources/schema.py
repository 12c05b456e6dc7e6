"""Declared schemas: load them, and check data against them."""

from __future__ import annotations

import json
import re
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

# fixed values: type names of the simple schema-file convention ("float" means DOUBLE)
SIMPLE_TYPES: dict[str, DataType] = {
    "string": StringType(),
    "integer": IntegerType(),
    "long": LongType(),
    "double": DoubleType(),
    "float": DoubleType(),
    "boolean": BooleanType(),
    "date": DateType(),
    "timestamp": TimestampType(),
}

# Spark SQL type names accepted in addition (same meaning as in Spark DDL).
SPARK_TYPES: dict[str, DataType] = {
    "int": IntegerType(),
    "bigint": LongType(),
    "smallint": ShortType(),
    "short": ShortType(),
    "tinyint": ByteType(),
    "byte": ByteType(),
    "real": FloatType(),
    "binary": BinaryType(),
    "timestamp_ntz": TimestampNTZType(),
    "timestamp_ltz": TimestampType(),
}

_DECIMAL = re.compile(r"^decimal\s*\(\s*(\d+)\s*,\s*(\d+)\s*\)$")


class SchemaError(ValueError):
    """A schema file or a type name that cannot be used."""


def parse_type(name: str, field: str = "?") -> DataType:
    key = name.strip().lower()
    if key in SIMPLE_TYPES:
        return SIMPLE_TYPES[key]
    if key in SPARK_TYPES:
        return SPARK_TYPES[key]
    m = _DECIMAL.match(key)
    if m:
        return DecimalType(int(m.group(1)), int(m.group(2)))
    raise SchemaError(f"field '{field}' has no Spark type for '{name}'")


def _schema_text(path: str) -> str:
    """A schema file's text: a driver-local path, or any URI that Spark's readers open."""
    local = Path(path)
    if local.exists():
        return local.read_text()
    spark = SparkSession.getActiveSession()
    if "://" in path and spark is not None:
        try:
            return spark.read.text(path, wholetext=True).first()[0]
        except AnalysisException as exc:
            if "PATH_NOT_FOUND" not in str(exc):
                raise
    raise FileNotFoundError(f"schema file not found: {path}")


def load_schema(source: str | Path | dict | StructType) -> StructType:
    """A ``StructType`` from a schema file, a parsed dict or a StructType.

    Two file layouts are accepted: the simple convention
    ``{"fields": [{"name", "type": "<name>", "nullable"}]}`` (type names above,
    ``nullable`` defaults to true) and Spark's own JSON (``StructType.json()``),
    which covers nested and complex types. A missing file is an error: a
    declared schema never silently falls back to inference.
    """
    if isinstance(source, StructType):
        return source
    if isinstance(source, (str, Path)):
        raw = json.loads(_schema_text(str(source)))
    else:
        raw = source
    fields = raw.get("fields")
    if not isinstance(fields, list):
        raise SchemaError("schema needs a 'fields' list")
    if any(isinstance(f.get("type"), dict) or "metadata" in f for f in fields):
        return StructType.fromJson(raw)
    out = []
    for f in fields:
        t = f.get("type")
        if not isinstance(t, str):
            raise SchemaError(f"field '{f.get('name')}' has no type name")
        out.append(StructField(f["name"], parse_type(t, f["name"]), bool(f.get("nullable", True))))
    return StructType(out)


def _reasons(df: DataFrame, schema: StructType) -> list[Column]:
    checks = []
    for f in schema.fields:
        c = F.col(f"`{f.name}`")
        if df.schema[f.name].dataType != f.dataType:
            bad = c.isNotNull() & c.try_cast(f.dataType).isNull()
            checks.append(F.when(bad, F.lit(f"{f.name}: not a {f.dataType.simpleString()}")))
        if not f.nullable:
            checks.append(F.when(c.isNull(), F.lit(f"{f.name}: null")))
    return checks


def flag_schema_violations(df: DataFrame, schema: StructType | str | Path | dict) -> DataFrame:
    """``df`` plus ``_reject_reason``: every violation of ``schema`` in the row
    (declared not-null fields that are NULL, values that do not convert to the
    declared type), in field order, ``; ``-separated; NULL for a valid row.

    One projection: write it once (e.g. partitioned by
    ``_reject_reason IS NULL``) to keep valid and rejected rows in one pass.
    Missing columns raise at once.
    """
    schema = load_schema(schema)
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise SchemaError(f"columns missing from data: {missing}")
    checks = _reasons(df, schema)
    reason = F.concat_ws("; ", *checks) if checks else F.lit("")
    return df.select("*", F.nullif(reason, F.lit("")).alias("_reject_reason"))


def validate_schema(df: DataFrame, schema: StructType | str | Path | dict) -> tuple[DataFrame, DataFrame]:
    """Split ``df`` into rows that satisfy ``schema`` and rejected rows.

    Spark's file readers make every field nullable and turn malformed values
    into NULL, so ``nullable: false`` and types are not enforced on read. Here
    every declared not-null field is checked, and every value that does not
    convert to its declared type is flagged (``flag_schema_violations``).
    ``valid`` has the declared types; ``rejected`` keeps the original values
    plus ``_reject_reason``. Both are filters of one projection.
    """
    schema = load_schema(schema)
    flagged = flag_schema_violations(df, schema)
    # try_cast: valid rows convert by definition, and no evaluation order can
    # make a rejected value fail the query under ANSI mode
    valid = flagged.filter(F.col("_reject_reason").isNull()).select(
        *[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields]
    )
    rejected = flagged.filter(F.col("_reject_reason").isNotNull())
    return valid, rejected
