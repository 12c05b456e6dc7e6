"""Table writers on plain files (parquet by default).

- overwrite: replace the table.
- append by batch: each batch lands in its own ``batch_id=<n>`` folder with
  dynamic partition overwrite, so re-running a batch (a retry) replaces that
  batch instead of adding a second copy.
- merge (upsert): the merged table lies in key-hash buckets, one folder
  ``_merged/key_bucket_<n>=<b>`` each. A merge finds the buckets of its batch,
  reads only these, and replaces only these; files of other buckets stay as
  they are, so its cost follows the batch. The rows of these buckets and those
  of the batch meet in one shuffle; rows whose hash the target has already
  keep the target's, so that unchanged rows touch no bucket. The new
  buckets are written to ``_pending`` and logged, which is the commit: readers
  see them from then on, and they are put in their places by a dynamic
  partition overwrite that is repeated by the next merge if it was broken off.
  It shuffles nothing, as a pending file holds rows of one bucket; where whole
  buckets are pending, their folders are moved. Of larger merges with a batch at
  rest only keys and hashes meet in the shuffle: they tell which rows of which
  file count, as one bit per row, and these are read and written without one.
  The first
  merge has no bucket to replace: it writes in place and is committed by its log;
  up to ``FIRST_TASKS`` tasks write their rows to the buckets without a shuffle.
  Files that another writer (overwrite, append) left at the path are the rows
  that the first merge starts from. A merged table is read with
  ``read_current``; its folders are hidden from a plain read of the path.
  One writer at a time may merge into a table.
"""

from __future__ import annotations

import datetime as dt
import os
import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType, TimestampNTZType

from tidemark.operators.changes import ROW_HASH, data_hash
from tidemark.operators.upsert import assert_unique, upsert
from tidemark.session import scratch_path

MODES = ("overwrite", "append", "merge")
LOG_DIR, DATA_DIR, PENDING_DIR = "_versions", "_merged", "_pending"
LOG_SCHEMA = StructType([
    StructField("version", LongType(), False), StructField("applied", BooleanType(), False), StructField("committed_at", TimestampNTZType(), False),
])
#: Buckets of a new merged table: size them so that a bucket is a few files (about 1 GB).
BUCKETS = 64
#: Pieces of a bucket that a merge deals to tasks of their own.
PIECES = 8
#: Tasks that may write the first merge as they are, a file per bucket each; more of them are rebalanced first.
FIRST_TASKS = 256
#: Fewer rows than these are rebalanced too: a small table has few files.
FIRST_ROWS = 100_000
#: Batches of fewer rows than these are shuffled whole in a merge.
PICK_ROWS = 100_000
#: Blocks of 32768 rows whose bits a merge broadcasts at most: 4 KB each, of two billion rows in all.
PICK_BLOCKS = 1 << 16
#: Row hashes are most of a mart's bytes: hex digits, of which half are packed away by an entropy coder.
PACKED = {"compression": "zstd"}
#: A row hash as ``functions.hashing`` writes it.
HASH_TEXT = r"^[0-9a-f]{64}\z"
#: Marks a pending row that came with the batch; buckets without one stay as they are.
CHANGED = "__tm_changed"
#: Where a row stands: its file (two hashes of the path, 96 bits) and its place there.
FILE, PLACE = ("__tm_file", "__tm_file2"), "__tm_place"
BUCKET_COLUMN = re.compile(r"key_bucket_(\d+)")


def _options(fmt: str) -> dict[str, str]:
    return PACKED if fmt == "parquet" else {}


def write_overwrite(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    w = df.write.mode("overwrite").format(fmt).options(**_options(fmt))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def append_batch(df: DataFrame, path: str, batch_id: int, fmt: str = "parquet", column: str = "batch_id") -> None:
    """Write ``df`` as batch ``batch_id``; writing the same batch again replaces it."""
    (
        df.withColumn(column, F.lit(int(batch_id)))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .format(fmt)
        .save(path)
    )


def load_plain(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """The table at the path, None if there is no folder or no data file."""
    try:
        return spark.read.format(fmt).load(path)
    except AnalysisException as exc:
        if any(m in str(exc) for m in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "does not exist")):
            return None
        raise


def _state(spark: SparkSession, path: str) -> tuple[int, bool]:
    """The newest committed version (0: none) and whether its buckets are in their places."""
    try:
        row = spark.read.schema(LOG_SCHEMA).json(os.path.join(path, LOG_DIR)).agg(F.max(F.struct("version", "applied")).alias("s")).first()
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc):
            return 0, True
        raise
    return (row.s.version, row.s.applied) if row.s else (0, True)


def _log(spark: SparkSession, path: str, version: int, applied: bool) -> None:
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    spark.createDataFrame([(version, applied, now)], LOG_SCHEMA).coalesce(1).write.mode("append").json(os.path.join(path, LOG_DIR))


def _bucket_column(df: DataFrame) -> str:
    return next(c for c in df.columns if BUCKET_COLUMN.fullmatch(c))


def _buckets_in(df: DataFrame, column: str) -> list[int]:
    """Distinct buckets of a table: at most as many as the table has."""
    return [r[0] for r in df.select(column).distinct().collect()]


def _pending(spark: SparkSession, path: str, fmt: str) -> DataFrame | None:
    """The pending buckets that a merge changed; None if all were moved to their places."""
    pending = load_plain(spark, os.path.join(path, PENDING_DIR), fmt)
    if pending is not None and CHANGED in pending.columns:
        column = _bucket_column(pending)
        pending = pending.filter(F.col(column).isin(_buckets_in(pending.filter(CHANGED), column))).drop(CHANGED)
    return pending


def _move(spark: SparkSession, source: str, target: str) -> bool:
    """Move the folders of ``source`` in the place of those in ``target``; False where the session
    has no way to the file system (Spark Connect).

    A folder leaves ``source`` only when it stands in its place, so a move that broke off is repeated."""
    try:
        paths, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    except Exception:  # noqa: BLE001 - Connect sessions have no JVM of their own
        return False
    fs = paths(source).getFileSystem(conf)
    fs.mkdirs(paths(target))
    for found in fs.listStatus(paths(source)):
        name = found.getPath().getName()
        if not found.isDirectory() or "=" not in name:
            continue
        place = paths(target, name)
        if fs.exists(place) and not fs.delete(place, True):
            raise OSError(f"cannot replace {place}")
        if not fs.rename(found.getPath(), place):
            raise OSError(f"cannot move {found.getPath()} to {place}")
    spark.catalog.refreshByPath(target)
    return True


def _place(spark: SparkSession, path: str, fmt: str, version: int) -> None:
    """Put the pending buckets in their places; repeating it changes nothing."""
    data, waiting = os.path.join(path, DATA_DIR), os.path.join(path, PENDING_DIR)
    there = load_plain(spark, waiting, fmt)
    if there is not None and (CHANGED in there.columns or not _move(spark, waiting, data)):
        pending = _pending(spark, path, fmt)
        (
            pending.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy(_bucket_column(pending)).format(fmt).options(**_options(fmt)).save(data)
        )
    _log(spark, path, version, True)


def _merged(spark: SparkSession, path: str, fmt: str) -> DataFrame | None:
    """The merged table with its bucket column: the buckets in their places, and pending ones instead of theirs."""
    version, applied = _state(spark, path)
    if not version:
        return None
    placed = load_plain(spark, os.path.join(path, DATA_DIR), fmt)
    if applied:
        return placed
    pending = _pending(spark, path, fmt)
    if pending is None:
        return placed
    column = _bucket_column(pending)
    if placed is None or column not in placed.columns:
        return pending
    return placed.filter(~F.col(column).isin(_buckets_in(pending, column))).unionByName(pending, allowMissingColumns=True)


def read_current(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """The merged table, or the plain files at the path if it was never merged
    into (None if there are none)."""
    merged = _merged(spark, path, fmt)
    return load_plain(spark, path, fmt) if merged is None else merged.drop(_bucket_column(merged))


def table_version(spark: SparkSession, path: str) -> int:
    """How many merges have changed the table (0: never merged into)."""
    return _state(spark, path)[0]


def read_near(spark: SparkSession, path: str, source: DataFrame, keys: list[str], fmt: str = "parquet") -> DataFrame | None:
    """The merged table's buckets that may hold the keys of ``source``; None if it was never merged into.

    Finding them reads the keys of ``source`` once; other buckets are not read."""
    target = _merged(spark, path, fmt)
    if target is None:
        return None
    column = _bucket_column(target)
    batch = _bucketed(_typed(source.select(*[F.col(f"`{k}`") for k in keys]), target), keys, column)
    return target.filter(F.col(column).isin(_buckets_in(batch, column))).drop(column)


def _bucketed(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    n = int(BUCKET_COLUMN.fullmatch(column).group(1))
    return df.withColumn(column, F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(n)).cast("int"))


def _hash_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c == ROW_HASH and isinstance(df.schema[c].dataType, StringType)]


def _bytes_for(df: DataFrame, names: list[str]) -> DataFrame:
    """Row hashes as their bytes, half as long in a shuffle; other values of these columns stay as they are."""
    for i, c in enumerate(names):
        is_hash = F.coalesce(F.col(f"`{c}`").rlike(HASH_TEXT), F.lit(False))
        df = df.withColumn(f"__tm_b{i}", F.when(is_hash, F.unhex(F.col(f"`{c}`")))).withColumn(c, F.when(~is_hash, F.col(f"`{c}`")))
    return df


def _texts_for(df: DataFrame, names: list[str]) -> DataFrame:
    """What ``_bytes_for`` was given."""
    for i, c in enumerate(names):
        df = df.withColumn(c, F.coalesce(F.lower(F.hex(F.col(f"__tm_b{i}"))), F.col(f"`{c}`"))).drop(f"__tm_b{i}")
    return df


def _resolved(near: DataFrame, batch: DataFrame, keys: list[str], column: str) -> DataFrame:
    """The bucketed rows of ``near`` after those of ``batch`` (same columns) took the place of rows with their key.

    One shuffle by bucket, in pieces, for both. A batch row that ``near`` has
    as it is (all columns but the ``_etl_`` ones, by their strict hash) is left
    out; ``CHANGED`` marks the others.
    """
    hashes = _hash_columns(near)
    both = _bytes_for(near, hashes).withColumn("__tm_new", F.lit(False)).unionByName(_bytes_for(batch, hashes).withColumn("__tm_new", F.lit(True)))
    hashed = _met(both, keys, column).withColumn("__tm_hash", F.unhex(data_hash(near.drop(column))))
    return _texts_for(_counting(hashed, keys, column), hashes).drop("__tm_new", "__tm_piece", "__tm_hash", "__tm_batch")


def _met(both: DataFrame, keys: list[str], column: str) -> DataFrame:
    """The rows of target and batch shuffled by bucket, in pieces."""
    piece = F.pmod(F.shiftrightunsigned(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), 32), F.lit(PIECES)).cast("int")
    return both.withColumn("__tm_piece", piece).repartition(F.col(column), F.col("__tm_piece"))


def _counting(hashed: DataFrame, keys: list[str], column: str) -> DataFrame:
    """The rows that count after a merge, with ``CHANGED``: batch rows that the target has not as they are, target rows that none of these replaces."""
    same_key = Window.partitionBy(column, "__tm_piece", *[F.col(f"`{k}`") for k in keys])
    beside = hashed.withColumn("__tm_batch", F.max(F.when(F.col("__tm_new"), F.col("__tm_hash"))).over(same_key))
    there = F.bool_or(~F.col("__tm_new") & F.col("__tm_hash").eqNullSafe(F.col("__tm_batch"))).over(same_key)
    return beside.withColumn(CHANGED, F.col("__tm_batch").isNotNull() & ~there).filter(F.col("__tm_new") == F.col(CHANGED))


def _located(df: DataFrame) -> DataFrame:
    """``df``, a plain read of Parquet files, with where each row stands."""
    path = F.col("_metadata.file_path")
    return df.select("*", F.xxhash64(path).alias(FILE[0]), F.hash(path).alias(FILE[1]), F.col("_metadata.row_index").alias(PLACE))


def _bits(near: DataFrame, batch: DataFrame, keys: list[str], column: str) -> DataFrame:
    """Per block of 32768 rows of a file: a bit for each row that counts after the merge (``__tm_bits``),
    ``CHANGED`` for the batch's files, the buckets of its rows.

    Both are ``_located``. One shuffle of keys and half a strict hash each (two
    rows of a key are compared, for which 128 bits do), one of places."""
    key = [F.col(f"`{k}`") for k in keys]
    digest = F.substring(F.unhex(data_hash(near.drop(column, *FILE, PLACE))), 1, 16).alias("__tm_hash")
    thin = [df.select(*key, column, digest, *FILE, PLACE, F.lit(new).alias("__tm_new")) for df, new in ((near, False), (batch, True))]
    counting = _counting(_met(thin[0].unionByName(thin[1]), keys, column), keys, column)
    number = F.col(PLACE) + 1
    rows = counting.select(column, *FILE, CHANGED, F.bitmap_bucket_number(number).alias("__tm_block"), F.bitmap_bit_position(number).alias("__tm_bit"))
    block = [*FILE, "__tm_block", CHANGED]
    return rows.repartition(*block).groupBy(*block).agg(F.bitmap_construct_agg("__tm_bit").alias("__tm_bits"), F.collect_set(column).alias("__tm_buckets"))


def _picked(located: DataFrame, bits: DataFrame) -> DataFrame:
    """The rows whose bit is set; no row is shuffled."""
    named = bits.select(*[F.col(c).alias(f"{c}_b") for c in FILE], F.col("__tm_block"), F.col("__tm_bits"))
    number = F.col(PLACE) + 1
    same = (F.col(FILE[0]) == F.col(f"{FILE[0]}_b")) & (F.col(FILE[1]) == F.col(f"{FILE[1]}_b")) & (F.bitmap_bucket_number(number) == F.col("__tm_block"))
    at = F.bitmap_bit_position(number)
    byte = F.conv(F.hex(F.substring("__tm_bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    is_set = F.expr("shiftright(__tm_byte, __tm_shift) & 1 = 1")
    joined = located.join(F.broadcast(named), same, "inner").withColumn("__tm_byte", byte).withColumn("__tm_shift", (at % 8).cast("int"))
    return joined.filter(is_set).drop(*named.columns, *FILE, PLACE, "__tm_byte", "__tm_shift")


def _write_picked(spark: SparkSession, near: DataFrame, batch: DataFrame, keys: list[str], column: str, pending: str) -> bool | None:
    """Write the buckets that the batch changes, whole, to ``pending``; False if it changes none,
    None if it has too many rows for their bits to be broadcast."""
    near, batch = _located(near), _located(batch)
    bits = stage(_bits(near, batch, keys, column), scratch_path(spark, "merge_bits"))
    if bits.count() > PICK_BLOCKS:
        return None
    of_batch = bits.filter(CHANGED)
    changed = [r[0] for r in of_batch.select(F.explode("__tm_buckets")).distinct().collect()]
    if not changed:
        return False
    kept = _picked(near.filter(F.col(column).isin(changed)), bits.filter(~F.col(CHANGED)))
    kept.unionByName(_picked(batch, of_batch)).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(column).format("parquet").options(**PACKED).save(pending)
    return True


def _typed(df: DataFrame, like: DataFrame) -> DataFrame:
    """``df`` with the types of ``like`` in the columns that both have: buckets of one table have one schema."""
    types = {f.name: f.dataType for f in like.schema.fields}
    return df.select(*[F.col(f"`{c}`").cast(types[c]).alias(c) if c in types else F.col(f"`{c}`") for c in df.columns])


def upsert_table(
    spark: SparkSession,
    source: DataFrame,
    path: str,
    keys: list[str],
    fmt: str = "parquet",
    check_unique: bool = True,
    buckets: int = BUCKETS,
    at_rest: bool = False,
) -> DataFrame:
    """Merge ``source`` into the table at ``path`` by ``keys``; return the table.

    ``check_unique=False`` skips the duplicate-key check (one aggregate job)
    for a source that is unique on ``keys`` by construction, e.g. the output
    of ``dedup_latest`` on the same keys. ``buckets`` counts for the first
    merge into a path only. ``source`` is read twice: stage one that is costly
    to compute. ``at_rest`` says that it is a plain read of Parquet files, whose
    rows can be told by file and place: then a larger batch is not shuffled. Values are cast to the target's types; a batch
    with columns new to the target rewrites all buckets, so that they keep one
    schema.
    """
    if not keys:
        raise ValueError("merge needs merge keys")
    if check_unique:
        assert_unique(source, keys)
    version, applied = _state(spark, path)
    if not applied:
        _place(spark, path, fmt, version)
    target = _merged(spark, path, fmt)
    if target is None:
        plain = load_plain(spark, path, fmt)
        column = f"key_bucket_{int(buckets)}"
        out = _bucketed(source if plain is None else upsert(plain, source, keys, check_unique=False), keys, column)
        last, count = source.select(F.spark_partition_id().alias("task")).agg(F.max("task"), F.count(F.lit(1))).first()
        if count < FIRST_ROWS or last >= FIRST_TASKS:
            out = out.hint("rebalance", column)
        (
            out.write.mode("overwrite").option("partitionOverwriteMode", "static")
            .partitionBy(column).format(fmt).options(**_options(fmt)).save(os.path.join(path, DATA_DIR))
        )
        _log(spark, path, version + 1, True)
        return read_current(spark, path, fmt)
    column = _bucket_column(target)
    rows = target.drop(column)
    batch = _bucketed(_typed(source, rows), keys, column)
    near = target
    if set(source.columns) <= set(rows.columns):
        touched = _buckets_in(batch, column)
        if not touched:
            return read_current(spark, path, fmt)
        near = target.filter(F.col(column).isin(touched))
    pending = os.path.join(path, PENDING_DIR)
    picked = None
    if at_rest and fmt == "parquet" and "_metadata" not in rows.columns and set(source.columns) == set(rows.columns) and source.count() >= PICK_ROWS:
        picked = _write_picked(spark, near, batch, keys, column, pending)
    if picked is False:  # the target has every row
        return read_current(spark, path, fmt)
    if picked:
        pass
    elif set(source.columns) == set(rows.columns):
        _resolved(near, batch, keys, column).write.mode("overwrite").partitionBy(column).format(fmt).options(**_options(fmt)).save(pending)
        if load_plain(spark, pending, fmt).filter(CHANGED).isEmpty():  # the target has every row
            return read_current(spark, path, fmt)
    else:
        merged = _typed(upsert(near.drop(column), batch.drop(column), keys, check_unique=False), rows)
        _bucketed(merged, keys, column).hint("rebalance", column).write.mode("overwrite").partitionBy(column).format(fmt).options(**_options(fmt)).save(pending)
    _log(spark, path, version + 1, False)
    _place(spark, path, fmt, version + 1)
    return read_current(spark, path, fmt)


def stage(df: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """Write ``df`` once and return a DataFrame over the written copy.

    Later counts, checks and loads read the copy instead of recomputing the
    plan (and re-reading sources that may have changed meanwhile).
    """
    df.write.mode("overwrite").format(fmt).options(**_options(fmt)).save(path)
    return df.sparkSession.read.format(fmt).load(path)


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    *,
    merge_keys: list[str] | None = None,
    batch_id: int | None = None,
    fmt: str = "parquet",
    at_rest: bool = False,
) -> None:
    """Dispatch on ``mode``; an unusable combination fails before any write. ``at_rest``: see ``upsert_table``."""
    if mode not in MODES:
        raise ValueError(f"write mode must be one of {MODES}, got {mode!r}")
    if mode == "merge":
        if not merge_keys:
            raise ValueError("mode 'merge' needs merge_keys")
        upsert_table(df.sparkSession, df, path, merge_keys, fmt, at_rest=at_rest)
    elif mode == "append":
        if batch_id is None:
            raise ValueError("mode 'append' needs a batch_id (it makes retries idempotent)")
        append_batch(df, path, batch_id, fmt)
    else:
        write_overwrite(df, path, fmt)
