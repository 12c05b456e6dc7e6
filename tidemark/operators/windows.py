"""Window operators: per-group ranking and trailing date-range sums."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    MapType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from tidemark.functions.names import col as _q


def _key_default(dtype: DataType) -> Column:
    """A non-NULL stand-in of the column's type (paired with an is-NULL flag)."""
    if isinstance(dtype, StringType):
        return F.lit("")
    if isinstance(dtype, BooleanType):
        return F.lit(False)
    if isinstance(dtype, BinaryType):
        return F.lit(bytearray())
    if isinstance(dtype, (ArrayType, MapType, StructType)):
        raise TypeError(f"cannot split groups on a {dtype.simpleString()} column")
    if isinstance(dtype, DateType):
        return F.lit(dt.date(1970, 1, 1))
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        return F.lit("1970-01-01 00:00:00").cast(dtype)
    return F.lit(0).cast(dtype)


# Rows of a group that one task handles comfortably, and the share of all rows
# (1/HOT_GROUPS) below which a group is never a hot one.
MAX_GROUP_ROWS = 1_000_000
HOT_GROUPS = 65536


def hot_counts(counts: DataFrame, names: list[str], max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """``names`` and ``__tm_pieces`` of the groups of ``counts`` (with ``__tm_rows``)
    that hold more than ``max_group_rows`` rows and more than ``1/HOT_GROUPS`` of all rows.

    Fewer than ``HOT_GROUPS`` groups can hold such a share, so the result is
    small at any input size and is broadcast; no group is left out by a limit.
    A lazy DataFrame: building it runs no job.
    """
    share = counts.agg(F.sum("__tm_rows") / F.lit(HOT_GROUPS)).scalar()
    rows = F.col("__tm_rows")
    hot = counts.filter((rows > max_group_rows) & (rows > share))
    return F.broadcast(hot.select(*names, F.ceil(rows / F.lit(max_group_rows)).cast("int").alias("__tm_pieces")))


def hot_groups(source: DataFrame, group: list[str], max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """The hot groups of ``source`` as ``__tm_h0, ..., __tm_pieces``: an exact count of
    all rows (NULL keys too), one pruned scan with partial aggregation."""
    names = [f"__tm_h{i}" for i in range(len(group))]
    keys = source.select(*[_q(g).alias(n) for g, n in zip(group, names)])
    return hot_counts(keys.groupBy(*names).agg(F.count(F.lit(1)).alias("__tm_rows")), names, max_group_rows)


# Items that a summary of frequent keys tracks: the built-in sketch then keeps 65536
# counters and errs by at most 3.5/65536 of all rows, so that no key above twice that
# (and 1/SUMMARY_GROUPS is more) can be missing from its answer.
SUMMARY_GROUPS = 4096
SUMMARY_ITEMS = 49152
SUMMARY_BUCKETS = 512
# Key types the summary takes and that survive the way through the driver unchanged.
SUMMARY_TYPES = (BooleanType, ByteType, ShortType, IntegerType, LongType, DecimalType, StringType, DateType)


def hot_keys(source: DataFrame, columns: list[str], max_group_rows: int = MAX_GROUP_ROWS) -> dict[str, DataFrame]:
    """Hot keys of several columns of ``source``, NULL included, from one pass over it.

    Per column a mergeable summary of frequent items (bounded counters, built
    in) is kept by each task, merged per bucket of tasks, then once more. A key
    with more than ``max_group_rows`` rows and more than ``1/SUMMARY_GROUPS``
    of all rows is always found; counts are upper bounds. The result has an
    entry (``__tm_h0``, ``__tm_pieces``) only for columns that have hot keys,
    fewer than ``SUMMARY_GROUPS`` rows each, so that a plan without hot keys
    stays a plain join or window. Runs one job, before it a row count that reads
    no column: a table of at most ``max_group_rows`` rows has no hot key. Columns
    of a type the summary does not take are counted exactly and lazily
    (``hot_groups``).
    """
    types = {c: source.schema[c].dataType for c in columns}
    exact = {c: hot_groups(source, [c], max_group_rows) for c in columns if not isinstance(types[c], SUMMARY_TYPES)}
    names = [c for c in columns if c not in exact]
    if not names or source.select().count() <= max_group_rows:
        return exact
    kept = source.select(*[_q(c).alias(f"k{i}") for i, c in enumerate(names)])
    each = [F.expr(f"approx_top_k_accumulate(k{i}, {SUMMARY_ITEMS})").alias(f"k{i}") for i in range(len(names))]
    merged = [F.expr(f"approx_top_k_estimate(approx_top_k_combine(k{i}, {SUMMARY_ITEMS}), {SUMMARY_GROUPS})").alias(f"k{i}") for i in range(len(names))]
    tasks = kept.groupBy(F.pmod(F.spark_partition_id(), F.lit(SUMMARY_BUCKETS)).alias("b")).agg(*each, F.count(F.lit(1)).alias("n"))
    found = tasks.agg(*merged, F.sum("n").alias("n")).first()
    total = found["n"]
    hot = {}
    for i, c in enumerate(names):
        rows = [(r["item"], -(-r["count"] // max_group_rows)) for r in found[f"k{i}"] or () if r["count"] > max_group_rows and r["count"] * SUMMARY_GROUPS > total]
        if rows:
            schema = StructType([StructField("__tm_h0", types[c]), StructField("__tm_pieces", IntegerType())])
            hot[c] = F.broadcast(source.sparkSession.createDataFrame(rows, schema))
    return {**exact, **hot}


def rank_within(
    df: DataFrame,
    group: list[str],
    order: list[Column],
    out: str,
    split: list[tuple[Column, str]] | None = None,
    hot_source: DataFrame | None = None,
    max_group_rows: int = MAX_GROUP_ROWS,
    hot: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """``row_number()`` inside each group, by ``order`` (1 = first).

    ``order`` must be a total order inside the group (end it with a unique
    column) for the numbering to be repeatable.

    Without ``split``: one window, one shuffle on ``group``; every row of a
    group is sorted by one task.

    With ``split`` - ``(column, direction)`` pairs whose values never decrease
    along ``order`` (direction ``asc_nulls_first`` or ``desc_nulls_last``, e.g.
    the day of the date that ``order`` sorts first) - the hot groups
    (``hot``, as ``hot_keys`` returns them, else found in ``hot_source``,
    default ``df``; pass the raw input when ``df`` is expensive to recompute)
    are ranked in sub-buckets (``split_rank``); every other group is one
    bucket. One window serves both; without hot groups it is the plain one.
    """
    if split and len(group) == 1:
        if hot is None:
            hot = hot_keys(hot_source if hot_source is not None else df, group, max_group_rows)
        hot = hot.get(group[0])
    elif split:
        hot = hot_groups(hot_source if hot_source is not None else df, group, max_group_rows)
    if not split or hot is None:
        w = Window.partitionBy(*[_q(g) for g in group]).orderBy(*order)
        return df.withColumn(out, F.row_number().over(w))
    cond = [_q(g).eqNullSafe(F.col(f"__tm_h{i}")) for i, g in enumerate(group)]
    flagged = df.join(hot, cond, "left").drop(*[f"__tm_h{i}" for i in range(len(group))])
    return split_rank(flagged, group, order, out, split, F.col("__tm_pieces").isNotNull()).drop("__tm_pieces")


def split_rank(
    df: DataFrame,
    group: list[str],
    order: list[Column],
    out: str,
    split: list[tuple[Column, str]],
    is_hot: Column | None = None,
) -> DataFrame:
    """``row_number()`` per group computed in sub-buckets of each hot group.

    A hot group (all groups without ``is_hot``) is cut into sub-buckets by the
    ``split`` columns; a row's number is its number inside its sub-bucket plus
    the row count of the group's earlier sub-buckets. The rows move once (to
    their sub-bucket); the counts of the hot groups are a partial aggregate and
    a small window; the offset join reuses the rows' partitioning. A group
    holding a third of all rows is spread over its sub-buckets instead of one
    task.
    """
    keys: list[tuple[str, str]] = []  # (value column, is-null column)
    hot = is_hot if is_hot is not None else F.lit(True)
    cols = [F.col("*")]
    sources = [(_q(g), None) for g in group] + [(c, d) for c, d in split]
    probe = df.select(*[c for c, _ in sources])
    for i, ((c, _), f) in enumerate(zip(sources, probe.schema.fields)):
        k, n = f"__tm_rk{i}", f"__tm_rn{i}"
        value = c if i < len(group) else F.when(hot, c)
        cols += [F.coalesce(value, _key_default(f.dataType)).alias(k), value.isNull().alias(n)]
        keys.append((k, n))
    keyed = df.select(*cols, hot.alias("__tm_hot"))
    all_keys = [F.col(x) for pair in keys for x in pair]
    local = keyed.withColumn("__tm_local", F.row_number().over(Window.partitionBy(*all_keys).orderBy(*order)))

    counts = keyed.filter("__tm_hot").groupBy(*all_keys).agg(F.count(F.lit(1)).alias("__tm_cnt"))
    bucket_order = []
    for (k, n), (_, direction) in zip(keys[len(group):], split):
        if direction == "asc_nulls_first":
            bucket_order += [F.col(n).desc(), F.col(k).asc()]
        elif direction == "desc_nulls_last":
            bucket_order += [F.col(n).asc(), F.col(k).desc()]
        else:
            raise ValueError(f"split direction must be asc_nulls_first or desc_nulls_last, got {direction!r}")
    gkeys = [F.col(x) for pair in keys[: len(group)] for x in pair]
    before = Window.partitionBy(*gkeys).orderBy(*bucket_order).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*all_keys, F.coalesce(F.sum("__tm_cnt").over(before), F.lit(0)).alias("__tm_off"))
    key_names = [x for pair in keys for x in pair]
    ranked = local.join(offsets, on=key_names, how="left")
    ranked = ranked.withColumn(out, (F.col("__tm_local") + F.coalesce("__tm_off", F.lit(0))).cast("int"))
    return ranked.select(*[_q(c) for c in df.columns], out)


def top_k_within(df: DataFrame, group: list[str], order: list[Column], k: int, out: str) -> DataFrame:
    """The first ``k`` rows of each group with their rank.

    ``rank <= k`` lets Catalyst put a partial ``WindowGroupLimit`` before the
    shuffle: each map task sends at most ``k`` rows per group.
    """
    return rank_within(df, group, order, out).filter(F.col(out) <= k)


DAY = "__tm_day"


def day_number(date_col: str) -> Column:
    """Calendar day of a DATE / TIMESTAMP / TIMESTAMP_NTZ column as days since 1970."""
    return F.unix_date(F.to_date(_q(date_col)))


def range_window_over_days(daily: DataFrame, partition: list[str], value: str, days: int, out: str) -> DataFrame:
    """``sum(value)`` over ``[day - days, day]`` per partition, on a table with
    one row per (partition, ``__tm_day``). Rows with a NULL day are each
    other's frame, as in a RANGE frame over NULLs."""
    w = Window.partitionBy(*[_q(p) for p in partition]).orderBy(F.col(DAY)).rangeBetween(-days, 0)
    return daily.select(*[_q(p) for p in partition], F.col(DAY), F.sum(_q(value)).over(w).alias(out))


def attach_by_day(df: DataFrame, partition: list[str], date_col: str, daily: DataFrame, out: str) -> DataFrame:
    """Left-join a per-(partition, day) result onto the rows of ``df``,
    NULL-safe on every key; ``df``'s columns keep their order, ``out`` last.

    The join key (partition, day) spreads a hot partition key over its days;
    a single hot (partition, day) is left to adaptive execution's skew-join
    split.
    """
    renamed = {p: f"__tm_k{i}" for i, p in enumerate(partition)}
    right = daily.select(*[_q(p).alias(renamed[p]) for p in partition], F.col(DAY).alias("__tm_kday"), _q(out))
    keyed = df.withColumn(DAY, day_number(date_col))
    cond = [keyed[p].eqNullSafe(right[renamed[p]]) for p in partition]
    cond.append(keyed[DAY].eqNullSafe(right["__tm_kday"]))
    return keyed.join(right, cond, "left").drop(*renamed.values(), "__tm_kday", DAY)


def rolling_range_sum(
    df: DataFrame,
    partition: list[str],
    date_col: str,
    value: Column,
    days: int,
    out: str,
) -> DataFrame:
    """Sum of ``value`` over rows of the same partition whose day lies in
    ``[day - days, day]`` (a RANGE frame: rows of the same day are included).

    Plan: pre-aggregate to one row per (partition, day) with partial
    aggregation, run the range window over days, join the result back on
    (partition, day). A partition key holding a third of all rows is one row
    per day after the pre-aggregation, so the window never sees it whole.
    Rows with a NULL day form one group, as in a RANGE frame over NULLs.
    The frame counts calendar days (``unix_date``), which is DST-free.
    """
    daily = df.groupBy(*[_q(p) for p in partition], day_number(date_col).alias(DAY)).agg(
        F.sum(value).alias("__tm_daysum")
    )
    return attach_by_day(df, partition, date_col, range_window_over_days(daily, partition, "__tm_daysum", days, out), out)
