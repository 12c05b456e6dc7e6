"""Shared pieces of the marts: parameters, dimension joins, recency columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from tidemark.operators.dedup import dedup_latest
from tidemark.operators.windows import MAX_GROUP_ROWS, hot_keys


def today(as_of: dt.date | None) -> dt.date:
    """The evaluation day: as given, else the current day (UTC)."""
    return as_of if as_of is not None else dt.datetime.now(dt.timezone.utc).date()


def now(loaded_at: dt.datetime | None) -> dt.datetime:
    """The load instant: as given, else the current instant (UTC)."""
    return loaded_at if loaded_at is not None else dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)


def present(df: DataFrame, candidates: tuple[str, ...]) -> list[str]:
    """The candidate columns that ``df`` has, in the given order."""
    return [c for c in candidates if c in df.columns]


def dim_latest(dim: DataFrame, key: str, recency: tuple[str, ...] = ("updated_at",)) -> DataFrame:
    """One row per dimension key: the latest version, deterministic on ties.

    A dimension with repeated keys (monthly snapshots, history rows) would
    otherwise multiply the fact rows in a join.
    """
    return dedup_latest(dim, [key], present(dim, recency))


def left_join_dim(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    dim_name: str,
    hot_source: DataFrame | None = None,
    max_group_rows: int = MAX_GROUP_ROWS,
    hot: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """``fact LEFT JOIN dim USING (key)`` with name clashes made explicit.

    A dimension column that the fact already has is renamed ``<dim_name>_<col>``
    instead of producing two columns of one name (ambiguous downstream).
    The join strategy is Spark's: a dimension below the broadcast threshold of
    the size statistics is broadcast, a larger one is a sort-merge join.

    ``hot_source`` (the fact's raw key column) or ``hot`` (the hot keys by
    column, as ``hot_keys`` returns them) salts the join: rows of a hot key,
    NULL included, are dealt over its pieces by a hash of the row, and the
    key's dimension row is repeated per piece. The fact is read once, and no
    task gets much more than ``max_group_rows`` rows of one key. Without hot
    keys the join is the plain one. ``dim`` must be unique on ``key``.
    """
    clash = [c for c in dim.columns if c != key and c in fact.columns]
    if clash:
        dim = dim.select(*[dim[c].alias(f"{dim_name}_{c}") if c in clash else dim[c] for c in dim.columns])
    if hot is None and hot_source is not None:
        hot = hot_keys(hot_source, [key], max_group_rows)
    hot = (hot or {}).get(key)
    if hot is None:
        return fact.join(dim, on=key, how="left")
    same = F.col(f"`{key}`").eqNullSafe(F.col("__tm_h0"))
    plain = [f"`{f.name}`" for f in fact.schema.fields if not isinstance(f.dataType, MapType)]
    piece = F.pmod(F.xxhash64(*plain), F.col("__tm_pieces")).cast("int")
    dealt = fact.join(hot, same, "left").withColumn("__tm_piece", F.coalesce(piece, F.lit(0))).drop("__tm_h0", "__tm_pieces")
    pieces = F.sequence(F.lit(0), F.coalesce("__tm_pieces", F.lit(1)) - 1)
    repeated = dim.join(hot, same, "left").withColumn("__tm_piece", F.explode(pieces)).drop("__tm_h0", "__tm_pieces")
    return dealt.join(repeated, on=[key, "__tm_piece"], how="left").drop("__tm_piece")
