"""DataFrame -> DataFrame operators."""

from tidemark.operators.dedup import dedup_latest
from tidemark.operators.quality import drop_nulls, table_profile
from tidemark.operators.totals import group_totals
from tidemark.operators.windows import hot_groups, hot_keys, rank_within, rolling_range_sum, split_rank, top_k_within
from tidemark.operators.upsert import upsert

__all__ = [
    "dedup_latest",
    "drop_nulls",
    "group_totals",
    "hot_groups",
    "hot_keys",
    "rank_within",
    "rolling_range_sum",
    "split_rank",
    "table_profile",
    "top_k_within",
    "upsert",
]
