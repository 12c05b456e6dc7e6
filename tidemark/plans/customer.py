"""Customer marts: order and review metrics, customer 360, enriched orders."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, IntegralType, StringType

from tidemark.functions.dates import date_parts, day_literal, days_between
from tidemark.functions.hashing import add_audit_columns
from tidemark.functions.rules import SEGMENT_THRESHOLDS, customer_segment
from tidemark.functions.stats import WIDE_TYPE, exact_avg, exact_sum
from tidemark.functions.text import trim_strings
from tidemark.operators.aggregates import StateSpec, state_avg, state_sum
from tidemark.operators.dedup import dedup_latest
from tidemark.operators.windows import hot_keys, rank_within, top_k_within
from tidemark.plans.common import dim_latest, left_join_dim, now, present, today

RECENCY = ("updated_at",)


def clean_orders(orders: DataFrame) -> DataFrame:
    """Trimmed orders, one row per ``order_id`` (latest version)."""
    o = trim_strings(orders)
    return dedup_latest(o, ["order_id"], present(o, RECENCY))


def customer_order_metrics(orders: DataFrame) -> DataFrame:
    """Per customer: order count, lifetime value, average order, first/last order day.

    A hash aggregate with map-side partial aggregation: a customer with a third
    of all orders costs one partial row per task in the shuffle.
    """
    return orders.groupBy("customer_id").agg(
        F.count("order_id").alias("total_orders"),
        exact_sum("order_amount").alias("lifetime_value"),
        exact_avg("order_amount").alias("avg_order_value"),
        F.max("order_date").alias("last_order_date"),
        F.min("order_date").alias("first_order_date"),
    )


#: What an incremental run keeps of the orders, per customer.
ORDER_STATE = StateSpec("order_id", ("customer_id",), ("placed", "order_amount"), ("order_date",))


def order_measures(clean: DataFrame) -> DataFrame:
    """What each order adds to its customer's ``ORDER_STATE``."""
    return clean.select(
        "order_id", "customer_id", F.col("order_id").isNotNull().cast("int").alias("placed"),
        F.col("order_amount").cast(WIDE_TYPE).alias("order_amount"), "order_date",
    )


def metrics_of_states(states: DataFrame) -> DataFrame:
    """``customer_order_metrics`` from the kept states."""
    return states.select(
        "customer_id", F.col("sum_placed").alias("total_orders"), state_sum("order_amount").alias("lifetime_value"),
        state_avg("order_amount").alias("avg_order_value"),
        F.col("max_order_date").alias("last_order_date"), F.col("min_order_date").alias("first_order_date"),
    )


def customer_review_metrics(reviews: DataFrame) -> DataFrame:
    """Per reviewing user: average rating and review count."""
    return reviews.groupBy("user_id").agg(
        exact_avg("rating").alias("avg_review_rating"),
        F.count("review_id").alias("total_reviews"),
    )


def text_key_as(df: DataFrame, text_col: str, key_type: DataType) -> DataFrame:
    """Add ``__tm_uid``: ``text_col`` as ``key_type`` where it is exactly the
    text form of such a value, else NULL.

    ``key = uid`` then matches the same pairs as ``cast(key as string) =
    text`` ('7' matches 7; '007', ' 7' and 'abc' match nothing), but joins on
    the key itself, so a side already partitioned by the key is not shuffled
    again by its text form.
    """
    t = F.col(text_col)
    if isinstance(key_type, StringType):
        return df.withColumn("__tm_uid", t)
    typed = t.try_cast(key_type)
    text = typed.cast("string")
    if isinstance(key_type, DecimalType) and key_type.scale:
        text = F.regexp_replace(text, r"\.?0+$", "")  # a database NUMERIC 7 arrives as 7.000...
        text = F.when(typed == 0, "0").otherwise(text)
    return df.withColumn("__tm_uid", F.when(text == t, typed))


def customer_360(
    customers: DataFrame,
    orders: DataFrame | None,
    reviews: DataFrame | None = None,
    *,
    metrics: DataFrame | None = None,
    as_of: dt.date | None = None,
    loaded_at: dt.datetime | None = None,
    thresholds: tuple = SEGMENT_THRESHOLDS,
    orders_clean: bool = False,
) -> DataFrame:
    """One row per customer with order/review metrics, tenure and segment.

    Customers without orders keep NULL metrics and fall into the lowest
    segment. Review users are matched to customers as text (``user_id`` is a
    string, ``customer_id`` need not be). Orders are trimmed and deduplicated
    first, unless ``orders_clean`` says ``clean_orders`` was applied already.
    ``metrics`` (``metrics_of_states``) takes the place of the orders.
    """
    cust = trim_strings(customers)
    cust = dedup_latest(cust, ["customer_id"], present(cust, RECENCY))
    if metrics is None:
        metrics = customer_order_metrics(orders if orders_clean else clean_orders(orders))
    c = cust.join(metrics, on="customer_id", how="left")
    if reviews is not None:
        # only user ids that are exactly a customer key's text can match: key
        # them by the typed id before aggregating, so the aggregate is already
        # partitioned for the join and ids that cannot match are dropped early
        keyed = text_key_as(reviews, "user_id", c.schema["customer_id"].dataType).filter(F.col("__tm_uid").isNotNull())
        rm = keyed.groupBy("__tm_uid").agg(
            exact_avg("rating").alias("avg_review_rating"),
            F.count("review_id").alias("total_reviews"),
        )
        c = c.join(rm, c["customer_id"] == rm["__tm_uid"], "left").drop("__tm_uid")
    day = day_literal(today(as_of))
    c = c.select(
        "*",
        days_between(day, F.col("first_order_date")).alias("customer_tenure_days"),
        days_between(day, F.col("last_order_date")).alias("days_since_last_order"),
        customer_segment(F.col("lifetime_value"), thresholds).alias("customer_segment"),
    )
    return add_audit_columns(c, now(loaded_at), exclude=("customer_tenure_days", "days_since_last_order"))


def customer_segments(
    customers: DataFrame, orders: DataFrame, thresholds: tuple = SEGMENT_THRESHOLDS
) -> DataFrame:
    """``(customer_id, lifetime_value, customer_segment)`` for every customer."""
    cust = dedup_latest(customers.select("customer_id"), ["customer_id"])
    metrics = customer_order_metrics(clean_orders(orders)).select("customer_id", "lifetime_value")
    c = cust.join(metrics, on="customer_id", how="left")
    return c.select("customer_id", "lifetime_value", customer_segment(F.col("lifetime_value"), thresholds).alias("customer_segment"))


def recency_order() -> list:
    """Latest order first; the order id breaks ties on one day."""
    return [F.col("order_date").desc_nulls_last(), F.col("order_id").asc_nulls_first()]


# Order ids per sub-bucket of one customer's day, as a power of two.
ID_BUCKET_BITS = 20


def common_prefix(texts: DataFrame, column: str) -> Column:
    """Length of the prefix that all values of a text column share, as a scalar subquery
    (the smallest and the largest value share it too)."""
    ends = texts.agg(F.min(column).alias("lo"), F.max(column).alias("hi")).select(F.coalesce("lo", F.lit("")).alias("lo"), F.coalesce("hi", F.lit("")).alias("hi"))
    places = F.sequence(F.lit(1), F.greatest(F.lit(1), F.length("lo")))
    longer = lambda n, i: F.when((n == i - 1) & (F.substring("lo", 1, i) == F.substring("hi", 1, i)), i).otherwise(n)
    return ends.select(F.aggregate(places, F.lit(0), longer)).scalar()


def recency_split(id_type: DataType | None = None, prefix: Column | None = None) -> list:
    """Sub-buckets that follow ``recency_order``: the day, then a range of ids.

    A customer with a huge share of all orders is ranked in (day, id range)
    pieces; the pieces' counts give each piece's starting rank. For integral
    ids a range is ``2**ID_BUCKET_BITS`` consecutive ids - ids are unique, so a
    piece never holds more orders than that, however many fall on one day.
    Text ids are cut by the four characters that follow the prefix all ids
    share (also order-preserving); other id types by day only.
    """
    day = (F.to_date(F.col("order_date")), "desc_nulls_last")
    if id_type is None or isinstance(id_type, IntegralType):
        return [day, (F.shiftright(F.col("order_id").cast("bigint"), ID_BUCKET_BITS), "asc_nulls_first")]
    if isinstance(id_type, StringType):
        start = prefix + 1 if prefix is not None else F.lit(1)
        return [day, (F.substring(F.col("order_id"), start, 4), "asc_nulls_first")]
    return [day]


def rank_orders(df: DataFrame, raw_orders: DataFrame, hot: dict[str, DataFrame] | None = None) -> DataFrame:
    """Per-customer recency rank; customers with very many orders (``hot``, else
    found in the raw orders' key column) are ranked in (day, id range) pieces."""
    id_type = df.schema["order_id"].dataType
    prefix = common_prefix(raw_orders, "order_id") if isinstance(id_type, StringType) else None
    return rank_within(
        df, ["customer_id"], recency_order(), "order_rank",
        split=recency_split(id_type, prefix), hot_source=raw_orders.select("customer_id"), hot=hot,
    )


def order_recency_rank(orders: DataFrame) -> DataFrame:
    o = clean_orders(orders).select("customer_id", "order_id", "order_date")
    return rank_orders(o, orders)


def latest_orders(orders: DataFrame, k: int = 3) -> DataFrame:
    o = clean_orders(orders).select("customer_id", "order_id", "order_date", "order_amount")
    return top_k_within(o, ["customer_id"], recency_order(), k, "order_rank")


def order_time_features(orders: DataFrame) -> DataFrame:
    o = clean_orders(orders).select("order_id", "order_date")
    return o.select("*", *date_parts("order_date", "order", ("year", "month", "dow", "quarter")))


def order_enriched(
    orders: DataFrame,
    products: DataFrame,
    *,
    loaded_at: dt.datetime | None = None,
    orders_clean: bool = False,
) -> DataFrame:
    """Orders with product attributes, per-customer recency rank and date parts.

    ``orders_clean``: ``clean_orders`` was applied already (e.g. staged once
    for several marts), so the orders are not deduplicated again."""
    o = orders if orders_clean else clean_orders(orders)
    hot = hot_keys(orders, ["product_id", "customer_id"])
    e = left_join_dim(o, dim_latest(products, "product_id"), "product_id", "product", hot=hot)
    e = rank_orders(e, orders, hot)
    e = e.select("*", *date_parts("order_date", "order", ("year", "month", "dow")))
    return add_audit_columns(e, now(loaded_at))
