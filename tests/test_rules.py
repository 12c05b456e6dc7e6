from decimal import Decimal

from pyspark.sql import functions as F

from tidemark.functions.rules import customer_segment, is_late, stock_health, supplier_tier
from tidemark.functions.stats import exact_avg


def test_segment_thresholds_are_inclusive(spark):
    df = spark.createDataFrame(
        [(Decimal("10000.00"),), (Decimal("9999.99"),), (Decimal("5000"),), (Decimal("1000"),), (Decimal("999.99"),), (None,)],
        "ltv decimal(18,2)",
    )
    got = [r.s for r in df.select(customer_segment(F.col("ltv")).alias("s")).collect()]
    assert got == ["platinum", "gold", "gold", "silver", "bronze", "bronze"]


def test_stock_health_precedence_and_nulls(spark):
    df = spark.createDataFrame(
        [(0, None), (0, 5), (5, 5), (25, 5), (26, 5), (7, None), (None, 3)],
        "q int, lvl int",
    )
    got = [r.h for r in df.select(stock_health(F.col("q"), F.col("lvl")).alias("h")).collect()]
    assert got == ["out_of_stock", "out_of_stock", "low_stock", "healthy", "overstock", "healthy", "healthy"]


def test_is_late_null_means_on_time(spark):
    df = spark.createDataFrame([(1,), (0,), (None,), (-3,)], "v int")
    assert [r.l for r in df.select(is_late(F.col("v")).alias("l")).collect()] == [True, False, False, False]


def test_supplier_tier_boundaries(spark):
    df = spark.createDataFrame(
        [
            (Decimal("0.95"), Decimal("100000")),
            (Decimal("0.95"), Decimal("99999.99")),
            (Decimal("0.99"), None),
            (Decimal("0.85"), Decimal("1")),
            (Decimal("0.70"), Decimal("1")),
            (Decimal("0.699999"), Decimal("1")),
        ],
        "r decimal(38,6), s decimal(38,2)",
    )
    got = [r.t for r in df.select(supplier_tier(F.col("r"), F.col("s")).alias("t")).collect()]
    assert got == ["strategic", "preferred", "preferred", "preferred", "approved", "under_review"]


def test_exact_avg_rounds_half_up_once(spark):
    # 1 cent / 32 = 0.0003125 -> a tie at 6 decimals, rounded away from zero
    rows = [(Decimal("0.01"),)] + [(Decimal("0.00"),)] * 31
    df = spark.createDataFrame(rows + [(None,)], "x decimal(18,2)")
    r = df.agg(exact_avg("x").alias("a")).first()
    assert r.a == Decimal("0.000313")
    neg = spark.createDataFrame([(Decimal("-0.01"),)] + [(Decimal("0"),)] * 31, "x decimal(18,2)")
    assert neg.agg(exact_avg("x").alias("a")).first().a == Decimal("-0.000313")
