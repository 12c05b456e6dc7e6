"""Time the chosen form of an operator beside its naive form.

    python tools/compare_forms.py [sf_dir]

Both forms run through the noop sink; median of 3 runs after a warm-up.
"""

from __future__ import annotations

import json
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tidemark import fixtures as fx  # noqa: E402
from tidemark.functions.stats import exact_sum  # noqa: E402
from tidemark.operators.dedup import dedup_latest  # noqa: E402
from tidemark.operators.totals import group_totals  # noqa: E402
from tidemark.operators.windows import rank_within, rolling_range_sum, split_rank  # noqa: E402
from tidemark.plans import customer as cu  # noqa: E402
from tidemark.plans import supply as su  # noqa: E402
from tidemark.session import scratch_path  # noqa: E402


def timed(make):
    runs = []
    for i in range(4):
        t0 = time.perf_counter()
        make().write.format("noop").mode("overwrite").save()
        if i:
            runs.append(time.perf_counter() - t0)
    return round(statistics.median(runs), 3)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "16")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # inputs staged once, so the timings compare the operators, not the adapters
    tmp = {}
    for name in ("purchase_orders", "inventory", "orders", "raw_materials", "suppliers"):
        path = scratch_path(spark, f"forms_{name}")
        fx.BUILDERS[name](spark, sf).write.mode("overwrite").parquet(path)
        tmp[name] = spark.read.parquet(path)
    po_clean, mat, sup = su.po_parts(tmp["purchase_orders"], tmp["raw_materials"], tmp["suppliers"])
    base_joined = su.join_base(po_clean, mat, sup)
    base = su.delivery_columns(base_joined)
    inv = tmp["inventory"].withColumn("stock_value", F.col("quantity_on_hand") * F.col("unit_cost"))
    orders = cu.clean_orders(tmp["orders"])
    w_wh = Window.partitionBy("warehouse_id")
    w_roll = Window.partitionBy("material_id").orderBy(F.unix_date("order_date")).rangeBetween(-90, 0)
    out = {
        "dedup_latest": timed(lambda: dedup_latest(tmp["purchase_orders"], ["po_id"], ["updated_at"])),
        "dedup_dropDuplicates": timed(lambda: tmp["purchase_orders"].dropDuplicates(["po_id"])),
        "totals_partial_agg_broadcast": timed(
            lambda: group_totals(inv, ["warehouse_id"], [exact_sum("stock_value").alias("t"), F.count("product_id").alias("n")])
        ),
        "totals_whole_partition_window": timed(
            lambda: inv.select("*", F.sum("stock_value").over(w_wh).alias("t"), F.count("product_id").over(w_wh).alias("n"))
        ),
        "rolling_daily_preagg": timed(lambda: rolling_range_sum(base, ["material_id"], "order_date", F.col("line_cost"), 90, "s")),
        "rolling_priced_daily_quantities": timed(lambda: su.rolling_spend(base_joined, rolling=su.material_rolling_spend(po_clean, mat))),
        "rolling_row_level_window": timed(lambda: base.select("*", F.sum("line_cost").over(w_roll).alias("s"))),
        "rank_split_subbuckets_all_groups": timed(
            lambda: split_rank(orders, ["customer_id"], cu.recency_order(), "r", cu.recency_split())
        ),
        "rank_hot_detection_then_window": timed(
            lambda: rank_within(orders, ["customer_id"], cu.recency_order(), "r", split=cu.recency_split(),
                                hot_source=tmp["orders"].select("customer_id"))
        ),
        "rank_single_window": timed(lambda: rank_within(orders, ["customer_id"], cu.recency_order(), "r")),
    }
    print(json.dumps({"sf": sf, "seconds": out}))
    spark.stop()


if __name__ == "__main__":
    main()
