"""Rows per task when one key holds a third of all rows.

    python tools/skew_demo.py [sf_dir]

Four cases, each derived from the testdata by giving every third row to one
key: a customer (per-customer recency rank), a material (90-day rolling
spend; and the purchase-order -> material join with broadcasting off), a
warehouse (per-warehouse totals). Each operator runs in its naive
form and in the form used by the marts; the Spark event log (written to a
fresh scratch folder) gives the largest number of shuffle records one task
read in each run.
"""

from __future__ import annotations

import glob
import io
import json
import sys
import tempfile
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import zstandard  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from pyspark.sql import Window  # noqa: E402

from tidemark import fixtures as fx  # noqa: E402
from tidemark.functions.stats import exact_sum  # noqa: E402
from tidemark.operators.totals import group_totals  # noqa: E402
from tidemark.operators.windows import rank_within, rolling_range_sum  # noqa: E402
from tidemark.plans import customer as cu  # noqa: E402
from tidemark.plans import inventory as inv  # noqa: E402
from tidemark.plans import supply as su  # noqa: E402


def events(log_dir):
    for f in sorted(glob.glob(f"{log_dir}/*/events*")):
        raw = open(f, "rb").read()
        if f.endswith(".zstd"):
            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        for line in raw.decode().splitlines():
            yield json.loads(line)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="run-skew-", dir="/tmp")
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "16")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", log_dir)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    third = lambda c: F.col(c) % 3 == 0
    raw = fx.orders(spark, sf).withColumn(
        "customer_id", F.when(third("order_id"), F.lit(1).cast("bigint")).otherwise(F.col("customer_id"))
    )
    orders = cu.clean_orders(raw).select("customer_id", "order_id", "order_date")
    n = orders.count()
    po = fx.purchase_orders(spark, sf).withColumn(
        "material_id", F.when(third("po_id"), F.lit(1).cast("bigint")).otherwise(F.col("material_id"))
    )
    d = fx.domain(spark, sf, "raw_materials", "suppliers", "inventory")
    po_clean, mat, sup = su.po_parts(po, d["raw_materials"], d["suppliers"])
    base = su.delivery_columns(su.join_base(po_clean, mat, sup)).select("po_id", "material_id", "order_date", "line_cost")
    stock = inv.stock_flags(
        inv.clean_inventory(
            d["inventory"].withColumn("warehouse_id", F.when(third("inventory_id"), F.lit(1)).otherwise(F.col("warehouse_id")))
        )
    ).select("inventory_id", "warehouse_id", "product_id", "stock_value")
    w_roll = Window.partitionBy("material_id").orderBy(F.unix_date("order_date")).rangeBetween(-90, 0)
    w_wh = Window.partitionBy("warehouse_id")
    cases = {
        "rank/single_window": lambda: rank_within(orders, ["customer_id"], cu.recency_order(), "r"),
        "rank/hot_group_split": lambda: rank_within(
            orders, ["customer_id"], cu.recency_order(), "r",
            split=cu.recency_split(), hot_source=raw.select("customer_id"), max_group_rows=n // 20,
        ),
        "rolling/row_level_window": lambda: base.select("*", F.sum("line_cost").over(w_roll).alias("s")),
        "rolling/daily_preaggregate": lambda: rolling_range_sum(base, ["material_id"], "order_date", F.col("line_cost"), 90, "s"),
        "rolling/priced_daily_quantities": lambda: su.rolling_spend(
            su.join_base(po_clean, mat, sup), rolling=su.material_rolling_spend(po_clean, mat)
        ),
        "totals/whole_partition_window": lambda: stock.select(
            "*", F.sum("stock_value").over(w_wh).alias("t"), F.count("product_id").over(w_wh).alias("n")
        ),
        "totals/partial_aggregate": lambda: group_totals(
            stock, ["warehouse_id"], [exact_sum("stock_value").alias("t"), F.count("product_id").alias("n")]
        ),
    }
    for label, make in cases.items():
        spark.sparkContext.setJobGroup(label, label)
        make().write.format("noop").mode("overwrite").save()
    # a dimension too big to broadcast: plain sort-merge join vs hot-key split
    from tidemark.plans.common import left_join_dim

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    dim_cases = {
        "dimjoin/sort_merge": lambda: left_join_dim(po_clean, mat, "material_id", "material"),
        "dimjoin/hot_key_split": lambda: left_join_dim(
            po_clean, mat, "material_id", "material", hot_source=po.select("material_id"), max_group_rows=n // 20
        ),
    }
    for label, make in dim_cases.items():
        spark.sparkContext.setJobGroup(label, label)
        make().write.format("noop").mode("overwrite").save()
    spark.stop()
    # largest shuffle read of one task, per job group (and per stage: max / mean)
    stage_group, worst, per_stage = {}, {}, {}
    for e in events(log_dir):
        if e["Event"] == "SparkListenerJobStart":
            g = e.get("Properties", {}).get("spark.jobGroup.id")
            for st in e["Stage IDs"]:
                stage_group[st] = g
        elif e["Event"] == "SparkListenerTaskEnd" and e.get("Task Metrics"):
            g = stage_group.get(e["Stage ID"])
            r = e["Task Metrics"]["Shuffle Read Metrics"]["Total Records Read"]
            if g and r:
                worst[g] = max(worst.get(g, 0), r)
                per_stage.setdefault((g, e["Stage ID"]), []).append(r)
    detail = {
        f"{g}#{st}": {"max": max(v), "mean": round(sum(v) / len(v)), "tasks": len(v)}
        for (g, st), v in sorted(per_stage.items())
    }
    print(json.dumps({"sf": sf, "max_shuffle_records_one_task": worst}))
    print(json.dumps({"per_stage": detail}))


if __name__ == "__main__":
    main()
