import time

from tidemark.session import recommended_conf, scratch_path, shared_dir


def test_scratch_paths_are_unique_and_under_the_checkpoint_dir(spark):
    base = shared_dir(spark)
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and base.replace("file:", "") in a


def test_recommended_conf_bounds():
    assert recommended_conf(10 << 20)["spark.sql.shuffle.partitions"] == "200"
    assert recommended_conf(100 << 40)["spark.sql.shuffle.partitions"] == "102400"
    assert recommended_conf(1000 << 30)["spark.sql.shuffle.partitions"] == "1000"


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(",").split(",")
    return {f for f in files if "shuffle_" in f and f.endswith(".data")}


def test_a_run_leaves_no_shuffle_files(spark):
    from tidemark.plans.run import LoadPlan, Params, run
    from tidemark.session import SHUFFLE_CLEANUP, shuffles_removed

    def write(df):
        df.groupBy("k").count().write.mode("overwrite").parquet(scratch_path(spark, "t_shuffled"))

    df, before = spark.range(1000).selectExpr("id % 7 AS k"), _shuffle_files(spark)
    write(df)
    assert _shuffle_files(spark) - before  # kept until the driver's next garbage collection
    before, old = _shuffle_files(spark), spark.conf.get(SHUFFLE_CLEANUP)
    with shuffles_removed(spark):
        assert spark.conf.get(SHUFFLE_CLEANUP) == "true"
        write(df)
    orders = spark.createDataFrame([(i, i % 3, i % 2, "2024-01-01") for i in range(50)], "order_id int, customer_id int, product_id int, order_date string")
    products = spark.createDataFrame([(0, "p"), (1, "q")], "product_id int, product_name string")
    plan = LoadPlan(scratch_path(spark, "t_marts"))
    inputs = {"orders": orders.withColumn("order_date", orders.order_date.cast("date")), "products": products}
    assert run(spark, inputs, scratch_path(spark, "t_work"), plan, ["order_enriched"], Params()) == {"order_enriched": 50}
    until = time.time() + 20
    while _shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not _shuffle_files(spark) - before and spark.conf.get(SHUFFLE_CLEANUP) == old
