import datetime as dt
import hashlib

from pyspark.sql import functions as F

from tidemark.functions.hashing import add_audit_columns, row_hash
from tidemark.functions.text import trim_strings
from tidemark.operators.dedup import dedup_latest
from tidemark.operators.quality import drop_nulls, table_profile


def test_dedup_keeps_latest_and_breaks_ties_on_other_columns(spark):
    df = spark.createDataFrame(
        [
            (1, dt.datetime(2024, 1, 1), "b"),
            (1, dt.datetime(2024, 1, 2), "z"),
            (1, dt.datetime(2024, 1, 2), "a"),  # tie on recency: smallest other value wins
            (2, None, "x"),
            (2, dt.datetime(2023, 1, 1), "y"),  # NULL recency sorts last
            (3, None, "q"),
        ],
        "k int, ts timestamp, v string",
    )
    out = {r.k: (r.ts, r.v) for r in dedup_latest(df, ["k"], ["ts"]).collect()}
    assert out[1] == (dt.datetime(2024, 1, 2), "a")
    assert out[2] == (dt.datetime(2023, 1, 1), "y")
    assert out[3] == (None, "q")


def test_dedup_is_independent_of_partitioning(spark):
    rows = [(i % 7, i % 3, f"v{i % 5}") for i in range(500)]
    df = spark.createDataFrame(rows, "k int, r int, v string")
    a = sorted(dedup_latest(df.repartition(1), ["k"], ["r"]).collect())
    b = sorted(dedup_latest(df.repartition(13, "v"), ["k"], ["r"]).collect())
    assert a == b and len(a) == 7


def test_dedup_plan_limits_before_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 10).alias("k"), F.col("id").alias("v"))
    plan = dedup_latest(df, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_drop_nulls(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None)], "a int, b string")
    assert drop_nulls(df, ["a"]).count() == 2
    assert drop_nulls(df, ["a", "b"]).count() == 1


def test_trim_strings_trims_spaces_only_and_keeps_order(spark):
    df = spark.createDataFrame([("  x ", 1, "\ty\t")], "s string, n int, t string")
    out = trim_strings(df)
    assert out.columns == ["s", "n", "t"]
    r = out.first()
    assert r.s == "x" and r.n == 1 and r.t == "\ty\t"


def _sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def test_row_hash_default_encoding_and_its_collisions(spark):
    df = spark.createDataFrame([(None, "a|b"), ("", "a|b"), ("a", "b|")], "x string, y string")
    hs = [r.h for r in df.select(row_hash(["x", "y"]).alias("h")).collect()]
    assert hs[0] == _sha("|a|b")
    assert hs[0] == hs[1]  # NULL and '' collide in the compatible encoding


def test_row_hash_strict_separates_null_empty_and_pipes(spark):
    df = spark.createDataFrame([(None, "a|b"), ("", "a|b"), ("a|", "b"), ("a", "|b")], "x string, y string")
    hs = [r.h for r in df.select(row_hash(["x", "y"], strict=True).alias("h")).collect()]
    assert len(set(hs)) == 4
    assert hs[0] == _sha("N|3:a|b")


def test_audit_columns_exclude_volatile_and_fixed_load_time(spark):
    df = spark.createDataFrame([(1, 5)], "a int, days int")
    out = add_audit_columns(df, dt.datetime(2020, 1, 2, 3, 4, 5), exclude=("days",)).first()
    assert out._etl_loaded_at == dt.datetime(2020, 1, 2, 3, 4, 5)
    assert out._etl_row_hash == _sha("1")


def test_table_profile_counts_nulls_per_column(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    rows = {r.column_name: r for r in table_profile(df, "t").collect()}
    assert rows["a"].null_count == 1 and rows["b"].null_count == 2
    assert rows["a"].row_count == 3 and rows["b"].column_position == 2


def test_dedup_skips_map_columns_in_tie_break(spark):
    df = spark.createDataFrame([(1, {"a": 1}, "y"), (1, {"b": 2}, "x")], "k int, m map<string,int>, v string")
    out = dedup_latest(df, ["k"]).collect()
    assert len(out) == 1 and out[0].v == "x"
