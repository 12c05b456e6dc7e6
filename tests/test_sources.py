import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.session import scratch_path
from tidemark.sources.files import read_checked, read_dataset, read_datasets
from tidemark.sources.incremental import WatermarkStore, incremental_filter, new_watermark
from tidemark.sources.jdbc import bound_value, jdbc_options
from tidemark.sources.schema import SchemaError, load_schema, validate_schema


def test_load_schema_convention_and_spark_types(spark, tmp_path):
    p = tmp_path / "s.json"
    p.write_text(json.dumps({"type": "struct", "fields": [
        {"name": "pallet_weight", "type": "Float"},
        {"name": "loaded_at", "type": "timestamp_ntz"},
        {"name": "freight", "type": "decimal(18, 2)", "nullable": False},
        {"name": "carrier", "type": "string"},
        {"name": "pallets", "type": "integer"},
    ]}))
    s = load_schema(p)
    assert s.simpleString() == "struct<pallet_weight:double,loaded_at:timestamp_ntz,freight:decimal(18,2),carrier:string,pallets:int>"
    assert [f.name for f in s.fields if not f.nullable] == ["freight"]
    assert load_schema(p.as_uri()) == s  # any URI that Spark reads


def test_load_schema_errors(tmp_path):
    with pytest.raises(FileNotFoundError):
        load_schema(tmp_path / "missing.json")
    with pytest.raises(SchemaError):
        load_schema({"fields": [{"name": "x", "type": "interval"}]})


def test_load_schema_accepts_spark_json(spark):
    s = StructType.fromDDL("a array<int>, m map<string,double>")
    assert load_schema(json.loads(s.json())) == s


def test_csv_reordered_header_fails_with_strict_header(spark):
    path = scratch_path(spark, "csv_hdr")
    spark.createDataFrame([(1, 2)], "b int, a int").write.option("header", "true").csv(path)
    schema = StructType.fromDDL("a int, b int")
    with pytest.raises(Exception):
        read_dataset(spark, path, "csv", schema).collect()
    loose = read_dataset(spark, path, "csv", schema, strict_header=False).first()
    assert (loose.a, loose.b) == (1, 2)  # bound by position: the trap strict mode prevents


def test_json_lines_reads_every_record(spark):
    path = scratch_path(spark, "jsonl")
    os.makedirs(path)
    with open(os.path.join(path, "part.json"), "w") as fh:
        fh.write('{"a": 1}\n{"a": 2}\n{"a": "x"}\n')
    df = read_dataset(spark, path, "json", StructType.fromDDL("a int"))
    assert df.count() == 3
    valid, rejected = validate_schema(read_dataset(spark, path, "json"), {"fields": [{"name": "a", "type": "integer", "nullable": False}]})
    assert sorted(r.a for r in valid.collect()) == [1, 2]
    assert [r._reject_reason for r in rejected.collect()] == ["a: not a int"]


def test_validate_schema_null_in_not_null_and_missing_column(spark):
    df = spark.createDataFrame([(1, None), (None, "x")], "a int, b string")
    valid, rejected = validate_schema(df, {"fields": [{"name": "a", "type": "integer", "nullable": False}, {"name": "b", "type": "string", "nullable": False}]})
    assert valid.count() == 0
    assert sorted(r._reject_reason for r in rejected.collect()) == ["a: null", "b: null"]
    with pytest.raises(SchemaError):
        validate_schema(df, {"fields": [{"name": "zz", "type": "string"}]})


def test_read_datasets_rejects_name_collisions(spark):
    with pytest.raises(ValueError):
        read_datasets(spark, [{"name": "orders", "path": "/x"}], taken={"orders"})


def test_incremental_filter_excludes_mark_and_overlap_includes_it(spark):
    df = spark.createDataFrame(
        [(1, dt.datetime(2020, 1, 1)), (2, dt.datetime(2020, 1, 2)), (3, dt.datetime(2020, 1, 3))], "k int, ts timestamp_ntz"
    )
    mark = dt.datetime(2020, 1, 2)
    assert [r.k for r in incremental_filter(df, "ts", mark).collect()] == [3]
    assert sorted(r.k for r in incremental_filter(df, "ts", mark, overlap=dt.timedelta(days=1)).collect()) == [1, 2, 3]
    assert incremental_filter(df, "ts", None).count() == 3
    plan = incremental_filter(df, "ts", mark)._jdf.queryExecution().optimizedPlan().toString()
    assert "2020-01-02" in plan


def test_new_watermark_and_store(spark):
    df = spark.createDataFrame([(1, dt.date(2020, 1, 5))], "k int, d date")
    empty = df.filter(F.col("k") > 5)
    r = new_watermark(df, "t", "d", dt.date(2020, 1, 1)).first()
    assert r.new_watermark == dt.date(2020, 1, 5) and r.new_rows == 1
    r2 = new_watermark(empty, "t", "d", dt.date(2020, 1, 1)).first()
    assert r2.new_watermark == dt.date(2020, 1, 1) and r2.new_rows == 0
    store = WatermarkStore(spark, scratch_path(spark, "marks"))
    assert store.get("t") is None
    store.commit("t", "d", dt.date(2020, 1, 5), 1)
    store.commit("t", "d", dt.date(2020, 2, 1), 2)
    assert store.get("t") == "2020-02-01"


def test_jdbc_options_and_bounds():
    o = jdbc_options("jdbc:x://h/db", "public.orders", properties={"user": "u"}, partition_column="id", bounds=(1, 100), num_partitions=4)
    assert o["partitionColumn"] == "id" and o["numPartitions"] == "4" and o["lowerBound"] == "1" and o["fetchsize"] == "10000"
    one = jdbc_options("jdbc:x://h/db", "t", partition_column="id", bounds=None, num_partitions=4)
    assert "partitionColumn" not in one
    assert bound_value(dt.date(2020, 1, 1)) == dt.date(2020, 1, 1)
    with pytest.raises(TypeError):
        bound_value("abc")


def test_load_increment_advances_mark_only_after_the_write(spark):
    from tidemark.sinks.tables import append_batch
    from tidemark.sources.incremental import load_increment

    src = scratch_path(spark, "inc_src")
    tgt = scratch_path(spark, "inc_tgt")
    store = WatermarkStore(spark, scratch_path(spark, "inc_marks"))
    schema = "k int, ts timestamp_ntz"
    spark.createDataFrame([(1, dt.datetime(2020, 1, 1)), (2, dt.datetime(2020, 1, 2))], schema).write.mode("append").parquet(src)

    def sink(batch, run_id):
        append_batch(batch, tgt, run_id)

    r1 = load_increment(spark.read.parquet(src), "t", "ts", store, sink, 1)
    assert r1["rows"] == 2 and r1["previous"] is None and r1["new"] == "2020-01-02 00:00:00"
    spark.createDataFrame([(3, dt.datetime(2020, 1, 3)), (4, dt.datetime(2020, 1, 2))], schema).write.mode("append").parquet(src)

    def failing(batch, run_id):
        raise RuntimeError("sink down")

    with pytest.raises(RuntimeError):
        load_increment(spark.read.parquet(src), "t", "ts", store, failing, 2)
    assert store.get("t") == "2020-01-02 00:00:00"  # unchanged after the failure
    r2 = load_increment(spark.read.parquet(src), "t", "ts", store, sink, 2)
    assert r2["rows"] == 1 and r2["new"] == "2020-01-03 00:00:00"
    r3 = load_increment(spark.read.parquet(src), "t", "ts", store, sink, 3)
    assert r3["rows"] == 0 and r3["new"] == "2020-01-03 00:00:00"
    assert sorted(r.k for r in spark.read.parquet(tgt).collect()) == [1, 2, 3]


def test_partitioned_dataset_declared_types_and_pruning(spark, sf_small):
    from tidemark import fixtures as fx

    path = scratch_path(spark, "materials_by_month")
    fx.raw_materials(spark, sf_small).write.partitionBy("year", "month").parquet(path)
    schema = {"fields": [
        {"name": "material_id", "type": "long", "nullable": False},
        {"name": "material_name", "type": "string"},
        {"name": "material_category", "type": "string"},
        {"name": "unit_price", "type": "decimal(18,2)"},
        {"name": "supplier_id", "type": "long"},
        {"name": "lead_time_days", "type": "integer"},
        {"name": "year", "type": "integer", "nullable": False},
        {"name": "month", "type": "integer", "nullable": False},
    ]}
    df = read_dataset(spark, path, "parquet", schema)
    assert dict(df.dtypes)["month"] == "int" and dict(df.dtypes)["year"] == "int"
    feb = df.filter(F.col("month") == 2)
    plan = feb._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and "(month" in plan
    assert feb.count() == fx.raw_materials(spark, sf_small).filter(F.col("month") == 2).count()


def test_read_tables_wires_config_and_marks(spark, monkeypatch):
    from tidemark.sources import jdbc

    calls = []

    def fake_read_jdbc(spark_, url, table, **kw):
        calls.append((table, kw))
        return spark_.range(1)

    monkeypatch.setattr(jdbc, "read_jdbc", fake_read_jdbc)
    tables = [
        {"name": "orders", "partition_column": "order_id", "num_partitions": 20, "fetch_size": 10000, "incremental_column": "order_date"},
        {"name": "products", "dbtable": "public.products", "partition_column": "product_id", "num_partitions": 4, "fetch_size": 5000},
    ]
    out = jdbc.read_tables(spark, "jdbc:x://h/db", tables, {"user": "u"}, watermarks={"orders": "2024-01-01"})
    assert set(out) == {"orders", "products"}
    (t1, k1), (t2, k2) = calls
    assert t1 == "orders" and k1["num_partitions"] == 20 and k1["mark"] == "2024-01-01" and k1["incremental_column"] == "order_date"
    assert t2 == "public.products" and k2["fetch_size"] == 5000 and k2["mark"] is None and k2["properties"] == {"user": "u"}


def test_flagged_rows_written_once_split_by_validity(spark):
    from tidemark.sources.schema import flag_schema_violations

    df = spark.createDataFrame([(1, "x"), (None, "y"), (3, None)], "a int, b string")
    flagged = flag_schema_violations(df, {"fields": [{"name": "a", "type": "integer", "nullable": False}, {"name": "b", "type": "string"}]})
    path = scratch_path(spark, "flagged")
    flagged.withColumn("is_valid", F.col("_reject_reason").isNull()).write.partitionBy("is_valid").parquet(path)
    back = spark.read.parquet(path).withColumn("is_valid", F.col("is_valid").cast("boolean"))  # folder values are text
    assert back.filter("is_valid").count() == 2 and back.filter("NOT is_valid").first()._reject_reason == "a: null"


def test_malformed_csv_records_keep_their_text_and_reason(spark, tmp_path):
    lines = ["k,n,day", "1,5,2024-01-02", "2,x,2024-01-02", "3,6,soon", ",7,2024-01-02", "5,,", "6,1", "7,y,never", '8,"9",2024-01-02']
    (tmp_path / "a.csv").write_text("\n".join(lines) + "\n")
    schema = {"fields": [{"name": "k", "type": "long", "nullable": False}, {"name": "n", "type": "integer"}, {"name": "day", "type": "date"}]}
    ok, bad = read_checked(spark, str(tmp_path), "csv", schema)
    assert sorted(r.k for r in ok.collect()) == [1, 5, 8] and ok.columns == ["k", "n", "day"]
    got = {r.k: (r._corrupt_record, r._reject_reason) for r in bad.collect()}
    assert got[2] == ("2,x,2024-01-02", "n: not a int") and got[3] == ("3,6,soon", "day: not a date")
    assert got[7][1] == "n: not a int; day: not a date" and got[None] == (None, "k: null") and got[6][0] == "6,1"
    assert ok.select("k").count() == 3 and bad.select("k").count() == 5  # whatever a query selects


def test_malformed_json_records_keep_their_text_and_reason(spark, tmp_path):
    lines = ['{"k":1,"n":5}', '{"k":2,"n":"x"}', '{"k":3,"n"', '{"n":4}', '{"k":5}', "[]", '{"k":"a","n":"b"}']
    (tmp_path / "a.json").write_text("\n".join(lines) + "\n")
    schema = {"fields": [{"name": "k", "type": "long", "nullable": False}, {"name": "n", "type": "integer"}]}
    ok, bad = read_checked(spark, str(tmp_path), "json", schema)
    assert sorted(r.k for r in ok.collect()) == [1, 5]
    got = {(r._corrupt_record, r._reject_reason) for r in bad.collect()}
    assert {(lines[1], "n: not a int"), (lines[2], "malformed record"), (None, "k: null"), (lines[6], "k: not a bigint; n: not a int")} <= got
    assert read_checked(spark, str(tmp_path), "json", schema)[1].count() == len(got) == bad.count()
    with pytest.raises(ValueError):
        read_checked(spark, str(tmp_path), "parquet", schema)
