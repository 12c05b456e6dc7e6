import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.operators.changes import changed_keys, changed_rows, row_changes
from tidemark.operators.upsert import DuplicateKeyError, upsert
from tidemark.session import scratch_path
from tidemark.sinks import tables
from tidemark.sinks.tables import append_batch, read_current, stage, upsert_table, write_overwrite, write_table


def test_upsert_replaces_inserts_and_matches_null_keys(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n-old")], "k int, v string")
    source = spark.createDataFrame([(2, "B"), (3, "C"), (None, "n-new")], "k int, v string")
    got = sorted(upsert(target, source, ["k"]).collect(), key=lambda r: (r.k is None, r.k))
    assert [(r.k, r.v) for r in got] == [(1, "a"), (2, "B"), (3, "C"), (None, "n-new")]


def test_upsert_twice_changes_nothing_and_key_only_tables_work(spark):
    target = spark.createDataFrame([(1,), (2,)], "k int")
    source = spark.createDataFrame([(2,), (3,)], "k int")
    once = upsert(target, source, ["k"])
    twice = upsert(once, source, ["k"])
    assert sorted(once.collect()) == sorted(twice.collect()) == sorted(spark.createDataFrame([(1,), (2,), (3,)], "k int").collect())


def test_upsert_rejects_duplicate_source_keys(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    source = spark.createDataFrame([(2, "x"), (2, "y")], "k int, v string")
    with pytest.raises(DuplicateKeyError):
        upsert(target, source, ["k"])


def test_versioned_upsert_table(spark):
    path = scratch_path(spark, "t_upsert")
    assert read_current(spark, path) is None
    upsert_table(spark, spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), path, ["k"])
    out = upsert_table(spark, spark.createDataFrame([(2, "B")], "k int, v string"), path, ["k"])
    assert sorted((r.k, r.v) for r in out.collect()) == [(1, "a"), (2, "B")]
    assert sorted((r.k, r.v) for r in read_current(spark, path).collect()) == [(1, "a"), (2, "B")]


def test_append_batch_is_idempotent(spark):
    path = scratch_path(spark, "t_append")
    b1 = spark.createDataFrame([(1,), (2,)], "x int")
    b2 = spark.createDataFrame([(3,)], "x int")
    append_batch(b1, path, 1)
    append_batch(b2, path, 2)
    append_batch(b2, path, 2)
    got = sorted((r.x, r.batch_id) for r in spark.read.parquet(path).collect())
    assert got == [(1, 1), (2, 1), (3, 2)]


def test_overwrite_and_stage(spark):
    path = scratch_path(spark, "t_over")
    write_overwrite(spark.range(5), path)
    write_overwrite(spark.range(3), path)
    assert spark.read.parquet(path).count() == 3
    staged = stage(spark.range(4).withColumn("y", F.col("id") * 2), scratch_path(spark, "t_stage"))
    assert staged.count() == 4 and staged.columns == ["id", "y"]


def test_write_table_rejects_bad_modes_up_front(spark):
    df = spark.range(1)
    with pytest.raises(ValueError):
        write_table(df, scratch_path(spark, "x"), "merge")
    with pytest.raises(ValueError):
        write_table(df, scratch_path(spark, "x"), "append")
    with pytest.raises(ValueError):
        write_table(df, scratch_path(spark, "x"), "upsert")


def test_merge_into_a_table_that_an_overwrite_wrote(spark):
    path = scratch_path(spark, "t_over_merge")
    write_overwrite(spark.createDataFrame([(1, "a", 5), (2, "b", 6)], "k int, v string, year int"), path)
    write_table(spark.createDataFrame([(2, "B", 7)], "k int, v string, year int"), path, "merge", merge_keys=["k"])
    assert sorted(tuple(r) for r in read_current(spark, path).collect()) == [(1, "a", 5), (2, "B", 7)]


def test_upsert_keeps_columns_that_the_batch_does_not_carry(spark):
    target = spark.createDataFrame([(1, "a", "keep1"), (2, "b", "keep2"), (None, "n", "keep3")], "k int, v string, note string")
    source = spark.createDataFrame([(2, "B", 9), (None, "N", 8), (4, "D", 7)], "k int, v string, extra int")
    got = sorted((tuple(r) for r in upsert(target, source, ["k"]).collect()), key=str)
    assert got == sorted([(1, "a", "keep1", None), (2, "B", "keep2", 9), (None, "N", "keep3", 8), (4, "D", None, 7)], key=str)


def _files(path):
    """Data file names per bucket folder of a merged table."""
    root = Path(path) / "_merged"
    return {d.name: sorted(f.name for f in d.iterdir() if f.name.startswith("part-")) for d in root.iterdir() if "=" in d.name}


def test_merge_rewrites_touched_buckets_only(spark):
    path = scratch_path(spark, "t_buckets")
    upsert_table(spark, spark.range(1000).select(F.col("id").alias("k"), F.lit("a").alias("v")), path, ["k"], buckets=16)
    before = _files(path)
    assert len(before) == 16
    out = upsert_table(spark, spark.createDataFrame([(7, "b"), (5000, "c")], "k int, v string"), path, ["k"])  # other integer type
    after = _files(path)
    changed = [b for b in before if before[b] != after[b]]
    assert 1 <= len(changed) <= 2 and set(after) == set(before)
    assert out.count() == 1001 and out.schema["k"].dataType.simpleString() == "bigint"
    assert sorted(r.k for r in out.filter("v != 'a'").collect()) == [7, 5000]


def test_unchanged_rows_touch_no_bucket(spark):
    path = scratch_path(spark, "t_same")
    rows = [(i, "a" if i % 3 else None) for i in range(50)]
    upsert_table(spark, spark.createDataFrame(rows, "k int, v string"), path, ["k"], buckets=8)
    before = _files(path)
    upsert_table(spark, spark.createDataFrame(rows[10:20], "k int, v string"), path, ["k"])
    assert _files(path) == before
    upsert_table(spark, spark.createDataFrame([*rows[10:20], (3, "")], "k int, v string"), path, ["k"])  # NULL became ''
    assert sum(_files(path)[b] != before[b] for b in before) == 1
    assert read_current(spark, path).filter("k = 3").first().v == ""


def test_a_broken_off_merge_is_seen_and_finished(spark, monkeypatch):
    path = scratch_path(spark, "t_broken")
    upsert_table(spark, spark.createDataFrame([(i, "a") for i in range(20)], "k int, v string"), path, ["k"], buckets=4)

    def stop(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(tables, "_place", stop)
        with pytest.raises(RuntimeError):
            upsert_table(spark, spark.createDataFrame([(3, "b"), (30, "b")], "k int, v string"), path, ["k"])
    seen = {r.k: r.v for r in read_current(spark, path).collect()}
    assert len(seen) == 21 and seen[3] == seen[30] == "b"
    out = upsert_table(spark, spark.createDataFrame([(4, "c")], "k int, v string"), path, ["k"])
    got = {r.k: r.v for r in out.collect()}
    assert got == {**seen, 4: "c"}
    # broken off before the commit: nothing is seen
    with monkeypatch.context() as m:
        m.setattr(tables, "_log", stop)
        with pytest.raises(RuntimeError):
            upsert_table(spark, spark.createDataFrame([(5, "x")], "k int, v string"), path, ["k"])
    assert {r.k: r.v for r in read_current(spark, path).collect()} == got
    assert {r.k: r.v for r in upsert_table(spark, spark.createDataFrame([(6, "y")], "k int, v string"), path, ["k"]).collect()} == {**got, 6: "y"}


def test_merge_with_new_and_absent_columns_and_null_keys(spark):
    path = scratch_path(spark, "t_cols")
    upsert_table(spark, spark.createDataFrame([(1, "a", 5), (None, "n", 6), (3, "c", 7)], "k int, v string, w int"), path, ["k"], buckets=4)
    upsert_table(spark, spark.createDataFrame([(1, "A"), (None, "N")], "k int, v string"), path, ["k"])
    out = upsert_table(spark, spark.createDataFrame([(3, "C", 9, 1.5)], "k int, v string, w int, z double"), path, ["k"])
    assert sorted((tuple(r) for r in out.collect()), key=str) == sorted([(1, "A", 5, None), (None, "N", 6, None), (3, "C", 9, 1.5)], key=str)


def test_row_changes(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (None, "n"), (5, "gone")], "k int, v string")
    new = spark.createDataFrame([("a", 1), ("B", 2), ("", 3), ("n", None), ("x", 6)], "v string, k int")
    got = {r.k: r.change for r in row_changes(old, new, ["k"]).collect()}
    assert got == {1: "unchanged", 2: "updated", 3: "updated", None: "unchanged", 5: "absent", 6: "inserted"}
    assert sorted((r.k for r in changed_rows(old, new, ["k"]).collect()), key=str) == [2, 3, 6]
    assert changed_keys(old, new, ["k"]).count() == 4 and changed_keys(old, old, ["k"]).count() == 0


def test_a_merge_writes_in_place_first_and_then_shuffles_once(spark, monkeypatch):
    path = scratch_path(spark, "t_once")
    placed = []
    real = tables._place
    monkeypatch.setattr(tables, "_place", lambda *a: (placed.append(a), real(*a)))
    rows = [(i, "a" if i % 3 else None) for i in range(60)]
    upsert_table(spark, spark.createDataFrame(rows, "k int, v string"), path, ["k"], buckets=4)
    assert not placed and not (Path(path) / "_pending").exists()  # no bucket to replace: one write
    near = tables._merged(spark, path, "parquet")
    batch = tables._bucketed(spark.createDataFrame([*rows[:20], (70, "new"), (None, "n")], "k int, v string"), ["k"], "key_bucket_4")
    merged = tables._resolved(near, batch, ["k"], "key_bucket_4")
    plan = merged._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert plan.count("Exchange") == 1 and "Join" not in plan
    assert sorted((r.k for r in merged.filter(tables.CHANGED).collect()), key=str) == [70, None] and merged.count() == 62
    upsert_table(spark, spark.createDataFrame([(70, "new")], "k int, v string"), path, ["k"])
    assert len(placed) == 1 and read_current(spark, path).count() == 61


def test_the_first_merge_shuffles_nothing_unless_many_tasks_write(spark, monkeypatch):
    rows = spark.range(0, 300, 1, 3).select(F.col("id").alias("k"), F.lit("a").alias("v"))
    monkeypatch.setattr(tables, "FIRST_ROWS", 300)
    for first_tasks, files in ((tables.FIRST_TASKS, 3), (2, 1)):
        monkeypatch.setattr(tables, "FIRST_TASKS", first_tasks)
        path = scratch_path(spark, "t_first")
        assert upsert_table(spark, rows, path, ["k"], buckets=4).count() == 300
        assert {len(f) for f in _files(path).values()} == {files} and all(".zstd." in f for b in _files(path).values() for f in b)


def test_row_hashes_are_shuffled_as_bytes(spark):
    values = ["0a" * 32, "0A" * 32, "0a" * 32 + "\n", "0a" * 31, "x" * 64, "", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "k int, _etl_row_hash string")
    names = tables._hash_columns(df)
    packed = tables._bytes_for(df, names)
    assert names == ["_etl_row_hash"] and [r.k for r in packed.filter("__tm_b0 IS NOT NULL").collect()] == [0]
    back = tables._texts_for(packed, names)
    assert back.columns == df.columns and [tuple(r) for r in back.orderBy("k").collect()] == list(enumerate(values))
    path = scratch_path(spark, "t_hashes")
    upsert_table(spark, df, path, ["k"], buckets=2)
    out = upsert_table(spark, df.filter("k < 6").withColumn("v", F.lit(1)).select("k", F.reverse("_etl_row_hash").alias("_etl_row_hash")), path, ["k"])
    assert out.count() == len(values)


def _merge_twice(spark, rows, batches, at_rest):
    """A table of ``rows`` after the batches, and its files after each merge."""
    path = scratch_path(spark, "t_places")
    upsert_table(spark, rows, path, ["k"], buckets=4)
    seen = [_files(path)]
    for batch in batches:
        upsert_table(spark, stage(batch, scratch_path(spark, "t_batch")), path, ["k"], at_rest=at_rest)
        seen.append(_files(path))
    return path, seen


def test_a_batch_at_rest_is_merged_by_the_places_of_its_rows(spark, monkeypatch):
    monkeypatch.setattr(tables, "PICK_ROWS", 1)
    kind = "k bigint, v string, _etl_run int"
    old = spark.createDataFrame([(i, "a" if i % 3 else None, 1) for i in range(300)] + [(None, "n", 1)], kind).repartition(3)
    new = spark.createDataFrame([(i, "a" if i % 3 else ("" if i % 2 else None), 2) for i in range(250, 400)] + [(None, "m", 2)], kind).repartition(5)
    monkeypatch.setattr(tables, "_resolved", lambda *_: pytest.fail("rows are not shuffled"))
    path, files = _merge_twice(spark, old, [new, new], True)
    assert files[1] != files[0] and files[2] == files[1]  # the second time the target has every row
    monkeypatch.undo()
    whole, _ = _merge_twice(spark, old, [new], False)
    got, want = read_current(spark, path), read_current(spark, whole)
    assert got.count() == 401 and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert {r.k: r._etl_run for r in got.filter("k in (251, 252, 261)").collect()} == {251: 1, 252: 1, 261: 2}
    assert not [d for d in (Path(path) / "_pending").iterdir() if "=" in d.name]  # moved, not copied
    monkeypatch.setattr(tables, "PICK_ROWS", 1)
    monkeypatch.setattr(tables, "PICK_BLOCKS", 0)  # too many rows for their bits to be broadcast
    path, _ = _merge_twice(spark, old, [new], True)
    assert read_current(spark, path).exceptAll(want).isEmpty()


def test_rows_are_picked_without_a_shuffle_and_over_blocks(spark):
    path = scratch_path(spark, "t_blocks")
    upsert_table(spark, spark.range(100_000).select(F.col("id").alias("k"), F.lit("a").alias("v")).coalesce(1), path, ["k"], buckets=1)
    batch = stage(spark.range(90_000, 190_000).select(F.col("id").alias("k"), F.when(F.col("id") % 2 == 0, "b").otherwise("a").alias("v")).coalesce(1), scratch_path(spark, "t_batch"))
    near = tables._located(tables._merged(spark, path, "parquet"))
    bits = tables._bits(near, tables._located(tables._bucketed(batch, ["k"], "key_bucket_1")), ["k"], "key_bucket_1")
    assert bits.count() == 8  # four blocks of 32768 rows a file
    kept = tables._picked(near, bits.filter(~F.col(tables.CHANGED)))
    plan = kept.select("k")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert kept.columns == ["k", "v", "key_bucket_1"]
    assert sorted(r.k for r in kept.collect()) == [k for k in range(100_000) if k < 90_000 or k % 2]


def test_a_move_that_broke_off_is_seen_and_finished(spark, monkeypatch):
    """Some pending folders were moved, one stands nowhere but in the pending ones, the log was not written."""
    monkeypatch.setattr(tables, "PICK_ROWS", 1)
    path = scratch_path(spark, "t_moved")
    upsert_table(spark, spark.createDataFrame([(i, "a") for i in range(40)], "k int, v string"), path, ["k"], buckets=4)
    batch = stage(spark.createDataFrame([(i, "b") for i in range(20, 60)], "k int, v string"), scratch_path(spark, "t_batch"))
    want = {i: "a" if i < 20 else "b" for i in range(60)}
    with monkeypatch.context() as m:
        m.setattr(tables, "_place", lambda *_: None)
        upsert_table(spark, batch, path, ["k"], at_rest=True)
    data, waiting = Path(path) / "_merged", Path(path) / "_pending"
    folders = sorted(d.name for d in waiting.iterdir() if "=" in d.name)
    assert len(folders) == 4
    for name in folders[:2]:
        shutil.rmtree(data / name)
    (waiting / folders[0]).rename(data / folders[0])
    assert {r.k: r.v for r in read_current(spark, path).collect()} == want
    for name in folders[1:]:  # all moved, the log is still missing
        shutil.rmtree(data / name, ignore_errors=True)
        (waiting / name).rename(data / name)
    assert {r.k: r.v for r in read_current(spark, path).collect()} == want
    out = upsert_table(spark, spark.createDataFrame([(100, "c")], "k int, v string"), path, ["k"])
    assert {r.k: r.v for r in out.collect()} == {**want, 100: "c"}
