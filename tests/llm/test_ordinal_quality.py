import random

from tidemark.llm import quality as q


def sample(rng, grade):
    words = [rng.choice(["river", "stone", "walks", "green", "under", "light", "paper", "house", "quiet", "north"]) + rng.choice("abcdef") for _ in range(60)]
    if grade == 1:
        words[rng.randrange(60)] = "nastyword"
        words[rng.randrange(60)] = "vileword"
    if grade == 0:
        words = [w.upper() + "!!" for w in words]
    return " ".join(words)


def test_held_out_grades(docs, spark):
    rng = random.Random(6)
    rows = [(i, sample(rng, i % 3)) for i in range(900)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0), int(i % 3 == 1)) for i in range(600)] + [(None, 1, 0), (5000, 0, 0), (3, None, None)], "doc_id bigint, quality int, toxic int")
    d = docs(rows)
    model = q.train(d, labels)
    assert list(model.thresholds) == sorted(model.thresholds)
    got = q.grade(d.where("doc_id >= 600"), model).collect()
    right = [r.selected == (r.doc_id % 3 == 2) for r in got]
    assert len(got) == 300 and sum(right) / 300 > 0.97
    mean = {k: sum(r.expected_grade for r in got if r.doc_id % 3 == k) / 100 for k in range(3)}
    assert mean[0] < mean[1] < mean[2]
    kept = q.select(d, model)
    assert kept.columns == d.columns and abs(kept.count() - 300) < 30


def test_edges(docs, edge_docs, spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    model = q.train(edge_docs, none)
    rows = q.grade(edge_docs, model).collect()
    assert len(rows) == edge_docs.count()
    assert all(r.tail_prob > 0.999 and r.selected for r in rows)
    assert q.select(edge_docs, model).count() == edge_docs.count()
    one = spark.createDataFrame([(4, 1, 0), (4, 0, 0), (3, 1, 1)], "doc_id bigint, quality int, toxic int")
    assert {(r.doc_id, r.grade) for r in q.grades(one).collect()} == {(4, 0), (3, 1)}
    assert q.grade(edge_docs, q.train(edge_docs, one)).count() == edge_docs.count()
    assert q.grade(docs([]), model).collect() == []
    assert q.features(None) == q.features(" \n") == []


def test_the_sample_is_bounded_and_the_first_in_hash_order(docs, spark, monkeypatch):
    """One row per sampled id however often it is repeated; bucketed ranking equals the plain one."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(q, "SAMPLE_DOCS", 20)
    graded = spark.range(900).select(F.col("id").alias("doc_id"), (F.col("id") % 3).cast("int").alias("grade"))
    got = {(r.doc_id, r.grade) for r in q.sampled(graded).collect()}
    hashed = sorted((r.h, r.doc_id, r.grade) for r in graded.withColumn("h", F.xxhash64("doc_id")).collect())
    assert got == {(i, g) for grade in range(3) for _, i, g in [x for x in hashed if x[2] == grade][:20]}

    seen = []
    monkeypatch.setattr(q, "fit", lambda sample, population: seen.append(sample))
    labels = spark.createDataFrame([(1, 5, 0), (2, 0, 0)], "doc_id bigint, quality int, toxic int")
    q.train(docs([(1, f"text {i}") for i in range(300)] + [(1, None), (2, "x")]), labels)
    assert sorted(seen[0]["doc_id"].to_pylist()) == [1, 2]
