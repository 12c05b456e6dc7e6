import importlib
import random

import pytest

import corpus_pipeline as cp
from tidemark.llm import decontam, jaccard, mixing, quality, secrets

BENCH = " ".join(f"bench{i}" for i in range(30))


def corpus(rng):
    words = [f"{a}{b}{c}" for a in "bdfgl" for b in "aeiou" for c in ("nd", "rt", "st", "mp", "lk")]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    rows = []
    for i in range(120):
        t = text(rng.randint(30, 80))
        if i % 10 == 3:
            t = t.upper().replace(" ", "!! ")
        if i % 10 == 5:
            t += " password=abcdefgh1"
        if i % 10 == 7:
            t = BENCH + " " + t
        if i % 10 == 9:
            t = rows[i - 1][1] + " extra"
        rows.append((i, t, "en", f"s{i % 4}", len(t)))
    return rows


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("tables"))
    rows = corpus(random.Random(16))
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame([(1, BENCH)], "item_id bigint, text string").write.parquet(f"{base}/benchmark.parquet")
    labels = [(i, int(i % 10 != 3), 0) for i in range(0, 120)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    return base, rows


def test_run_equals_the_stages_by_hand(spark, tables):
    """The whole pipeline against plain Python over the same rows."""
    base, rows = tables
    got = {r.doc_id: r for r in cp.run(spark, base).collect()}
    left = {i: t for i, t, *_ in rows if i % 10 != 3}  # junk goes
    left = {i: t for i, t in left.items() if i % 10 != 9}  # near copies of the document before go
    left = {i: t for i, t in left.items() if i % 10 != 7}  # benchmark text goes
    left = {i: secrets.redact_text(t) for i, t in left.items()}
    d = spark.createDataFrame([(i, t, f"s{i % 4}") for i, t in left.items()], "doc_id bigint, text string, source string")
    taken = {r.doc_id: r.taken for r in mixing.mix(d).collect() if r.taken}
    assert {i: r.taken for i, r in got.items()} == taken
    assert all(r.text == left[i] and r.n_chars == len(r.text) and r.copies * len(r.text.split()) == r.taken for i, r in got.items())
    assert not any("abcdefgh1" in r.text for r in got.values())


def test_stages_keep_the_columns(spark, tables):
    base, _ = tables
    docs = spark.read.parquet(f"{base}/documents.parquet")
    assert [len(s) for s in cp.STAGES] == [2] * 5 and cp.ORACLE_SQL is None
    for _, stage in cp.STAGES[:-1]:
        assert stage(spark, docs, base).columns == docs.columns


def test_empty_and_null_tables(spark, tmp_path, tables):
    base, _ = tables
    schema = spark.read.parquet(f"{base}/documents.parquet").schema
    for name, rows in (("none", []), ("nulls", [(1, None, None, None, None), (2, "", None, None, 0), (None, "a b c d e f", None, None, 11)])):
        d = f"{tmp_path}/{name}"
        spark.createDataFrame(rows, schema).write.parquet(f"{d}/documents.parquet")
        spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{d}/benchmark.parquet")
        spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
        assert {r.doc_id for r in cp.run(spark, d).collect()} == ({None} if rows else set())


def test_registered():
    entry = importlib.import_module("__spark_entry__")
    names = [n for n in entry.queries() if n.startswith("op") and n[2].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()
    assert "op5_pareto_mix" in entry.oracle_sql()
    assert decontam.MIN_COVERAGE and jaccard.THRESHOLD == (80, 100) and quality.KEEP_TAIL == 0.7
