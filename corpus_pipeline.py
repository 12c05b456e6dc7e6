"""Corpus pipeline: documents -> a cleaned, deduplicated, decontaminated and mixed corpus.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; its result
is written as Parquet and read again as the next stage's ``docs``. All stages
but the last return the columns of ``documents``; the last adds the mix.

Defined cases: a stage whose side table (labels, benchmark) is empty keeps
every document; an empty table passes through; a NULL or wordless text is
graded as a text without features, links and contains nothing, and is never
taken by the mix (0 words).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontam, jaccard, mixing, quality, secrets
from tidemark.llm.common import read_table, saved

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents that it rejects go. It learns from all labelled documents of the stage's input."""
    return quality.select(docs, quality.train(docs, read_table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: one document of each group of near copies stays, the one with the smallest doc_id."""
    return jaccard.one_of_each(docs)


def drop_benchmark_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents that contain a benchmark item go."""
    return decontam.clean(docs, read_table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secret scan: every reported span is replaced by its kind; all documents stay."""
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing sources: the documents that the mix takes, with the words it takes of each and its copies."""
    return mixing.taken_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_benchmark_copies),
    ("secret scans", redact_secrets),
    ("mixing sources to target weights", mix_sources),
]

#: SQL cannot express the stages before the mix; tests hold run() against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
