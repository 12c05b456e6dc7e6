"""Registered queries of the training-data operators: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import functions as F

from tidemark.llm import alignment, chat, decontam, fingerprints, html, jaccard, language, merkle, mixing, pii, quality, repeats, secrets
from tidemark.llm.common import read_table

#: Key of the registered pseudonym query; a deployment passes its own from its secret store.
PSEUDONYM_KEY = b"registered query"


def op1_lempel_ziv_fingerprint(spark, sf):
    return fingerprints.edit_neighbours(read_table(spark, sf, "documents"))


def op2_credential_linking(spark, sf):
    return secrets.scan(read_table(spark, sf, "documents"))


def op3_cumulative_link_quality(spark, sf):
    docs = read_table(spark, sf, "documents")
    return quality.grade(docs, quality.train(docs, read_table(spark, sf, "labels")))


def op4_compression_language(spark, sf):
    docs = read_table(spark, sf, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = language.learn(docs.where(~F.coalesce(held_out, F.lit(False))))
    return language.identify(docs, model).select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score", "margin", "rejected")


def op5_pareto_mix(spark, sf):
    return mixing.mix(read_table(spark, sf, "documents"))


def op6_feistel_pseudonyms(spark, sf):
    return pii.pseudonyms(read_table(spark, sf, "documents"), PSEUDONYM_KEY)


def op7_greedy_string_tiling(spark, sf):
    return decontam.contaminated(read_table(spark, sf, "documents"), read_table(spark, sf, "benchmark"))


def op8_partition_jaccard(spark, sf):
    return jaccard.components(read_table(spark, sf, "documents"))


def op9_role_repair(spark, sf):
    return chat.chat_format(read_table(spark, sf, "conversations"))


def op10_best_region(spark, sf):
    pages = read_table(spark, sf, "pages")
    return html.extract(pages, html.learn(pages))


def op11_bwt_repeats(spark, sf):
    return repeats.without_repeats(read_table(spark, sf, "documents"))


def op12_merkle_manifest(spark, sf):
    return merkle.verified(read_table(spark, sf, "documents"))


def op13_cross_tokenizer_alignment(spark, sf):
    return alignment.alignment(read_table(spark, sf, "documents"))


LLM_QUERIES = {name: f for name, f in list(globals().items()) if name.startswith("op") and name[2].isdigit()}
LLM_QUERIES["pipeline"] = corpus_pipeline.run

#: DuckDB SQL of the queries that SQL can express.
LLM_ORACLE_SQL: dict[str, str] = {"op5_pareto_mix": mixing.ORACLE_SQL, "op12_merkle_manifest": merkle.ORACLE_SQL}
