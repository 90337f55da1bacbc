"""Registered queries of the subpackage: one per operator, each over its whole tables with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (decontaminate, language_id, mixing, ngram_join, odd_sketch, phrases, prefix_trie,
                          quality_grades, quality_rules, secret_scan, token_counts, token_files, toxicity)
from tidemark.llm.workers import reachable


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return reachable(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(decontaminate.find(table(spark, sf_dir, "documents"),
                                                   table(spark, sf_dir, "benchmark")))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(table(spark, sf_dir, "documents")))


MAX_REPETITION = 2.0     # of a source's documents in the mixture


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.schedule(table(spark, sf_dir, "documents"), max_repetition=MAX_REPETITION)


END_ID = 2


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.write_and_read(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                      END_ID)


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.predict(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.predict(docs, language_id.fit(docs))


def op10_quality_grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rated = quality_grades.ratings(table(spark, sf_dir, "labels"))
    return quality_grades.predict(docs, quality_grades.fit(docs, rated))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.build(table(spark, sf_dir, "conversations"))


def op12_odd_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return odd_sketch.join(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_decontaminate, op2_token_counts, op3_quality_rules, op4_secret_scan,
                                   op5_mix_sources, op6_token_files, op7_ngram_join, op8_toxicity, op9_language_id,
                                   op10_quality_grades, op11_prefix_trie, op12_odd_sketch, op13_phrases)}
