"""Corpus pipeline over `documents`: language, near duplicates, benchmark leaks, source mixture, token files.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes each result as Parquet in the shared
folder and reads it back as the next stage's documents. All stages but the last return the columns of documents.

1. language_id: documents without a letter, or in none of the languages learned from the labelled rows (other languages,
   encoded data, letter noise: more than ODDEST units from the learned texts), go.
2. near_duplicates: of each group of documents linked by 4-word shingles at a similarity of 0.85 the one with the
   smallest id stays. (The n-gram join's own contract; five words and 0.8 hold where no contract says otherwise.)
3. decontaminate: documents with a word inside a ten-word benchmark window go.
4. mix_sources: every document once at least, smaller sources repeated MAX_REPETITION times at most.
5. token_files: the mixture encoded, written in the Elias-Fano layout and read back: doc_id, start, n_tokens, ids_crc32.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, language_id, mixing, ngram_join, token_files
from tidemark.llm.queries import END_ID, MAX_REPETITION, table
from tidemark.llm.workers import reachable
from tidemark.session import materialize

ODDEST = 8.0             # language_id's units; see the README for labelled rows and noise on either side


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    reachable(spark)
    return language_id.keep(docs, language_id.fit(docs), least=0.0, oddest=ODDEST)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    reachable(spark)
    return ngram_join.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.apply(docs, max_repetition=MAX_REPETITION)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    reachable(spark)
    return token_files.write_and_read(docs, public_tokenizers.path("byte_bpe_50k.json"), END_ID)


STAGES = [
    ("language_id", keep_languages),
    ("near_duplicates", drop_near_duplicates),
    ("decontaminate", drop_leaks),
    ("mix_sources", mix_sources),
    ("token_files", write_tokens),
]

ORACLE_SQL = None        # SQL can't express the trained first stage; tests compare the rest with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
