"""The corpus pipeline: documents through five stages, each on all that its predecessor kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each result as Parquet into the shared folder and reads it back for the next.
All stages but the last return the columns of documents; the last returns the
token ids of the kept texts.  No stage can be expressed in SQL as a whole, so
there is no ``ORACLE_SQL``; tests compare the stages with brute force.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from careledger.llm import bpe, decontamination, exact_dedup, jaccard_join, language_id
from careledger.llm.common import read_table, ship_code, stored

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found stay."""
    ship_code(spark)
    return language_id.keep_identified(docs)


def drop_equal_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for white space, the longest stays."""
    return exact_dedup.keep_one_of_equal(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that five-word shingles link at 0.75 or more, the smallest id stays."""
    ship_code(spark)
    return jaccard_join.keep_one_of_near(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a copy of a benchmark item, edited or not, go."""
    ship_code(spark)
    return decontamination.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids of each document that is left."""
    ship_code(spark)
    return bpe.bpe_encode(docs.select("doc_id", "text"), public_tokenizers.path(VOCABULARY),
                          public_tokenizers.PATTERN).drop("text")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("exact_dedup", drop_equal_texts),
    ("ngram_jaccard_join", drop_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("bpe", tokenize),
]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
