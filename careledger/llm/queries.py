"""The registered queries opN_<name> (whole tables, production parameters) and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from careledger.llm import (alignment, bpe, decontamination, exact_dedup, jaccard_join, language_id, lm_scoring,
                            prefix_trie, secrets, sharding, suffix_dedup, toxicity, warc)
from careledger.llm.common import read_table, ship_code
from careledger.llm.oracles import ORACLES  # noqa: F401  (registered with the queries)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_code(spark)
    return warc.archive_report(read_table(spark, sf_dir, "pages"))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_code(spark)
    return jaccard_join.jaccard_components(read_table(spark, sf_dir, "documents"), width=5, least=75)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup.exact_dedup(read_table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_code(spark)
    found = language_id.identify(language_id.document_rows(read_table(spark, sf_dir, "documents")))
    return found.withColumnRenamed("id", "doc_id")


def llm_page_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same operator on web pages, with markup, address suffix and host as evidence."""
    ship_code(spark)
    found = language_id.identify(language_id.page_rows(read_table(spark, sf_dir, "pages")))
    return found.withColumnRenamed("id", "page_id")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_code(spark)
    out = suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents"), width=50)
    return out.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_code(spark)
    return toxicity.toxicity_report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_code(spark)
    return decontamination.decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read_table(spark, sf_dir, "documents"), shards=40, overhead=16)


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(read_table(spark, sf_dir, "documents"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_code(spark)
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.bpe_encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN,
                           decoded_col="decoded")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def op11_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_code(spark)
    return lm_scoring.score_documents(read_table(spark, sf_dir, "documents"),
                                      public_tokenizers.path("piece_bpe_32k.model"), held_out=0, folds=10)


def op12_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_code(spark)
    pair = alignment.Pair.read(*map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model")))
    return alignment.alignment_report(read_table(spark, sf_dir, "documents"), pair)


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_code(spark)
    return prefix_trie.prefix_trie(read_table(spark, sf_dir, "conversations"), family=5, shared=9)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_ngram_jaccard_join": op2_ngram_jaccard_join,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_language_id": op4_language_id,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_toxicity": op6_toxicity,
    "op7_decontamination": op7_decontamination,
    "op8_sharding": op8_sharding,
    "op9_secret_scan": op9_secret_scan,
    "op10_bpe": op10_bpe,
    "op11_lm_scoring": op11_lm_scoring,
    "op12_cross_tokenizer_alignment": op12_cross_tokenizer_alignment,
    "op13_conversation_trie": op13_conversation_trie,
    "llm_page_language_id": llm_page_language_id,
}
