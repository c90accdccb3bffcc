"""The queries of the operators in this subpackage, with production parameters, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import chat_format, decontamination, jaccard_join, language_id, licenses, merkle, oracles, secrets, substring_dedup, topk_search, toxicity, whitening
from .license_texts import TEMPLATES
from .packing import packed_documents
from .shared import table
from .token_counts import count_tokens


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.links_of_documents(table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.report(decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = spark.sql("SELECT CAST(-1 AS BIGINT) AS conv_id, CAST(k AS BIGINT) AS turn, IF(k = 0, 'user', 'assistant') AS role, '</s>[INST] ok [/INST]' AS text FROM VALUES (0), (1) AS t(k)")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat_format.conversation_digests(chat_format.windows(turns.unionByName(own)))


def op4_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk_search.quantised(table(spark, sf_dir, "embeddings"))
    return topk_search.search(vectors, vectors.where("vec_id % 50 = 0"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.deduplicated(table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(secrets.scan(table(spark, sf_dir, "documents")))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.summary(licenses.scan(table(spark, sf_dir, "documents"), TEMPLATES))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.assess(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.report(table(spark, sf_dir, "embeddings"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"), damage=merkle.without_breaks)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_jaccard_join": op1_jaccard_join,
    "op2_decontamination": op2_decontamination,
    "op3_chat_format": op3_chat_format,
    "op4_topk_search": op4_topk_search,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_token_counts": op6_token_counts,
    "op7_secret_scan": op7_secret_scan,
    "op8_language_id": op8_language_id,
    "op9_license_scan": op9_license_scan,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_toxicity": op11_toxicity,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLE_SQL: dict[str, str] = {"op2_decontamination": oracles.OP2, "op3_chat_format": oracles.OP3, "op4_topk_search": oracles.OP4, "op13_merkle_manifest": oracles.OP13}
