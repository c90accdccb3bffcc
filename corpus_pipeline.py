"""A corpus pipeline over the operators of sparkledger.llm: from raw documents to packed token sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; what one returns is written as Parquet and read again by the
next.  All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sparkledger.llm import decontamination, jaccard_join, language_id, secrets
from sparkledger.llm.packing import packed_documents
from sparkledger.llm.shared import stored, table

#: A prediction under this calibrated probability counts as no language.
MIN_SCORE = 0.5


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages; texts without letters and those of no clear language go."""
    return language_id.recognised(docs, language_id.train(language_id.learned_rows(docs)), min_score=MIN_SCORE)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (that of the least id) of each group that links reach."""
    return jaccard_join.one_of_each_group(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark windows cover less than a twentieth of the words."""
    return decontamination.cleaned(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every found secret replaced; n_chars follows the text."""
    return secrets.redacted(docs, chars_col="n_chars")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all documents' token pieces in sequences."""
    return packed_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", keep_languages),
    ("jaccard_join", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("secret_scan", redact_secrets),
    ("best_fit_packing", pack_sequences),
]

#: No SQL: training, tokenisation and packing are not expressible; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents; each result is a table that the next one reads."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
