"""Corpus pipeline: quality filter, near-duplicate removal, secret redaction, packing.

Defined cases, for every stage: null and empty texts, very long ones, rows that repeat
and rows without a doc_id are treated as the stage's operator says; an empty table gives
no rows; the columns that operators do not know pass through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from leafmill.llm import packing, quality, secrets, shingle_dedup
from leafmill.llm.queries import vocabulary
from leafmill.runtime import cut, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on this input's labels, does not reject."""
    config = quality.QualityConfig()
    weights = quality.train(docs, table(spark, sf_dir, "labels"), config)
    return quality.accepted(docs, weights, config)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: 0.8 or more of five-word shingles alike."""
    return shingle_dedup.keep_one(docs)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with live-looking credentials blanked out."""
    return secrets.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed token sequences."""
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", quality_stage),
    ("near-duplicates", near_duplicate_stage),
    ("secret scan", secret_stage),
    ("packing", packing_stage),
]

#: Learning, XXH64 and tokenization are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages one after another; each one's rows are written before the next reads them, which it does more than once."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut(docs)
    return docs
