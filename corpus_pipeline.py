"""The corpus pipeline: documents in, token ids of what is worth training on out.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the one before
it kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from coldshelf.llm import decontaminate, pieces, pii, quality, simhash
from coldshelf.llm.queries import quality_model, table
from coldshelf.llm.shared import written


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents that it rejects go."""
    return quality.good(spark, docs, quality_model(spark, docs, sf_dir))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: one document of each group stays."""
    return simhash.keep_one(spark, docs)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents that hold a benchmark item go."""
    return decontaminate.clean(spark, docs, table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """PII: personal data in the texts is masked."""
    return pii.redacted(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece: ids of each text, checked against sentencepiece and by decoding."""
    return pieces.encoded(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality", good_documents),
    ("near-dedup", one_of_each_group),
    ("decontaminate", without_benchmarks),
    ("personal-data", without_personal_data),
    ("sentencepiece", encoded),
]

# A trained classifier and a tokenizer are not for SQL; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
