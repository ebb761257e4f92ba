"""A training corpus in five stages: good documents, one of each near-copy, clean of benchmarks and personal data, as token ids.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept.  All but
the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from millrace.llm import byte_bpe, decontaminate, near_duplicates, pii, quality
from millrace.llm.common import ready, written


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; it learns from the labelled ones outside the held-out fold."""
    labels = ready(spark).read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_good(docs, quality.fit(docs, labels))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    ready(spark)
    return near_duplicates.keep_one(docs)


def no_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return decontaminate.drop_contaminated(docs, ready(spark).read.parquet(f"{sf_dir}/benchmark.parquet"))


def no_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind; ``n_chars`` follows."""
    ready(spark)
    return pii.redact(docs, pii.fit(docs))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE of every document: doc_id, n_tokens, digests of the ids and of what they decode to."""
    ready(spark)
    return byte_bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality", good_documents),
    ("near_duplicates", one_of_each),
    ("decontamination", no_benchmarks),
    ("pii", no_personal_data),
    ("byte_bpe", token_ids),
]

#: The stages hold trained models and hashed sketches, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written to the shared folder and read again."""
    docs = ready(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
