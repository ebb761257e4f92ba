"""Token counts through a digest cache.

The cache is a table (content, tokenizer, n_tokens): the digest of a normalised text, the
digest of the tokenizer's file, and the stored count.  Counting joins the documents' digests
with the cache, encodes each distinct missing content once, appends the counts, and joins
again.  A changed tokenizer file has another digest, so its old counts are never used.

Normalisation only turns null into the empty text: every other change could change a count.
Two jobs that append the same content at once leave equal rows, which readers fold.

Scale: texts are shuffled once, already reduced to one per digest in each task; a content
that makes up a third of all rows is one row per task.  All other joins carry digests only.

Edge cases: null and empty texts have 0 tokens and 0 bytes; repeated rows and null ids stay
rows of their own; whole texts are encoded, however long; an empty table gives no row.
"""

from __future__ import annotations

from functools import lru_cache
from hashlib import sha256
from pathlib import Path

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm import terms
from millrace.llm.common import written

CACHE = "content string, tokenizer string, n_tokens long"


@lru_cache(1)
def _pieces(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def version_of(path: str) -> str:
    """Digest of a tokenizer's file."""
    return sha256(Path(path).read_bytes()).hexdigest()


def open_cache(spark: SparkSession, path: str) -> DataFrame:
    """The cache at ``path``; an empty one where nothing was appended yet."""
    try:
        return spark.read.schema(CACHE).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], CACHE)


def normalised(text: str = "text"):
    return F.coalesce(F.col(text), F.lit(""))


def fill_cache(docs: DataFrame, cache: str, tokenizer: str) -> None:
    """Encode the distinct texts that the cache lacks for this tokenizer and append their counts."""
    spark, version = docs.sparkSession, version_of(tokenizer)
    stored = open_cache(spark, cache).where(F.col("tokenizer") == version).select("content")
    texts = docs.select(F.sha2(normalised(), 256).alias("content"), normalised().alias("text"))
    missing = texts.groupBy("content").agg(F.first("text").alias("text")).join(stored, "content", "left_anti")

    def count(batches):
        pieces = _pieces(tokenizer)
        for batch in batches:
            _, offsets = terms.buffer_of(batch["text"])
            counts: list[int] = []
            for a, b in terms.slices(offsets):
                counts += map(len, pieces.encode(batch["text"].slice(a, b - a).to_pylist(), num_threads=1))
            yield pa.RecordBatch.from_arrays(
                [batch["content"], pa.array([version] * len(counts), pa.string()), pa.array(counts, pa.int64())],
                ["content", "tokenizer", "n_tokens"],
            )

    missing.mapInArrow(count, CACHE).write.mode("append").parquet(cache)


def count_tokens(docs: DataFrame, cache: str, tokenizer: str) -> DataFrame:
    """doc_id, n_bytes and n_tokens of every row of ``docs`` (doc_id, text), by way of the cache at ``cache``."""
    fill_cache(docs, cache, tokenizer)
    spark, version = docs.sparkSession, version_of(tokenizer)
    stored = open_cache(spark, cache).where(F.col("tokenizer") == version)
    stored = written(stored.groupBy("content").agg(F.max("n_tokens").alias("n_tokens")), "token-counts")
    keyed = docs.select("doc_id", F.octet_length(normalised()).cast("long").alias("n_bytes"), F.sha2(normalised(), 256).alias("content"))
    return keyed.join(stored, "content").select("doc_id", "n_bytes", "n_tokens")
