"""Helpers shared by the text operators: written tables, key folds, bounded samples."""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.session import shared_dir


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one, never used before."""
    return f"{shared_dir(spark)}/millrace-llm/{name}-{uuid4().hex}"


def written(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Cut lineage with a table in the shared folder; later steps survive lost executors and know its size."""
    path = path or fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held_out(doc_id: Column) -> Column:
    """True for the rows nothing may be learned from; rows without an id belong to them."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(True))


def bounded_sample(df: DataFrame, rows: int, *by: Column) -> DataFrame:
    """About ``rows`` rows, picked by a hash of ``by``; all of them where there are fewer.

    The rows are counted first, so the size of the sample does not grow with the table.
    """
    parts = 1 << 30
    keep = min(1.0, rows / max(1, df.count()))
    return df if keep >= 1 else df.where(F.pmod(F.xxhash64(F.lit(17), *by), F.lit(parts)) < int(keep * parts))


@contextmanager
def small_batches(spark: SparkSession, rows: int = 2_000) -> Iterator[None]:
    """Fewer rows in an Arrow batch for what is written inside: a worker and its executor hold a few of them at once."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def ready(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package also where only the driver's ``sys.path`` names it."""
    import millrace

    root = str(Path(millrace.__file__).resolve().parent.parent)
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, root]))
    return spark
