"""Written intermediate tables, as a pipeline has them: raw and cleaned layers on disk.

A stage is written once per Spark application into the shared folder and read back, so
summary tables start from columnar files (pruned, with statistics) and not from the whole
lineage.  The folder comes from ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession

from millrace.session import shared_dir
from millrace.sources.tables import write_table

_written: set[str] = set()


def stage_root(spark: SparkSession, sf_dir: str) -> str:
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/millrace/{app}/{sha256(sf_dir.encode()).hexdigest()[:12]}"


def staged(
    spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame], cluster_by: Sequence[str] = ()
) -> DataFrame:
    path = f"{stage_root(spark, sf_dir)}/{name}"
    if path not in _written:
        write_table(build(), path, cluster_by=cluster_by)
        _written.add(path)
    return spark.read.parquet(path)
