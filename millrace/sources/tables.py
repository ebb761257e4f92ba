"""Layered table folders: ``root/env_layer/domain/table`` as parquet."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class Layout:
    root: str
    env: str = "dev"
    domain: str = "main"

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{self.env}_{layer}/{self.domain}/{table}"

    def checkpoint(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{self.env}_checkpoints/{self.domain}/{table}"


def read_table(spark: SparkSession, path: str, stream: bool = False, schema: StructType | None = None) -> DataFrame:
    if not stream:
        return spark.read.parquet(path)
    return spark.readStream.schema(schema or spark.read.parquet(path).schema).parquet(path)


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    clusters: int | None = None,
) -> None:
    """Full rewrite (or append).

    ``cluster_by`` range-partitions and sorts by the keys a reader filters on, so parquet
    row-group statistics can skip; range partitioning splits a hot key by its next key.
    """
    out = df
    if cluster_by:
        out = out.repartitionByRange(*([clusters] if clusters else []), *cluster_by).sortWithinPartitions(*cluster_by)
    writer = out.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Rewrite only the partitions present in ``df`` (touched days), leaving the others."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", "true").csv(path)
