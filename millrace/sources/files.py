"""Log, text and JSON files, incremental or batch, with file lineage columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

RESCUE = "_rescued_data"
BASE_NAME = r"([^/]+)$"


def _reader(spark: SparkSession, stream: bool):
    return spark.readStream if stream else spark.read


def read_tsv(spark: SparkSession, path: str, schema: StructType, stream: bool = True, **options) -> DataFrame:
    """Tab-separated logs with a fixed schema: no header option, no inference."""
    return (
        _reader(spark, stream)
        .schema(schema)
        .options(sep="\t", header="false", inferSchema="false", **options)
        .csv(path)
    )


def read_json(
    spark: SparkSession,
    path: str,
    schema: str,
    stream: bool = True,
    multiline: bool = False,
    rescue: bool = True,
    **options,
) -> DataFrame:
    """JSON records; what does not fit the schema is kept as text in ``_rescued_data``."""
    reader = _reader(spark, stream).options(mode="PERMISSIVE", multiLine=str(multiline).lower(), **options)
    if rescue:
        schema = f"{schema}, {RESCUE} string"
        reader = reader.option("columnNameOfCorruptRecord", RESCUE)
    return reader.schema(schema).json(path)


def infer_json_schema(spark: SparkSession, path: str, multiline: bool = False, sampling: float = 1.0) -> str:
    """Schema (DDL) of existing files, to be fixed before a stream starts.  Spark infers it in
    a distributed pass; lower ``sampling`` for very large landing folders."""
    reader = spark.read.options(multiLine=str(multiline).lower(), samplingRatio=str(sampling))
    fields = [f for f in reader.json(path).schema if f.name != "_corrupt_record"]
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)


def read_lines(spark: SparkSession, path: str, stream: bool = True) -> DataFrame:
    """Raw text lines with file name and modification time."""
    return _reader(spark, stream).text(path).select(
        F.col("value").alias("raw_line"),
        F.col("_metadata.file_name").alias("_source_filename"),
        F.col("_metadata.file_modification_time").alias("_source_modified_at"),
    )


def base_name(path: str | Column) -> Column:
    return F.regexp_extract(F.col(path) if isinstance(path, str) else path, BASE_NAME, 1)


def with_file_lineage(df: DataFrame, path_as: str, name_as: str | None, ingested_as: str) -> DataFrame:
    out = df.withColumn(path_as, F.col("_metadata.file_path"))
    if name_as:
        out = out.withColumn(name_as, base_name(path_as))
    return out.withColumn(ingested_as, F.current_timestamp())
