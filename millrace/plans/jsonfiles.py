"""JSON file ingest: checked raw records and per-file quality tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.quality import (
    Expectation, file_quality, ingestion_metrics, keep_valid, quality_alerts,
)
from millrace.operators.parse import rescue_fields
from millrace.sources.files import base_name, read_json

RECORD_SCHEMA = "DOLocationID int, PULocationID int, fare_amount double, total_amount double"
REQUIRED_ANY = ("DOLocationID", "PULocationID", "fare_amount", "total_amount")
METHOD = "streaming"  # default of the ingestion_method column

NOT_RESCUED = Expectation("valid_data", "_rescued_data IS NULL OR _rescued_data = ''")
NOT_EMPTY = Expectation("non_empty_record", " OR ".join(f"{c} IS NOT NULL" for c in REQUIRED_ANY))
BASIC_RULES = [Expectation("valid_timestamp", NOT_RESCUED.predicate)]
FULL_RULES = [NOT_RESCUED, NOT_EMPTY]


def json_records(
    spark: SparkSession, path: str, schema: str = RECORD_SCHEMA, stream: bool = True, multiline: bool = True,
    method: str = METHOD,
) -> DataFrame:
    """All records with lineage, before any rule."""
    rows = read_json(spark, path, schema, stream, multiline=multiline)
    return add_lineage(rows.withColumn("source_file_name", F.col("_metadata.file_path")), method)


def json_records_by_field(
    spark: SparkSession, path: str, schema: str = RECORD_SCHEMA, stream: bool = True, multiline: bool = False, method: str = METHOD,
) -> DataFrame:
    """As ``json_records``, but a record loses only the fields that do not fit; one object a line, or a file with ``multiline``."""
    rows = (spark.readStream if stream else spark.read).text(path, wholetext=multiline)
    rows = rows.select("value", F.col("_metadata.file_path").alias("source_file_name")).filter("trim(value) != ''")
    return add_lineage(rescue_fields(rows, "value", schema, ["source_file_name"]), method)


def add_lineage(rows: DataFrame, method: str = METHOD) -> DataFrame:
    return rows.withColumns({
        "ingestion_timestamp": F.current_timestamp(),
        "file_name": base_name("source_file_name"),
        "ingestion_method": F.lit(method),
        "ingestion_date": F.current_date(),
    })


def raw_basic(records: DataFrame) -> DataFrame:
    return keep_valid(records, BASIC_RULES)


def raw_checked(records: DataFrame) -> DataFrame:
    return keep_valid(records, FULL_RULES)


def data_quality(records: DataFrame) -> DataFrame:
    return file_quality(records, ["source_file_name"], "ingestion_timestamp")


def metrics(records: DataFrame) -> DataFrame:
    keys = ["source_file_name", "file_name", "ingestion_date"]
    return ingestion_metrics(records, keys, "ingestion_timestamp", "source_file_name")


def alerts(records: DataFrame) -> DataFrame:
    return quality_alerts(metrics(records))
