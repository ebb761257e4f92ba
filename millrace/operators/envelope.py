"""Raw-layer projections of message envelopes, and lineage columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Column names are fixed values: downstream tables read them.
_STYLES = {
    "plain": (
        ("key", "key"),
        ("timestamp", "timestamp"),
        ("topic", "topic"),
        ("current_timestamp()", "processing_time"),
        ("CAST(value AS STRING)", "raw_data"),
    ),
    "keyed": (
        ("CAST(key AS STRING)", "_kafka_key"),
        ("CAST(value AS STRING)", "_raw_json"),
        ("topic", "_topic"),
        ("partition", "_partition"),
        ("offset", "_offset"),
        ("timestamp", "_kafka_timestamp"),
        ("current_timestamp()", "_ingested_at"),
    ),
    "offset": (
        ("CAST(value AS STRING)", "raw_data"),
        ("topic", "_topic"),
        ("partition", "_kafka_partition"),
        ("offset", "_kafka_offset"),
        ("timestamp", "_kafka_timestamp"),
        ("current_timestamp()", "_ingested_at"),
    ),
}


def envelope(messages: DataFrame, style: str) -> DataFrame:
    """``plain`` (binary key), ``keyed`` (text key, partition, offset) or ``offset``."""
    return messages.selectExpr(*[f"{expr} AS `{name}`" for expr, name in _STYLES[style]])


def with_parsed(df: DataFrame, schema: str, raw: str = "raw_data", out: str = "parsed_data") -> DataFrame:
    return df.withColumn(out, F.from_json(raw, schema))


def drop_headers(df: DataFrame, column: str, words: tuple[str, ...], shape: str) -> DataFrame:
    """Remove header rows that sit inside the data: known words, and anything whose first
    column does not look like data."""
    return df.filter(~F.col(column).isin(*words) & F.col(column).rlike(shape))


def stamp_silver(df: DataFrame, kind: str | None = None) -> DataFrame:
    out = df if kind is None else df.withColumn("cdr_type", F.lit(kind))
    return out.withColumn("silver_processing_time", F.current_timestamp())
