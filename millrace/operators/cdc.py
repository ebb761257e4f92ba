"""Keyed upserts and de-duplication, batch side.  Streaming side: millrace.streaming."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from millrace.operators.series import latest


def scd1(df: DataFrame, keys: Sequence[str], sequence: Sequence[str]) -> DataFrame:
    """Latest version per key.  The result does not depend on arrival order."""
    return latest(df, keys, sequence)


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key.  Map-side cut to one row per key, as in ``latest``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
