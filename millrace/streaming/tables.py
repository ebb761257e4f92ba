"""Append streams, keyed upserts, stream de-duplication, one stream into many tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from millrace.operators.cdc import dedup, scd1
from millrace.sources.tables import read_table, write_table


def append_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    trigger: str = "available",
    every: str = "1 minute",
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Append table fed by a stream: ``available`` drains what is there and stops,
    ``continuous`` keeps running in micro-batches.  Exactly once per checkpoint."""
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return _triggered(writer.option("path", path), trigger, every)


def _triggered(writer: DataStreamWriter, trigger: str, every: str) -> StreamingQuery:
    writer = writer.trigger(availableNow=True) if trigger == "available" else writer.trigger(processingTime=every)
    return writer.start()


def upsert_stream(
    df: DataFrame, keys: Sequence[str], sequence: Sequence[str], path: str, checkpoint: str,
    trigger: str = "available", every: str = "1 minute",
) -> StreamingQuery:
    """Append the latest row per key of each micro-batch, one partition per batch id.

    The cost of a batch follows the batch, not the table; a replayed batch overwrites its own
    partition.  ``current`` reads the table, ``compacted`` makes a smaller one.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        scd1(batch, keys, sequence).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return _triggered(df.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint), trigger, every)


def current(changes: DataFrame, keys: Sequence[str], sequence: Sequence[str], base: DataFrame | None = None) -> DataFrame:
    """Latest row per key of what an ``upsert_stream`` wrote.

    With ``base``, a compacted copy, only batches behind it are read (the batch id is a
    partition column).  Arrival order does not matter: winners are chosen by ``sequence``.
    """
    if base is not None:
        through = base.agg(F.max("batch_id")).first()[0]
        changes = base.unionByName(changes if through is None else changes.where(F.col("batch_id") > through))
    return scd1(changes, keys, sequence).drop("batch_id")


def compacted(changes: DataFrame, keys: Sequence[str], sequence: Sequence[str], path: str, base: DataFrame | None = None) -> DataFrame:
    """Write the latest row per key to ``path``, a new table that covers all batches in ``changes``; a plain batch job.

    Every row gets the number of the last batch covered.
    """
    through = changes.agg(F.max("batch_id")).first()[0]
    rows = current(changes, keys, sequence, base).withColumn("batch_id", F.lit(through).cast(changes.schema["batch_id"].dataType))
    write_table(rows, path)
    return read_table(changes.sparkSession, path)


def dedup_stream(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], path: str, checkpoint: str,
    trigger: str = "available", every: str = "1 minute",
) -> StreamingQuery:
    """Append the first row per key of each micro-batch, one folder per batch.

    No row is lost for being late, and no state is kept: a record delivered again within its
    micro-batch goes, one that comes in a later batch is left to ``cdc.dedup`` over the table.
    A replayed batch overwrites its folder.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        dedup(batch, keys, order).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return _triggered(df.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint), trigger, every)


def dedup_within(
    df: DataFrame, keys: Sequence[str], event_time: str, delay: str, path: str, checkpoint: str,
    trigger: str = "available", every: str = "1 minute",
) -> StreamingQuery:
    """Append the first delivery per key, also across micro-batches.

    The state holds the keys whose event time lies within ``delay`` of the latest one seen,
    so it is bounded by the rate of events, not by the age of the stream.  Rows later than
    that are not written here, be they repeats or not: ``late_rows`` finds those among them
    that never got through.
    """
    once = df.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))
    return append_stream(once, path, checkpoint, trigger, every)


def late_rows(arrived: DataFrame, kept: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows of ``arrived`` of which no delivery is among ``kept``, one per key: the side table of ``dedup_within``.

    A batch job over the append tables; give both the same days to bound it.  Keys may be
    NULL.  ``kept`` and this together hold every key once.
    """
    there = kept.select(*[F.col(k).alias(f"_k_{k}") for k in keys])
    on = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    return dedup(arrived.join(there, on, "left_anti"), keys, order)


def fan_out(
    df: DataFrame, tables: Mapping[str, Callable[[DataFrame], DataFrame]], path_of: Callable[[str], str], checkpoint: str,
    trigger: str = "available", every: str = "1 minute",
) -> StreamingQuery:
    """One stream into several tables: each names its rows of a micro-batch and their columns.

    The source is read once a micro-batch, which is held in files beside the checkpoint's own
    while its tables are written, each into a partition of the batch id; a replayed batch
    overwrites what it wrote, in all tables.  No block of the batch stays in an executor's
    memory, however large it is; the files are emptied when its tables are there.
    """
    hold = f"{checkpoint.rstrip('/')}/held"

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        try:
            write_table(batch, hold)
            held = batch.sparkSession.read.schema(batch.schema).parquet(hold)
            for name, rows in tables.items():
                rows(held).write.mode("overwrite").parquet(f"{path_of(name)}/batch_id={batch_id}")
        finally:
            write_table(batch.limit(0), hold)

    return _triggered(df.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint), trigger, every)
