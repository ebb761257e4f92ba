"""Registered queries that run as streams and must equal their batch form.

Each call drains what the staged message tables hold (``availableNow``) into a new folder
under the shared directory and returns the resulting table.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from millrace.operators import quality
from millrace.operators.envelope import envelope
from millrace.plans.cdr import records
from millrace.plans.heatpump import logs
from millrace.sources.tables import Layout, read_table
from millrace.sources.topics import TopicSource, read_topics
from millrace.streaming.counts import RuleCounts, stored_counts
from millrace.streaming.tables import append_stream, compacted, current, dedup_stream, dedup_within, fan_out, late_rows, upsert_stream
from millrace.suite import feeds
from millrace.suite.oracle import ORACLE
from millrace.suite.queries import KINDS, _add, _filled, delivered, messages, pump_raw, query, user_messages
from millrace.suite.staging import stage_root, staged


def _layout(spark, sf_dir) -> Layout:
    return Layout(f"{stage_root(spark, sf_dir)}/streams/{uuid.uuid4().hex}")


def _topic(spark, sf_dir, topic: str, kind: str, table: str = "messages"):
    """The staged messages of one topic as a stream, in Kafka's columns."""
    rows = {"messages": messages, "delivered": delivered}[table]
    staged(spark, sf_dir, f"{table}_{kind}", lambda: user_messages(spark, sf_dir) if kind == "users" else rows(spark, sf_dir, kind))
    source = TopicSource(fmt="parquet", path=f"{stage_root(spark, sf_dir)}/{table}_{kind}")
    return read_topics(spark, source, [topic])


BATCHES, FILE_ROWS = 6, 200_000


def files_a_batch(rows: int, batches: int = BATCHES, file_rows: int = FILE_ROWS) -> int:
    """Files of one micro-batch, so that ``batches`` of them hold ``rows`` messages in files of at most about ``file_rows``."""
    return max(1, -(-rows // (batches * file_rows)))


def _size(spark, sf_dir, kind: str) -> int:
    return feeds.table(spark, sf_dir, "orders" if kind == "users" else "events").count()


def arrivals(spark, sf_dir, kind: str):
    """Messages in files as they arrive: delivered twice in part, in no order of time; the files grow in number, not in size."""
    rows = user_messages(spark, sf_dir) if kind == "users" else delivered(spark, sf_dir, kind)
    files = BATCHES * files_a_batch(_size(spark, sf_dir, kind))
    mixed = lambda: rows.repartition(files, F.xxhash64("offset", "timestamp", "value"))
    return staged(spark, sf_dir, f"arrivals_{kind}", mixed)


def _arriving(spark, sf_dir, topic: str, kind: str):
    per_batch = files_a_batch(_size(spark, sf_dir, kind))
    return read_topics(spark, TopicSource(fmt="parquet", path=f"{stage_root(spark, sf_dir)}/arrivals_{kind}", per_batch=per_batch), [topic])


@query
def stream_renamed_voice(spark, sf_dir):
    """Two chained streams: messages to raw table, raw table to checked table."""
    lay = _layout(spark, sf_dir)
    raw, clean = lay.path("bronze", "voice"), lay.path("silver", "voice")
    stream = envelope(_topic(spark, sf_dir, "telco-voice-cdrs", "voice"), "plain")
    append_stream(stream, raw, lay.checkpoint("bronze_voice")).awaitTermination()
    from_raw = read_table(spark, raw, stream=True, schema=stream.schema)
    append_stream(records.renamed(from_raw, "voice"), clean, lay.checkpoint("silver_voice")).awaitTermination()
    return read_table(spark, clean).drop("bronze_processing_time", "silver_processing_time")


@query
def stream_samples(spark, sf_dir):
    """Raw log rows to samples, map-only, appended by day."""
    lay = _layout(spark, sf_dir)
    raw = pump_raw(spark, sf_dir)
    stream = read_table(spark, f"{stage_root(spark, sf_dir)}/raw_logs", stream=True, schema=raw.schema)
    out = lay.path("silver", "samples")
    append_stream(logs.samples(stream), out, lay.checkpoint("samples"), partition_by=["log_date_parsed"]).awaitTermination()
    return read_table(spark, out).select(*logs.SAMPLE_COLUMNS)


@query
def stream_users(spark, sf_dir):
    """Keyed latest state from a stream of user events: half of the batches compacted, the others behind it."""
    lay = _layout(spark, sf_dir)
    arrivals(spark, sf_dir, "users")
    stream = records.user_events(envelope(_arriving(spark, sf_dir, "telco-users", "users"), "keyed"))
    keys, out = (["user_id"], records.USER_SEQUENCE), lay.path("silver", "users")
    upsert_stream(stream, *keys, out, lay.checkpoint("users")).awaitTermination()
    changes = read_table(spark, out)
    base = compacted(changes.where(f"batch_id < {BATCHES // 2}"), *keys, lay.path("silver", "users_base"))
    return current(changes, *keys, base).drop("_ingested_at", "imei", "registration_date", "active")


@query
def stream_dedup_sms(spark, sf_dir):
    """Redeliveries removed per micro-batch (here all that is there), whole rows."""
    lay = _layout(spark, sf_dir)
    stream = envelope(_topic(spark, sf_dir, "telco-sms-cdrs", "sms", "delivered"), "offset")
    out = lay.path("silver", "sms")
    valid = records.strict_valid(stream, "sms")
    dedup_stream(valid, records.record_key("sms"), ["_kafka_offset"], out, lay.checkpoint("sms")).awaitTermination()
    return _filled(read_table(spark, out).drop("batch_id", "_payload"), "sms")


@query
def stream_typed_roaming(spark, sf_dir):
    lay = _layout(spark, sf_dir)
    stream = envelope(_topic(spark, sf_dir, "telco-roaming-cdrs", "roaming"), "keyed")
    out = lay.path("silver", "roaming")
    append_stream(records.typed(stream, "roaming"), out, lay.checkpoint("roaming")).awaitTermination()
    return _filled(read_table(spark, out), "roaming")


@query
def stream_counts_by_topic(spark, sf_dir):
    """Messages per topic and partition in the appended raw table."""
    lay = _layout(spark, sf_dir)
    out = lay.path("bronze", "data")
    stream = envelope(_topic(spark, sf_dir, "telco-data-cdrs", "data_usage"), "keyed")
    append_stream(stream, out, lay.checkpoint("data"), partition_by=["_topic"]).awaitTermination()
    return read_table(spark, out).groupBy("_topic", "_partition").agg(
        F.count(F.lit(1)).alias("messages"), F.max("_offset").alias("last_offset")
    )


@query
def stream_dedup_late(spark, sf_dir):
    """Redeliveries removed across micro-batches, and the rows that came later than the watermark."""
    lay = _layout(spark, sf_dir)
    arrivals(spark, sf_dir, "sms")
    valid = records.strict_valid(envelope(_arriving(spark, sf_dir, "telco-sms-cdrs", "sms"), "offset"), "sms")
    key, out = records.record_key("sms"), lay.path("silver", "sms_once")
    dedup_within(valid, key, "eventTimestamp_ts", "12 hours", out, lay.checkpoint("sms_once")).awaitTermination()
    arrived = records.strict_valid(envelope(arrivals(spark, sf_dir, "sms"), "offset"), "sms")
    kept = read_table(spark, out)
    both = kept.unionByName(late_rows(arrived, kept, key, ["_kafka_offset"]))
    # which of several deliveries comes first follows from the batches: what is a delivery's own is left out
    return _filled(both.drop("_payload", "_kafka_offset", "_kafka_timestamp"), "sms")


def _routed(spark, sf_dir):
    """All kinds of records by one subscription, each into its own typed table; once per application."""
    root = f"{stage_root(spark, sf_dir)}/fan_out"
    if root not in _fanned:
        topics = [records.ROUTES[k] for k in KINDS]
        per_batch = files_a_batch(len(KINDS) * _size(spark, sf_dir, "events"))
        everything = f"{stage_root(spark, sf_dir)}/messages_all"
        stacked = lambda: reduce(DataFrame.unionByName, [messages(spark, sf_dir, k) for k in KINDS])
        staged(spark, sf_dir, "messages_all", lambda: stacked().repartition(BATCHES * per_batch, F.xxhash64("offset", "topic")))
        stream = envelope(read_topics(spark, TopicSource(fmt="parquet", path=everything, per_batch=2 * per_batch), topics), "keyed")
        tables = {k: lambda batch, _k=k: records.typed(batch.where(F.col("_topic") == records.ROUTES[_k]), _k) for k in KINDS}
        fan_out(stream, tables, lambda name: f"{root}/{name}", f"{root}/_checkpoint").awaitTermination()
        _fanned.add(root)
    return root


_fanned: set[str] = set()
for _kind in KINDS:
    _add(f"fan_out_{_kind}", lambda s, d, _k=_kind: _filled(read_table(s, f"{_routed(s, d)}/{_k}").drop("batch_id"), _k))
    ORACLE[f"fan_out_{_kind}"] = ORACLE[f"typed_{_kind}"]


@query
def stream_rule_counts(spark, sf_dir):
    """Rules counted while the stream runs, stored by a listener, summed over its batches."""
    lay = _layout(spark, sf_dir)
    raw = envelope(_topic(spark, sf_dir, "telco-data-cdrs", "data_usage"), "plain")
    rules = {"data": records.RENAMED_RULES["data_usage"]}
    counts = lay.path("quality", "rule_counts")
    listener = RuleCounts(spark, counts, rules).start()
    try:
        watched = quality.observe_rules(records.renamed_unchecked(raw, "data_usage"), rules["data"], "data")
        run = append_stream(quality.keep_valid(watched, rules["data"]), lay.path("silver", "data"), lay.checkpoint("data"))
        run.awaitTermination()
        listener.ended(run.runId)
    finally:
        listener.stop()
    return stored_counts(spark, counts, rules)


ORACLE["stream_rule_counts"] = ORACLE["renamed_rule_counts"]
_once = ORACLE["strict_sms"]
ORACLE["stream_dedup_late"] = f"SELECT * EXCLUDE (_kafka_offset, _kafka_timestamp) FROM ({_once}) o"
