"""Subscriber summaries over call-detail records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.metrics import Metric, rnd, summarise
from millrace.functions.scalars import defaulted
from millrace.functions.sketches import distinct_states, united
from millrace.operators.rules import label_first
from millrace.operators.series import top_n
from millrace.operators.summaries import left_join_all, spine_join
from millrace.plans.cdr.records import TIMES

Tables = Mapping[str, DataFrame]

# One summary per record type; each is one row per user before any join.
PER_USER = {
    "voice": [
        Metric("voice_call_count", "count"),
        Metric("voice_total_seconds", "sum", "callDuration"),
        Metric("voice_last_call_ts", "max", "callEventStartTime_ts"),
        Metric("voice_anomaly_count", "count", when="is_anomaly"),
    ],
    "data_usage": [
        Metric("data_session_count", "count"),
        Metric("data_uplink_mb", "sum", "dataVolumeUplink_mb"),
        Metric("data_downlink_mb", "sum", "dataVolumeDownlink_mb"),
        Metric("data_last_session_ts", "max", "recordOpeningTime_ts"),
        Metric("data_anomaly_count", "count", when="is_anomaly"),
    ],
    "sms": [
        Metric("sms_tx_count", "count"),
        Metric("sms_total_charge", "sum", "chargeAmount"),
        Metric("sms_last_ts", "max", "eventTimestamp_ts"),
        Metric("sms_failed_count", "count", when="deliveryStatus = 'failed'"),
    ],
    "mms": [
        Metric("mms_count", "count"),
        Metric("mms_total_charge", "sum", "chargeAmount"),
        Metric("mms_total_size_kb", "sum", "messageSize_kb"),
    ],
    "roaming": [
        Metric("roaming_event_count", "count"),
        Metric("roaming_total_charge", "sum", "chargeAmount"),
        Metric("roaming_countries_visited", "distinct", "roamingCountry"),
        Metric("roaming_last_ts", "max", "callEventStartTime_ts"),
    ],
    "voip": [
        Metric("voip_session_count", "count"),
        Metric("voip_avg_quality", "avg", "callQualityIndicator"),
        Metric("voip_avg_packet_loss_pct", "avg", "packetLoss"),
        Metric("voip_avg_latency_ms", "avg", "latency"),
    ],
    "wifi_calling": [
        Metric("wifi_call_count", "count"),
        Metric("wifi_avg_quality", "avg", "callQuality"),
        Metric("wifi_avg_signal_dbm", "avg", "signalStrength"),
        Metric("wifi_handover_count", "count", when="handoverToCell"),
    ],
}

IDENTITY = "user_id msisdn imsi plan_name city state activation_date data_limit_gb voice_minutes sms_count".split()
COUNTS = (
    "voice_call_count voice_total_seconds data_session_count sms_failed_count mms_count roaming_event_count "
    "roaming_countries_visited voip_session_count wifi_call_count wifi_handover_count voice_anomaly_count "
    "data_anomaly_count"
).split()
AMOUNTS = "data_uplink_mb data_downlink_mb sms_total_charge mms_total_charge roaming_total_charge".split()
AS_IS = (
    "voice_last_call_ts data_last_session_ts sms_last_ts roaming_last_ts voip_avg_quality voip_avg_packet_loss_pct "
    "voip_avg_latency_ms wifi_avg_quality wifi_avg_signal_dbm"
).split()


def customer_360(users: DataFrame, cdrs: Tables) -> DataFrame:
    """One row per subscriber.  Records of unknown users do not appear."""
    parts = [summarise(cdrs[kind], ["user_id"], metrics) for kind, metrics in PER_USER.items()]
    joined = left_join_all(users.select(*IDENTITY), parts, ["user_id"])
    filled = joined.select(
        *IDENTITY,
        *[defaulted(c, 0) for c in COUNTS],
        *[defaulted(c, 0.0) for c in AMOUNTS],
        F.coalesce("sms_tx_count", F.lit(0)).alias("sms_count_actual"),
        *AS_IS,
    )
    return filled.withColumns({
        "voice_total_minutes": F.col("voice_total_seconds") / F.lit(60.0),
        "data_total_gb": (F.col("data_uplink_mb") + F.col("data_downlink_mb")) / F.lit(1024.0),
        "total_charge_usd": F.col("sms_total_charge") + F.col("mms_total_charge") + F.col("roaming_total_charge"),
    })


DAILY_PARTS = {
    "voice": [
        Metric("voice_calls", "count"),
        Metric("voice_seconds", "sum", "callDuration"),
        Metric("voice_anomalies", "count", when="is_anomaly"),
    ],
    "data_usage": [
        Metric("data_sessions", "count"),
        Metric("data_downlink_mb", "sum", "dataVolumeDownlink_mb"),
        Metric("data_uplink_mb", "sum", "dataVolumeUplink_mb"),
    ],
    "sms": [Metric("sms_messages", "count"), Metric("sms_charge", "sum", "chargeAmount")],
}


def daily_cdr_summary(cdrs: Tables) -> DataFrame:
    """One row per user and day with any voice, data or message record."""
    keys = ["user_id", "event_date"]
    parts = {
        kind: summarise(cdrs[kind].withColumn("event_date", F.to_date(f"{TIMES[kind][0]}_ts")), keys, metrics)
        for kind, metrics in DAILY_PARTS.items()
    }
    folded = spine_join(parts, keys)
    floats = {"data_downlink_mb", "data_uplink_mb", "sms_charge"}
    return folded.select(*keys, *[
        defaulted(c, 0.0 if c in floats else 0) for c in folded.columns if c not in keys
    ])


ROAMING = [
    Metric("roaming_events", "count"),
    Metric("countries_list", "set", "roamingCountry"),
    Metric("total_roaming_charge", "sum", "chargeAmount"),
    Metric("total_roaming_seconds", "sum", "callDuration"),
    Metric("avg_fraud_score", "avg", "fraudScore"),
    Metric("suspicious_events", "count", when="suspiciousActivity"),
    Metric("blocked_connections", "count", when="NOT connectionAllowed"),
    Metric("last_roaming_ts", "max", "callEventStartTime_ts"),
]


def roaming_summary(roaming: DataFrame) -> DataFrame:
    """The distinct count is the length of the distinct list, so no extra shuffle for it."""
    return summarise(roaming, ["user_id"], ROAMING).withColumn(
        "countries_visited", F.size("countries_list").cast("long")
    )


# Type name in column names, in join order.
ANOMALY_LABELS = {
    "voice": "voice", "data_usage": "data", "sms": "sms", "voip": "voip", "ims": "ims", "mms": "mms",
    "roaming": "roaming", "wifi_calling": "wifi",
}


def anomaly_summary(users: DataFrame, cdrs: Tables) -> DataFrame:
    """Anomalies per subscriber and type, with the earliest anomaly type as sample.

    All types are stacked and folded by user in one aggregation instead of eight
    aggregations and eight joins.
    """
    stacked = reduce(lambda a, b: a.unionByName(b), [
        cdrs[kind].filter("is_anomaly").select(
            "user_id", F.lit(name).alias("_kind"), F.col(f"{TIMES[kind][0]}_ts").alias("_at"), "anomaly_type",
        )
        for kind, name in ANOMALY_LABELS.items()
    ])
    cells = []
    for name in ANOMALY_LABELS.values():
        mine = F.col("_kind") == name
        at = F.when(mine & F.col("anomaly_type").isNotNull(), F.struct(F.col("_at").isNull(), "_at", "anomaly_type"))
        cells += [
            F.count_if(mine).alias(f"{name}_anomaly_count"),
            F.max(F.when(mine, F.to_date("_at"))).alias(f"{name}_last_anomaly_date"),
            F.min(at)["anomaly_type"].alias(f"{name}_anomaly_type_sample"),
        ]
    folded = stacked.groupBy("user_id").agg(*cells)
    joined = users.select("user_id", "msisdn", "plan_name").join(folded, "user_id", "left")
    counts = [f"{n}_anomaly_count" for n in ANOMALY_LABELS.values()]
    # a type without anomalies has no count, as if its own table had been left-joined
    return joined.withColumns({
        "total_anomaly_count": reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0)) for c in counts]),
        **{c: F.nullif(F.col(c), F.lit(0)) for c in counts},
    })


# -- dashboard queries ----------------------------------------------------------

def subscriber_kpis(c360: DataFrame) -> DataFrame:
    return summarise(c360, [], [
        Metric("total_subscribers", "count"),
        Metric("total_voice_calls", "sum", "voice_call_count"),
        Metric("total_data_gb", "sum", "data_total_gb", digits=1),
        Metric("total_revenue_usd", "sum", "total_charge_usd", digits=2),
    ])


def by_plan(c360: DataFrame) -> DataFrame:
    return summarise(c360, ["plan_name"], [
        Metric("subscriber_count", "count"),
        Metric("avg_voice_minutes", "avg", "voice_total_minutes", digits=1),
        Metric("plan_revenue", "sum", "total_charge_usd", digits=2),
    ])


def daily_trend(daily: DataFrame) -> DataFrame:
    return summarise(daily, ["event_date"], [
        Metric("voice_calls", "sum", "voice_calls"),
        Metric("data_sessions", "sum", "data_sessions"),
        Metric("sms_messages", "sum", "sms_messages"),
        Metric("data_downlink_gb", "sum", "data_downlink_mb / 1024D", digits=2),
    ]).orderBy("event_date")


def top_data_users(c360: DataFrame, n: int = 20) -> DataFrame:
    return top_n(c360, "data_total_gb", ["user_id"], n).select(
        "msisdn", "plan_name", "voice_call_count", rnd("data_total_gb", 3).alias("data_total_gb"), "sms_count_actual",
        rnd("total_charge_usd", 2).alias("total_charge_usd"),
    )


def top_roamers(roaming: DataFrame, n: int = 20) -> DataFrame:
    return top_n(roaming, "total_roaming_charge", ["user_id"], n).select(
        "user_id", "countries_visited", rnd("total_roaming_charge", 2).alias("total_roaming_charge"),
        "suspicious_events", "blocked_connections",
    )


def orphan_records(users: DataFrame, cdrs: Tables) -> DataFrame:
    """Records per type whose user is unknown: they are missing from every subscriber table."""
    counts = reduce(lambda a, b: a.unionByName(b), [
        df.groupBy("user_id").agg(F.count(F.lit(1)).alias("records")).withColumn("cdr_type", F.lit(kind))
        for kind, df in cdrs.items()
    ])
    unknown = counts.join(users.select("user_id"), "user_id", "left_anti")
    return summarise(unknown, ["cdr_type"], [Metric("orphan_users", "count"), Metric("orphan_records", "sum", "records")])


# -- anomaly labels ---------------------------------------------------------------

# What makes a record of a type anomalous, first match wins.
ANOMALY_CASES = {
    "voice": [
        ("failed_connection", "causeForTermination = '41' OR callDuration = 0"),
        ("dropped_call", "causeForTermination = '31'"),
        ("poor_quality", "causeForTermination = '47'"),
    ],
    "data_usage": [
        ("connection_timeout", "causeForRecordClosing = 'timeLimit' OR (dataVolumeUplink = 0 AND dataVolumeDownlink = 0)"),
        ("dropped_session", "causeForRecordClosing = 'abnormalRelease'"),
        ("abnormal_usage", "dataVolumeDownlink >= 500000000"),
    ],
    "sms": [
        ("routing_error", "deliveryStatus = 'failed' AND failureReason = 'routing_error'"),
        ("delivery_failure", "deliveryStatus = 'failed'"),
    ],
    "voip": [
        ("high_packet_loss", "packetLoss > 15"),
        ("high_jitter", "jitter > 150"),
        ("codec_failure", "sessionDuration <= 10"),
    ],
    "ims": [
        ("authentication_failure", "terminationReason = 'authentication_failed' OR sessionDuration = 0"),
        ("session_timeout", "terminationReason = 'timeout' OR sessionDuration <= 5"),
    ],
    "mms": [
        ("size_limit_exceeded", "deliveryStatus = 'failed' AND failureReason = 'message_too_large'"),
        ("delivery_failure", "deliveryStatus = 'failed'"),
    ],
    "roaming": [
        ("roaming_fraud", "suspiciousActivity OR fraudScore >= 0.7"),
        ("unauthorized_network", "roamingStatus = 'unauthorized' OR NOT connectionAllowed"),
    ],
}


def anomaly_labels(cdr: DataFrame, kind: str, out: str = "label") -> DataFrame:
    """Name the anomaly a record shows, from its own fields; NULL if it looks normal."""
    return label_first(cdr, ANOMALY_CASES[kind], out)


def type_distribution(cdrs: Tables) -> DataFrame:
    """Records and anomalies per type, with shares in percent.

    The total is the sum over a handful of type rows.
    """
    per_type = reduce(lambda a, b: a.unionByName(b), [
        df.agg(F.count(F.lit(1)).alias("records"), F.count_if("is_anomaly").alias("anomalies")).withColumn(
            "cdr_type", F.lit(kind)
        )
        for kind, df in cdrs.items()
    ])
    total = per_type.agg(F.sum("records")).scalar()
    return per_type.select(
        "cdr_type", "records", "anomalies",
        F.try_divide(F.col("records") * F.lit(100.0), total).alias("pct"),
        F.try_divide(F.col("anomalies") * F.lit(100.0), F.col("records")).alias("anomaly_pct"),
    )


def anomaly_breakdown(cdrs: Tables) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), [
        df.filter("is_anomaly")
        .groupBy(F.coalesce("anomaly_type", F.lit("unknown")).alias("anomaly_type"))
        .agg(F.count(F.lit(1)).alias("records"))
        .withColumn("cdr_type", F.lit(kind))
        for kind, df in cdrs.items()
    ])


def active_states(cdrs: Tables) -> DataFrame:
    """(day, kind, state): a mergeable state of the active subscribers per day and type of record, to be stored."""
    return reduce(lambda a, b: a.unionByName(b), [
        distinct_states(rows.filter("user_id IS NOT NULL"), [F.to_date(f"{TIMES[kind][0]}_ts").alias("day"), F.lit(kind).alias("kind")], "user_id")
        for kind, rows in cdrs.items()
    ])


def active_subscribers(states: DataFrame, first: str, last: str, asked: dict[str, tuple[Sequence[str], Sequence[str]]]) -> DataFrame:
    """(name, subscribers): how many were active from ``first`` to ``last`` in all of some types and none of others.

    Unions, intersections and differences of day states; no record is read.
    """
    kinds = sorted({k for has, lacks in asked.values() for k in (*has, *lacks)})
    period = states.filter(F.col("day").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    merged = period.agg(*[united(f"kind = '{k}'").alias(k) for k in kinds])

    def count(has: Sequence[str], lacks: Sequence[str]) -> Column:
        out = reduce(lambda a, b: f"theta_intersection({a}, {b})", has)
        return F.expr(f"theta_sketch_estimate({reduce(lambda a, b: f'theta_difference({a}, {b})', lacks, out)})")

    rows = F.array(*[F.struct(F.lit(n).alias("name"), count(*sides).alias("subscribers")) for n, sides in asked.items()])
    return merged.select(F.inline(rows))
