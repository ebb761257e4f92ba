"""Call-detail records: topics, payload schemas, raw and cleaned tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.scalars import label
from millrace.operators import cdc
from millrace.operators.envelope import envelope, stamp_silver, with_parsed
from millrace.operators.parse import KB, MB, epoch_columns, parse_json, pick_json
from millrace.operators.quality import Expectation, keep_valid
from millrace.sources.topics import TopicSource, read_topics

# Topic of each raw table.
TOPICS = {
    "telco-users": "users",
    "telco-voice-cdrs": "voice_cdrs",
    "telco-data-cdrs": "data_cdrs",
    "telco-sms-cdrs": "sms_cdrs",
    "telco-voip-cdrs": "voip_cdrs",
    "telco-ims-cdrs": "ims_cdrs",
    "telco-mms-cdrs": "mms_cdrs",
    "telco-roaming-cdrs": "roaming_cdrs",
    "telco-wifi-calling-cdrs": "wifi_calling_cdrs",
}
# Record type to topic, for writing records.
ROUTES = {
    "voice": "telco-voice-cdrs",
    "data_usage": "telco-data-cdrs",
    "sms": "telco-sms-cdrs",
    "voip": "telco-voip-cdrs",
    "ims": "telco-ims-cdrs",
    "mms": "telco-mms-cdrs",
    "roaming": "telco-roaming-cdrs",
    "wifi_calling": "telco-wifi-calling-cdrs",
}
MULTIPLEX = ("voice", "data_usage", "sms", "voip", "ims")

# Payload fields per record type.
_COMMON = "user_id string, is_anomaly boolean, anomaly_type string"
_FIELDS = {
    "voice": "cdr_type string, callEventStartTime long, callEventEndTime long, callDuration int, "
             "callReferenceNumber string, callingPartyNumber string, calledPartyNumber string, imsi string, "
             "imei string, mscID string, lac string, ci string, causeForTermination string, chargeID string, "
             "callChargeableDuration int, tariffClass string, callType string, recordSequenceNumber int",
    "data_usage": "cdr_type string, recordType int, recordOpeningTime long, recordClosingTime long, duration int, "
                  "imsi string, imei string, msisdn string, dataVolumeUplink long, dataVolumeDownlink long, "
                  "servingNodeAddress string, apn string, pdnType string, ratType string, chargingID string, "
                  "qci string, recordSequenceNumber int, sgsn_address string, causeForRecordClosing string",
    "sms": "cdr_type string, eventTimestamp long, smsReferenceNumber string, originatingNumber string, "
           "destinationNumber string, imsi string, smscAddress string, messageSize int, deliveryStatus string, "
           "messageType string, recordSequenceNumber int, chargeAmount double, failureReason string",
    "voip": "cdr_type string, sessionStartTime long, sessionEndTime long, sessionDuration int, "
            "callingPartyURI string, calledPartyURI string, codec string, callQualityIndicator int, "
            "bytesTransferred long, packetLoss double, jitter double, latency double, chargeID string",
    "ims": "cdr_type string, sessionStartTime long, sessionEndTime long, sessionDuration int, "
           "originatingURI string, destinationURI string, serviceType string, mediaTypes string, "
           "networkType string, qosClass string, chargeID string, terminationReason string",
    "mms": "cdr_type string, eventTimestamp long, mmsReferenceNumber string, originatingNumber string, "
           "destinationNumber string, imsi string, mmscAddress string, messageSize long, contentType string, "
           "deliveryStatus string, chargeAmount double, failureReason string",
    "roaming": "cdr_type string, callEventStartTime long, callEventEndTime long, callDuration int, "
               "callingPartyNumber string, calledPartyNumber string, imsi string, imei string, "
               "roamingCountry string, visitedNetwork string, mcc string, mnc string, roamingType string, "
               "serviceType string, chargeAmount double, roamingStatus string, suspiciousActivity boolean, "
               "fraudScore double, connectionAllowed boolean",
    "wifi_calling": "cdr_type string, sessionStartTime long, sessionEndTime long, sessionDuration int, "
                    "callingPartyNumber string, calledPartyNumber string, imsi string, wifiSSID string, "
                    "wifiAccessPoint string, signalStrength int, codec string, callQuality int, "
                    "handoverToCell boolean, chargeID string",
}
SCHEMAS = {kind: f"{fields}, {_COMMON}" for kind, fields in _FIELDS.items()}

# Users come in a flat and in a nested form; one schema reads both.
USER_SCHEMA = (
    "user_id string, msisdn string, imsi string, imei string, plan_name string, data_limit_gb int, "
    "voice_minutes int, sms_count int, city string, state string, activation_date string, "
    "registration_date string, active boolean, location struct<city: string, state: string>"
)

# Epoch columns of each type; the first is the time of the record.
# Start (and end) field of each type.
TIMES = {
    "voice": ("callEventStartTime", "callEventEndTime"),
    "data_usage": ("recordOpeningTime", "recordClosingTime"),
    "sms": ("eventTimestamp",),
    "voip": ("sessionStartTime", "sessionEndTime"),
    "ims": ("sessionStartTime", "sessionEndTime"),
    "mms": ("eventTimestamp",),
    "roaming": ("callEventStartTime", "callEventEndTime"),
    "wifi_calling": ("sessionStartTime", "sessionEndTime"),
}


# -- raw layer ------------------------------------------------------------------

def raw_table(spark: SparkSession, source: TopicSource, topic: str, style: str = "keyed", stream: bool = True) -> DataFrame:
    return envelope(read_topics(spark, source, [topic], stream), style)


def raw_builders(spark: SparkSession, source: TopicSource, style: str = "offset", stream: bool = True) -> dict:
    """Table name to a function that builds it, for all nine topics."""
    def builder(topic):
        return lambda: raw_table(spark, source, topic, style, stream)

    return {name: builder(topic) for topic, name in TOPICS.items()}


def raw_users_parsed(messages: DataFrame) -> DataFrame:
    return with_parsed(envelope(messages, "plain"), USER_SCHEMA)


def raw_multiplex(spark: SparkSession, source: TopicSource, stream: bool = True) -> DataFrame:
    topics = [ROUTES[k] for k in MULTIPLEX]
    return envelope(read_topics(spark, source, topics, stream), "plain")


HAS_RECORDS = Expectation("has_records", "record_count > 0", "fail")


def multiplex_check(raw: DataFrame) -> DataFrame:
    """One row; the check fails when the raw table is empty."""
    counted = raw.agg(F.count(F.lit(1)).alias("record_count")).withColumn("test_timestamp", F.current_timestamp())
    return keep_valid(counted, [HAS_RECORDS])


# -- cleaned layer, first form: chosen fields, snake case ------------------------

# Output column, expression over the payload fields.
RENAMED = {
    "data_usage": {
        "user_id": "user_id",
        "imsi": "imsi",
        "imei": "imei",
        "msisdn": "msisdn",
        "session_start_time": "timestamp_seconds(recordOpeningTime)",
        "session_end_time": "timestamp_seconds(recordClosingTime)",
        "duration_seconds": "duration",
        "data_volume_uplink": "dataVolumeUplink",
        "data_volume_downlink": "dataVolumeDownlink",
        "total_bytes": "dataVolumeUplink + dataVolumeDownlink",
        "apn": "apn",
        "serving_node_address": "servingNodeAddress",
        "pdn_type": "pdnType",
        "rat_type": "ratType",
        "qci": "qci",
    },
    "voice": {
        "user_id": "user_id",
        "imsi": "imsi",
        "imei": "imei",
        "calling_party_number": "callingPartyNumber",
        "called_party_number": "calledPartyNumber",
        "call_start_time": "timestamp_seconds(callEventStartTime)",
        "call_end_time": "timestamp_seconds(callEventEndTime)",
        "call_duration": "callDuration",
        "call_reference_number": "callReferenceNumber",
        "msc_id": "mscID",
        "lac": "lac",
        "ci": "ci",
        "cause_for_termination": "causeForTermination",
        "charge_id": "chargeID",
        "call_chargeable_duration": "callChargeableDuration",
        "tariff_class": "tariffClass",
    },
    "sms": {
        "user_id": "user_id",
        "imsi": "imsi",
        "originating_number": "originatingNumber",
        "destination_number": "destinationNumber",
        "event_timestamp": "timestamp_seconds(eventTimestamp)",
        "message_size": "messageSize",
        "sms_reference_number": "smsReferenceNumber",
        "smsc_address": "smscAddress",
        "delivery_status": "deliveryStatus",
        "charge_amount": "chargeAmount",
    },
    "voip": {
        "user_id": "user_id",
        "calling_party_uri": "callingPartyURI",
        "called_party_uri": "calledPartyURI",
        "session_start_time": "timestamp_seconds(sessionStartTime)",
        "session_end_time": "timestamp_seconds(sessionEndTime)",
        "session_duration": "sessionDuration",
        "codec": "codec",
        "call_quality_indicator": "callQualityIndicator",
        "bytes_transferred": "bytesTransferred",
        "packet_loss": "packetLoss",
        "jitter": "jitter",
        "latency": "latency",
        "charge_id": "chargeID",
    },
    "ims": {
        "user_id": "user_id",
        "service_type": "serviceType",
        "session_start_time": "timestamp_seconds(sessionStartTime)",
        "session_end_time": "timestamp_seconds(sessionEndTime)",
        "session_duration": "sessionDuration",
        "originating_uri": "originatingURI",
        "destination_uri": "destinationURI",
        "media_types": "mediaTypes",
        "network_type": "networkType",
        "qos_class": "qosClass",
        "charge_id": "chargeID",
    },
}
KIND_TAG = {"data_usage": "data"}

USER_ID = Expectation("valid_user_id", "user_id IS NOT NULL")
# Rule names and predicates.
RENAMED_RULES = {
    "users": [USER_ID, Expectation("valid_msisdn", "msisdn IS NOT NULL AND length(msisdn) >= 10")],
    "data_usage": [USER_ID, Expectation("valid_bytes", "data_volume_uplink >= 0 AND data_volume_downlink >= 0")],
    "voice": [USER_ID, Expectation("valid_duration", "call_duration >= 0")],
    "sms": [USER_ID, Expectation("valid_message_size", "message_size > 0")],
    "voip": [USER_ID, Expectation("valid_duration", "session_duration >= 0")],
    "ims": [USER_ID, Expectation("valid_duration", "session_duration >= 0")],
}


def renamed_unchecked(raw: DataFrame, kind: str) -> DataFrame:
    """``raw`` is a ``plain`` envelope table.  Map-only: batch and streaming alike."""
    picked = pick_json(raw, "raw_data", SCHEMAS[kind], RENAMED[kind], {"processing_time": "bronze_processing_time"})
    return stamp_silver(picked, KIND_TAG.get(kind, kind))


def renamed(raw: DataFrame, kind: str) -> DataFrame:
    return keep_valid(renamed_unchecked(raw, kind), RENAMED_RULES[kind])


def renamed_users(raw_parsed: DataFrame) -> DataFrame:
    """Every user event, nested location flattened (the flat form is read as well)."""
    same = "user_id msisdn imsi imei plan_name data_limit_gb voice_minutes sms_count registration_date active".split()
    picked = raw_parsed.select(
        *[F.col(f"parsed_data.{c}").alias(c) for c in same],
        F.coalesce("parsed_data.location.city", "parsed_data.city").alias("city"),
        F.coalesce("parsed_data.location.state", "parsed_data.state").alias("state"),
        F.col("processing_time").alias("bronze_processing_time"),
    )
    return keep_valid(stamp_silver(picked), RENAMED_RULES["users"])


# -- cleaned layer, second form: all fields, times and units converted -----------

def typed(raw: DataFrame, kind: str) -> DataFrame:
    """``raw`` is a ``keyed`` envelope table.  Rows without a user are left out."""
    parsed = parse_json(raw, "_raw_json", SCHEMAS[kind], ["_kafka_timestamp", "_ingested_at"])
    out = epoch_columns(parsed.filter(F.col("user_id").isNotNull()), TIMES[kind])
    if kind == "data_usage":
        out = out.withColumns({
            "dataVolumeUplink_mb": F.col("dataVolumeUplink") / F.lit(float(MB)),
            "dataVolumeDownlink_mb": F.col("dataVolumeDownlink") / F.lit(float(MB)),
        })
    if kind == "mms":
        out = out.withColumn("messageSize_kb", F.col("messageSize") / F.lit(float(KB)))
    return out


def user_events(raw: DataFrame) -> DataFrame:
    """All versions of all users, with the columns that order them."""
    parsed = parse_json(raw, "_raw_json", USER_SCHEMA, {
        "_kafka_timestamp": "_updated_at", "_offset": "_kafka_offset", "_ingested_at": "_ingested_at",
    }).filter(F.col("user_id").isNotNull())
    return fold_user(parsed)


def fold_user(parsed: DataFrame) -> DataFrame:
    """Both payload forms of a user under the flat names."""
    return parsed.withColumns({
        "city": F.coalesce("city", "location.city"),
        "state": F.coalesce("state", "location.state"),
        "activation_date": F.coalesce("activation_date", "registration_date"),
    }).drop("location")


USER_SEQUENCE = ("_updated_at", "_kafka_offset")


def users(events: DataFrame, sequence: Sequence[str] = USER_SEQUENCE) -> DataFrame:
    """One row per user: the latest version."""
    return cdc.scd1(events, ["user_id"], list(sequence))


# -- cleaned layer, third form: dates, derived columns, de-duplicated ------------

# Business key of each type.
BUSINESS_KEYS = {
    "voice": "callReferenceNumber",
    "data_usage": "chargingID",
    "sms": "smsReferenceNumber",
    "voip": "chargeID",
    "ims": "chargeID",
    "mms": "mmsReferenceNumber",
    "roaming": "calledPartyNumber",
    "wifi_calling": "chargeID",
}


def record_key(kind: str) -> list[str]:
    """What only a redelivery repeats: subscriber, start, business key, sequence number.

    Reference numbers come round again, so they are no key alone.  Where a record has no
    sequence number the digest of its payload stands for it.
    """
    schema = SCHEMAS[kind]
    key = [c for c in ("user_id", "imsi") if f" {c} string" in f" {schema}"]
    key += [f"{TIMES[kind][0]}_ts", BUSINESS_KEYS[kind]]
    return key + ["recordSequenceNumber"] * ("recordSequenceNumber" in schema) + ["_payload"]


DURATIONS = {
    "voice": "callDuration", "data_usage": "duration", "voip": "sessionDuration", "ims": "sessionDuration",
    "roaming": "callDuration", "wifi_calling": "sessionDuration",
}
# Access technology to network generation.
GENERATIONS = {"GERAN": "2G", "UTRAN": "3G", "EUTRAN": "4G", "NR": "5G", "WLAN": "WiFi"}


def strict_rules(kind: str) -> list[Expectation]:
    """Row rules of the third form; the IMSI length only warns."""
    rules = [USER_ID, Expectation("valid_time", f"{TIMES[kind][0]}_ts IS NOT NULL")]
    if " imsi string" in SCHEMAS[kind]:
        rules += [
            Expectation("valid_imsi", "imsi IS NOT NULL"),
            Expectation("imsi_length", "length(imsi) = 15", "warn"),
        ]
    if kind != "roaming":
        rules.append(Expectation(f"valid_{BUSINESS_KEYS[kind]}", f"{BUSINESS_KEYS[kind]} IS NOT NULL"))
    if kind in DURATIONS:
        rules.append(Expectation("valid_duration", f"{DURATIONS[kind]} >= 0"))
    if kind == "data_usage":
        rules.append(Expectation("valid_qci", "try_cast(qci AS int) BETWEEN 1 AND 9"))
    if kind == "roaming":
        rules.append(Expectation("valid_fraud_score", "fraudScore BETWEEN 0 AND 1"))
    return rules


def strict_unchecked(raw: DataFrame, kind: str, *keep: str) -> DataFrame:
    """``raw`` is an ``offset`` envelope table.  Map-only: batch and streaming alike."""
    parsed = parse_json(raw, "raw_data", SCHEMAS[kind], ["_kafka_offset", "_kafka_timestamp", "_ingested_at", *keep])
    out = epoch_columns(parsed, TIMES[kind])
    time = F.col(f"{TIMES[kind][0]}_ts")
    out = out.withColumns({
        "event_date": F.to_date(time), "event_hour": F.hour(time), "_updated_at": F.current_timestamp(),
    })
    if kind == "data_usage":
        out = out.withColumns({
            "data_volume_total_mb": (F.col("dataVolumeUplink") + F.col("dataVolumeDownlink")) / F.lit(float(MB)),
            "network_generation": label("ratType", GENERATIONS),
        })
    return out


def strict_valid(raw: DataFrame, kind: str) -> DataFrame:
    """Checked records with the columns of ``record_key``."""
    valid = keep_valid(strict_unchecked(raw, kind, "raw_data"), strict_rules(kind))
    payload = F.sha2("raw_data", 256)
    if "recordSequenceNumber" in SCHEMAS[kind]:
        payload = F.when(F.col("recordSequenceNumber").isNull(), payload)
    return valid.withColumn("_payload", payload).drop("raw_data")


def strict(raw: DataFrame, kind: str) -> DataFrame:
    """Checked records; of several deliveries of one record the earliest stays.  Batch."""
    return cdc.dedup(strict_valid(raw, kind), record_key(kind), ["_kafka_offset"]).drop("_payload")


STRICT_USER_RULES = [
    USER_ID, Expectation("valid_imsi", "imsi IS NOT NULL"), Expectation("imsi_length", "length(imsi) = 15", "warn"),
]


def strict_users(raw: DataFrame) -> DataFrame:
    """Latest valid version per user by message offset, nested location folded.

    Offsets order messages inside one partition; the key is the user, so all versions of a
    user share a partition.
    """
    parsed = parse_json(raw, "raw_data", USER_SCHEMA, ["_kafka_offset", "_ingested_at"])
    valid = keep_valid(fold_user(parsed), STRICT_USER_RULES).withColumn("_updated_at", F.current_timestamp())
    return cdc.scd1(valid, ["user_id"], ["_kafka_offset"])
