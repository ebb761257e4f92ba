"""Domain-shaped input derived from the supplied tables, row by row.

The tables hold no heat-pump logs, call records or JSON files, so each event (order,
line item) is re-labelled as one: every row of the table gives one row of the feed, by
plain arithmetic on its own columns.  The expressions below are valid in Spark SQL and in
DuckDB, so both engines start from the same input; everything after that is separate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.plans.heatpump.logs import LOG_COLUMNS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# -- heat pump -------------------------------------------------------------------

PUMP_BASE = (
    "SELECT event_id AS e, ts, user_id AS u, CAST(round(value * 100) AS BIGINT) AS c, CAST(hour(ts) AS BIGINT) AS hh, "
    "CAST(hour(ts) * 60 + minute(ts) AS BIGINT) AS m, CAST(day(ts) AS BIGINT) AS dd FROM events"
)
# state of the machine at that minute
PUMP_STATE = (
    "SELECT *, CASE WHEN hh % 8 = 6 THEN 20 WHEN (m - m % 40 + dd * 40) % 120 = 0 THEN 10 ELSE 30 END AS prio, "
    "CASE WHEN (m - m % 40 + dd * 40) % 120 = 0 OR c % 41 = 0 THEN 0 WHEN c % 53 = 0 THEN 5 "
    "WHEN c % 89 = 0 THEN 1310 ELSE 150 + c % 1000 END AS freq, "
    "CASE WHEN (m - m % 15 + dd * 15) % 105 = 0 THEN 120 + c % 80 ELSE -20 - c % 50 END AS evap, "
    "300 + c % 60 + hh AS supply, (dd % 10) * 20 - 150 + (hh - hh % 6) * 2 + c % 7 AS outdoor "
    f"FROM ({PUMP_BASE}) b"
)
PUMP_REGISTERS = {
    "version_raw": "9400 + dd % 2",
    "r_version_raw": "3",
    "bt1_raw": "CASE WHEN c % 97 = 0 THEN 510 ELSE outdoor END",
    "bt6_raw": "450 + m % 60 - (hh % 8) * 5",
    "bt7_raw": "430 + m % 50",
    "bt25_raw": "CASE WHEN c % 101 = 0 THEN 90 ELSE supply END",
    "bt71_raw": "supply - 20 - c % 41 - (dd % 4) * 12",
    "bt63_raw": "supply + c % 5 - 2",
    "tot_int_add_raw": "CASE WHEN c % 211 = 0 THEN 450 WHEN dd % 3 = 0 AND c % 10 = 0 THEN 300 * (1 + c % 3) ELSE 0 END",
    "alarm_number_raw": "CASE WHEN c % 67 = 0 THEN 162 WHEN (hh - hh % 3 + dd * 3) % 15 = 0 THEN 183 "
                        "WHEN (hh - hh % 3 + dd * 3) % 15 = 3 AND m % 60 < 30 THEN 271 ELSE 0 END",
    "calc_supply_raw": "310 + hh * 2",
    "degree_minutes_raw": "-1000 - (dd % 6) * 900 - c % 500",
    "bt1_average_raw": "outdoor + c % 30 - 10",
    "relays_pca_base_raw": "c % 256",
    "compr_freq_calc_raw": "20 + c % 90",
    "compr_freq_act_raw": "freq",
    "compr_state_raw": "CASE WHEN freq = 0 THEN 0 WHEN c % 3 = 0 THEN 20 ELSE 2 END",
    "compr_protection_mode_raw": "c % 2",
    "gp12_speed_raw": "CASE WHEN freq > 0 OR c % 4 = 0 THEN 30 + (c % 3) * 10 ELSE 0 END",
    "gp10_on_off_raw": "CASE WHEN freq > 0 OR c % 5 = 0 THEN 1 ELSE 0 END",
    "eb101_bt3_raw": "320 + c % 40",
    "eb101_bt12_raw": "380 + c % 50",
    "eb101_bt14_raw": "600 + c % 450",
    "eb101_bt15_raw": "340 + c % 30",
    "eb101_bt16_raw": "evap",
    "eb101_bt17_raw": "evap + c % 90 - 20 - (dd % 3) * 10",
    "eb101_bt28_raw": "outdoor + c % 20 + CASE WHEN dd % 5 = 0 THEN 40 ELSE 0 END",
    "eb101_bp4_raw": "CASE WHEN c % 149 = 0 THEN NULL ELSE 150 + c % 160 END",
    "eb101_bp4_adc_raw": "151 + c % 160",
    "saturation_temp_raw": "99",
    "sat_temp_sent_raw": "99",
    "eb101_low_pressure_raw": "40 + c % 60",
    "prio_raw": "prio",
}
# rows that are not data, as they occur in log files
PUMP_HEADER_ROW = "c % 307 = 0"
PUMP_BAD_TIME = "c % 311 = 0"
# HH:mm:ss.SSSSSS, put together from numbers
PUMP_TIME = "concat(lpad(CAST(hh AS STRING), 2, '0'), ':', lpad(CAST(m % 60 AS STRING), 2, '0'), ':', lpad(CAST(extract(SECOND FROM ts) AS STRING), 9, '0'))"


def pump_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw log rows: 35 text columns plus file lineage.  One file per day."""
    table(spark, sf_dir, "events").createOrReplaceTempView("_millrace_events")
    base = spark.sql(PUMP_STATE.replace("FROM events", "FROM _millrace_events"))
    bad_register = {"eb101_bp4_raw": "coalesce(CAST({x} AS STRING), 'ERR')"}
    cols = {
        "log_date": F.expr(f"CASE WHEN {PUMP_HEADER_ROW} THEN 'Divisors' ELSE date_format(ts, 'yyyy-MM-dd') END"),
        "log_time": F.expr(f"CASE WHEN {PUMP_BAD_TIME} THEN '99:99:99' ELSE {PUMP_TIME} END"),
    }
    for name, text in PUMP_REGISTERS.items():
        cols[name] = F.expr(bad_register.get(name, "CAST({x} AS STRING)").format(x=f"({text})"))
    return base.select(
        *[cols[c].alias(c) for c in LOG_COLUMNS],
        F.expr("concat('/logs/day-', lpad(CAST(dd AS STRING), 2, '0'), '.log')").alias("_source_file"),
        F.expr("concat('day-', lpad(CAST(dd AS STRING), 2, '0'), '.log')").alias("_source_filename"),
        F.col("ts").alias("_ingested_at"),
        F.expr("concat('d', CAST(u % 4 AS STRING))").alias("device"),
    )


PUMP_REPEATED = "xxhash64(_ingested_at) % 13 = 0 AND compr_freq_act_raw <> '1310'"  # lines that stand in a second file as well, with other values


def with_repeats(raw: DataFrame) -> DataFrame:
    """Some lines again at the same instant, from a file that comes later by name."""
    again = raw.filter(PUMP_REPEATED).withColumns({
        "_source_filename": F.concat(F.lit("zz-"), "_source_filename"), "alarm_number_raw": F.lit("162"),
        "compr_freq_act_raw": F.when(F.col("compr_freq_act_raw") == "0", "500").otherwise("0"), "prio_raw": F.lit("20"),
    })
    return raw.unionByName(again)


# -- call-detail records ------------------------------------------------------------

# e event id, c cents of the value, u user, t epoch seconds, et event type
CDR_BASE = {
    "spark": "SELECT event_id AS e, CAST(round(value * 100) AS BIGINT) AS c, user_id AS u, event_type AS et, ts, "
             "CAST(timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', ts) AS BIGINT) AS t "
             "FROM _millrace_events",
    "duckdb": "SELECT event_id AS e, CAST(round(value * 100) AS BIGINT) AS c, user_id AS u, event_type AS et, ts, "
              "CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS t FROM events",
}
CDR_BROKEN = "c % 199 = 0"  # payload is not JSON
CDR_MISSING = "c % 211 = 0"  # payload is NULL
_USER = "CASE WHEN c % 223 = 0 THEN NULL ELSE concat('u', CAST(u AS STRING)) END"
_IMSI = "CASE WHEN c % 61 = 0 THEN NULL WHEN c % 3 = 0 THEN concat('31015', CAST(100000000 + u AS STRING)) " \
        "ELSE concat('310150', CAST(100000000 + u AS STRING)) END"


def _text(x: str) -> str:
    return f"CAST({x} AS STRING)"


def _amount(x: str) -> str:
    return f"({x}) / CAST(1000 AS DOUBLE)"


def _one_of(x: str, *names: str) -> str:
    cases = " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(names))
    return f"CASE ({x}) % {len(names)} {cases} END"


def _anomaly(*names: str) -> dict[str, str]:
    return {
        "user_id": _USER,
        "is_anomaly": "et = 'error'",
        "anomaly_type": f"CASE WHEN et = 'error' THEN {_one_of('c', *names)} END",
    }


_CALL_SECONDS = "CASE WHEN c % 29 = 0 THEN -5 WHEN c % 31 = 0 THEN 0 ELSE 10 + c % 3590 END"
_SHORT_SECONDS = "CASE WHEN c % 29 = 0 THEN -5 WHEN c % 31 = 0 THEN 0 ELSE 1 + c % 1800 END"
CDR_FIELDS = {
    "voice": {
        "cdr_type": "'voice'",
        "callEventStartTime": "CASE WHEN c % 227 = 0 THEN NULL ELSE t END",
        "callEventEndTime": f"t + {_CALL_SECONDS}",
        "callDuration": _CALL_SECONDS,
        "callReferenceNumber": _text("c % 500"),
        "callingPartyNumber": _text("48600000000 + u"),
        "calledPartyNumber": _text("48700000000 + c % 1000"),
        "imsi": _IMSI,
        "mscID": _text("c % 9"),
        "causeForTermination": _one_of("c", "16", "31", "41", "47", "16", "17", "16"),
        "chargeID": _text("1 + c % 10000"),
        "callChargeableDuration": _CALL_SECONDS,
        "tariffClass": _one_of("u", "standard", "premium"),
        "recordSequenceNumber": "CASE WHEN c % 233 = 0 THEN NULL ELSE e % 7 END",
        **_anomaly("dropped_call", "failed_connection", "poor_quality"),
    },
    "data_usage": {
        "cdr_type": "'data_usage'",
        "recordOpeningTime": "t",
        "recordClosingTime": "t + 60 + c % 7000",
        "duration": "60 + c % 7000",
        "imsi": _IMSI,
        "msisdn": _text("48600000000 + u"),
        "dataVolumeUplink": "CASE WHEN c % 37 = 0 THEN -1 WHEN c % 43 = 0 THEN 0 ELSE 10240 + c * 101 END",
        "dataVolumeDownlink": "CASE WHEN c % 43 = 0 THEN 0 WHEN c % 47 = 0 THEN 600000000 ELSE 51200 + c * 1003 END",
        "apn": _one_of("e", "internet", "ims", "mms"),
        "ratType": _one_of("c", "GERAN", "UTRAN", "EUTRAN", "NR", "WLAN", "GAN", "HSPA"),
        "chargingID": _text("c % 700"),
        "qci": _text("c % 11"),
        "recordSequenceNumber": "CASE WHEN c % 233 = 0 THEN NULL ELSE e % 5 END",
        "causeForRecordClosing": _one_of("c", "normalRelease", "abnormalRelease", "timeLimit", "normalRelease",
                                         "volumeLimit"),
        **_anomaly("dropped_session", "connection_timeout", "abnormal_usage"),
    },
    "sms": {
        "cdr_type": "'sms'",
        "eventTimestamp": "t",
        "smsReferenceNumber": _text("c % 900"),
        "originatingNumber": _text("48600000000 + u"),
        "destinationNumber": _text("48700000000 + c % 1000"),
        "imsi": _IMSI,
        "messageSize": "CASE WHEN c % 41 = 0 THEN 0 ELSE 1 + c % 160 END",
        "deliveryStatus": _one_of("c", "delivered", "delivered", "failed", "pending"),
        "recordSequenceNumber": "CASE WHEN c % 233 = 0 THEN NULL ELSE e % 3 END",
        "chargeAmount": _amount("10 + c % 90"),
        "failureReason": f"CASE WHEN c % 4 = 2 THEN {_one_of('e', 'subscriber_absent', 'routing_error', 'network_error')} END",
        **_anomaly("delivery_failure", "routing_error"),
    },
    "voip": {
        "cdr_type": "'voip'",
        "sessionStartTime": "t",
        "sessionEndTime": f"t + {_SHORT_SECONDS}",
        "sessionDuration": _SHORT_SECONDS,
        "callingPartyURI": "concat('sip:', CAST(u AS STRING))",
        "codec": _one_of("c", "G711", "G729", "OPUS"),
        "callQualityIndicator": "1 + c % 5",
        "bytesTransferred": "c * 977",
        "packetLoss": _amount("c % 20000"),
        "jitter": _amount("(c * 13) % 200000"),
        "latency": _amount("10000 + (c * 17) % 490000"),
        "chargeID": _text("1 + c % 2000"),
        **_anomaly("high_packet_loss", "high_jitter", "codec_failure"),
    },
    "ims": {
        "cdr_type": "'ims'",
        "sessionStartTime": "t",
        "sessionEndTime": f"t + {_SHORT_SECONDS}",
        "sessionDuration": _SHORT_SECONDS,
        "originatingURI": "concat('sip:', CAST(u AS STRING))",
        "serviceType": _one_of("c", "VoLTE", "RCS", "ViLTE"),
        "networkType": _one_of("e", "4G", "5G"),
        "qosClass": _text("c % 9"),
        "chargeID": _text("1 + c % 2000"),
        "terminationReason": _one_of("c", "normal", "timeout", "normal", "authentication_failed", "normal"),
        **_anomaly("session_timeout", "authentication_failure"),
    },
    "mms": {
        "cdr_type": "'mms'",
        "eventTimestamp": "t",
        "mmsReferenceNumber": _text("c % 800"),
        "destinationNumber": _text("48700000000 + c % 1000"),
        "imsi": _IMSI,
        "messageSize": "10240 + c * 101",
        "contentType": _one_of("c", "image/jpeg", "video/mp4"),
        "deliveryStatus": _one_of("c", "delivered", "failed", "delivered"),
        "chargeAmount": _amount("100 + c % 400"),
        "failureReason": f"CASE WHEN c % 3 = 1 THEN {_one_of('e', 'message_too_large', 'timeout')} END",
        **_anomaly("delivery_failure", "size_limit_exceeded"),
    },
    "roaming": {
        "cdr_type": "'roaming'",
        "callEventStartTime": "t",
        "callEventEndTime": "t + 30 + c % 1770",
        "callDuration": "30 + c % 1770",
        "calledPartyNumber": _text("48700000000 + c % 1000"),
        "imsi": _IMSI,
        "roamingCountry": f"CASE WHEN c % 71 = 0 THEN NULL ELSE {_one_of('c', 'DE', 'FR', 'ES', 'IT', 'UK')} END",
        "chargeAmount": _amount("500 + c % 4500"),
        "roamingStatus": _one_of("c", "active", "active", "unauthorized", "active"),
        "suspiciousActivity": "CASE WHEN c % 5 = 0 THEN NULL ELSE c % 13 = 0 END",
        "fraudScore": _amount("(c * 7) % 1050"),
        "connectionAllowed": "CASE WHEN c % 7 = 0 THEN NULL ELSE c % 4 <> 2 END",
        **_anomaly("roaming_fraud", "unauthorized_network"),
    },
    "wifi_calling": {
        "cdr_type": "'wifi_calling'",
        "sessionStartTime": "t",
        "sessionEndTime": f"t + {_SHORT_SECONDS}",
        "sessionDuration": _SHORT_SECONDS,
        "calledPartyNumber": _text("48700000000 + c % 1000"),
        "imsi": _IMSI,
        "wifiSSID": "concat('ssid-', CAST(c % 20 AS STRING))",
        "signalStrength": "-80 + c % 51",
        "callQuality": "1 + c % 5",
        "handoverToCell": "c % 6 = 0",
        "chargeID": _text("1 + c % 2000"),
        "user_id": _USER,
        "is_anomaly": "CASE WHEN et = 'error' THEN NULL ELSE et = 'signup' END",
        "anomaly_type": "CASE WHEN et = 'signup' AND c % 2 = 0 THEN 'handover_loop' END",
    },
}

# o order key, u customer, t epoch seconds, p priority digit, st order status
USER_BASE = {
    "spark": "SELECT o_orderkey AS e, o_custkey AS u, o_orderdate AS ts, CAST(substr(o_orderpriority, 1, 1) AS INT) AS p, "
             "o_orderstatus AS st FROM _millrace_orders",
    "duckdb": "SELECT o_orderkey AS e, o_custkey AS u, o_orderdate AS ts, CAST(substr(o_orderpriority, 1, 1) AS INT) AS p, "
              "o_orderstatus AS st FROM orders",
}
USER_BROKEN = "e % 199 = 0"
_PLAN = "WHEN 1 THEN {} WHEN 2 THEN {} WHEN 3 THEN {} ELSE {}"


def _by_plan(*values) -> str:
    return f"CASE p {_PLAN.format(*values)} END"


USER_FIELDS = {
    "user_id": "CASE WHEN e % 223 = 0 THEN NULL ELSE concat('u', CAST(u AS STRING)) END",
    "msisdn": "CASE WHEN e % 61 = 0 THEN '486000000' WHEN e % 67 = 0 THEN NULL ELSE CAST(48600000000 + u AS STRING) END",
    "imsi": "CASE WHEN e % 71 = 0 THEN NULL ELSE concat('310150', CAST(100000000 + u AS STRING)) END",
    "plan_name": _by_plan("'Basic'", "'Standard'", "'Premium'", "'Unlimited'"),
    "data_limit_gb": _by_plan(5, 15, 50, 100),
    "voice_minutes": _by_plan(500, 1000, 5000, 10000),
    "sms_count": _by_plan(1000, 2000, 5000, 10000),
}
_CITY = "concat('City ', CAST((u + e) % 12 AS STRING))"
_STATE = "concat('S', CAST(u % 5 AS STRING))"
_SINCE = "concat('2023-0', CAST(1 + u % 9 AS STRING), '-01')"


def _messages(base: DataFrame, value, topic: str) -> DataFrame:
    user = F.expr("concat('u', CAST(u AS STRING))")
    return base.select(
        user.cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.expr("CAST(u % 3 AS INT)").alias("partition"),
        F.col("e").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def cdr_messages(spark: SparkSession, sf_dir: str, kind: str, topic: str) -> DataFrame:
    """One message per event: the event as a record of this type."""
    table(spark, sf_dir, "events").createOrReplaceTempView("_millrace_events")
    base = spark.sql(CDR_BASE["spark"])
    payload = F.to_json(F.struct(*[F.expr(x).alias(n) for n, x in CDR_FIELDS[kind].items()]))
    value = F.when(F.expr(CDR_BROKEN), "garbage").when(F.expr(CDR_MISSING), F.lit(None)).otherwise(payload)
    return _messages(base, value, topic)


REDELIVERED = "offset % 97 = 3"  # sent twice, the second time with another offset


def with_redeliveries(messages: DataFrame) -> DataFrame:
    """Some messages come again later, payload unchanged."""
    again = messages.filter(REDELIVERED).withColumn("offset", F.col("offset") + 1_000_000_000_000)
    return messages.unionByName(again)


def user_messages(spark: SparkSession, sf_dir: str, topic: str) -> DataFrame:
    """One message per order: the customer as it was then.  Filled orders use the nested form."""
    table(spark, sf_dir, "orders").createOrReplaceTempView("_millrace_orders")
    base = spark.sql(USER_BASE["spark"])
    same = [F.expr(x).alias(n) for n, x in USER_FIELDS.items()]
    flat = F.to_json(F.struct(
        *same, F.expr(_CITY).alias("city"), F.expr(_STATE).alias("state"), F.expr(_SINCE).alias("activation_date"),
    ))
    nested = F.to_json(F.struct(
        *same, F.struct(F.expr(_CITY).alias("city"), F.expr(_STATE).alias("state")).alias("location"),
        F.expr(_SINCE).alias("registration_date"), F.expr("e % 2 = 0").alias("active"),
    ))
    value = F.when(F.expr(USER_BROKEN), "garbage").when(F.expr("st = 'F'"), nested).otherwise(flat)
    return _messages(base, value, topic)


# -- JSON records -------------------------------------------------------------------

# one record per line item; a file per supplier
JSON_FIELDS = {
    "DOLocationID": "CASE WHEN l_linenumber = 7 AND l_quantity < 5 THEN NULL ELSE CAST(l_partkey AS INT) END",
    "PULocationID": "CASE WHEN l_linenumber = 7 AND l_quantity < 5 THEN NULL ELSE CAST(l_suppkey AS INT) END",
    "fare_amount": "CASE WHEN l_linenumber = 7 AND l_quantity < 5 THEN NULL ELSE l_extendedprice END",
    "total_amount": "CASE WHEN l_linenumber = 7 AND l_quantity < 5 THEN NULL ELSE l_extendedprice * (1 + l_tax) END",
    "_rescued_data": "CASE WHEN l_discount >= 0.1 AND l_suppkey % 4 = 1 THEN 'bad field' "
                     "WHEN l_discount >= 0.1 AND l_quantity < 6 AND l_suppkey % 4 = 2 THEN 'bad field' "
                     "WHEN l_linenumber = 2 THEN '' END",
}


def json_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(
        *[F.expr(x).alias(n) for n, x in JSON_FIELDS.items()],
        F.expr("concat('/landing/part-', CAST(l_suppkey AS STRING), '.json')").alias("source_file_name"),
        F.expr("concat('part-', CAST(l_suppkey AS STRING), '.json')").alias("file_name"),
        F.col("l_shipdate").alias("ingestion_timestamp"),
        F.lit("2024-01-01").cast("date").alias("ingestion_date"),
    )
