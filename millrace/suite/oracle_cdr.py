"""Comparison SQL for call-detail records: straight from the events, no JSON in between."""

from __future__ import annotations

from millrace.suite import feeds
from millrace.suite.sqltext import avg, fin, r

CDR_ORACLE: dict[str, str] = {}

TIME = {
    "voice": "callEventStartTime", "data_usage": "recordOpeningTime", "sms": "eventTimestamp", "voip": "sessionStartTime",
    "ims": "sessionStartTime", "mms": "eventTimestamp", "roaming": "callEventStartTime", "wifi_calling": "sessionStartTime",
}
END = {
    "voice": "callEventEndTime", "data_usage": "recordClosingTime", "voip": "sessionEndTime", "ims": "sessionEndTime",
    "roaming": "callEventEndTime", "wifi_calling": "sessionEndTime",
}
TOPIC = {
    "voice": "telco-voice-cdrs", "data_usage": "telco-data-cdrs", "sms": "telco-sms-cdrs", "voip": "telco-voip-cdrs",
    "ims": "telco-ims-cdrs", "mms": "telco-mms-cdrs", "roaming": "telco-roaming-cdrs", "wifi_calling": "telco-wifi-calling-cdrs",
}
INTS = {
    "callDuration", "callChargeableDuration", "recordSequenceNumber", "duration", "dataVolumeUplink", "dataVolumeDownlink",
    "messageSize", "sessionDuration", "callQualityIndicator", "bytesTransferred", "signalStrength", "callQuality",
}
DOUBLES = {"chargeAmount", "packetLoss", "jitter", "latency", "fraudScore"}
B = feeds.CDR_BASE["duckdb"]
PARSES = f"NOT ({feeds.CDR_BROKEN}) AND NOT ({feeds.CDR_MISSING})"


def payload(kind: str, name: str) -> str:
    """CTE with the fields of all records that parse; offset, message time, key kept."""
    fields = ", ".join(f"{x} AS {n}" for n, x in feeds.CDR_FIELDS[kind].items())
    return f"{name} AS (SELECT {fields}, e AS _offset, ts AS _kafka_timestamp FROM ({B}) b WHERE {PARSES})"


def stamp(column: str) -> str:
    return f"make_timestamp({column} * 1000000)"


def typed(kind: str, name: str) -> str:
    times = [TIME[kind], *([END[kind]] if kind in END else [])]
    more = ", ".join(f"{stamp(t)} AS {t}_ts" for t in times)
    if kind == "data_usage":
        more += ", dataVolumeUplink / 1048576 AS dataVolumeUplink_mb, dataVolumeDownlink / 1048576 AS dataVolumeDownlink_mb"
    if kind == "mms":
        more += ", messageSize / 1024 AS messageSize_kb"
    return f"{payload(kind, name + '_p')}, {name} AS (SELECT *, {more} FROM {name}_p WHERE user_id IS NOT NULL)"


def columns(kind: str) -> dict:
    out: dict = {"i": [], "d": [], "s": [], "ts": []}
    for c in feeds.CDR_FIELDS[kind]:
        if c in (TIME[kind], END.get(kind)):
            out["ts"].append(f"{c}_ts")
        else:
            out["i" if c in INTS else "d" if c in DOUBLES else "s"].append(c)
    if kind == "data_usage":
        out["d"] += ["dataVolumeUplink_mb", "dataVolumeDownlink_mb"]
    if kind == "mms":
        out["d"].append("messageSize_kb")
    return out


# -- raw ---------------------------------------------------------------------------------

_shape = f"CASE WHEN {feeds.CDR_BROKEN} THEN 'broken' WHEN {feeds.CDR_MISSING} THEN 'missing' ELSE 'json' END"
_key = "concat('u', CAST(u AS STRING))"


def _plain(kind: str) -> str:
    return f"SELECT {_key} AS key, ts AS timestamp, '{TOPIC[kind]}' AS topic, {_shape} AS raw_data FROM ({B}) b"


CDR_ORACLE["raw_plain"] = fin(_plain("voice"), s=["key", "topic", "raw_data"], ts=["timestamp"])
CDR_ORACLE["raw_keyed"] = fin(
    f"SELECT {_key} AS _kafka_key, {_shape} AS _raw_json, 'telco-data-cdrs' AS _topic, u % 3 AS _partition, e AS _offset, ts AS _kafka_timestamp FROM ({B}) b",
    s=["_kafka_key", "_raw_json", "_topic"], i=["_partition", "_offset"], ts=["_kafka_timestamp"],
)
CDR_ORACLE["raw_offset"] = fin(
    f"SELECT {_shape} AS raw_data, 'telco-sms-cdrs' AS _topic, u % 3 AS _kafka_partition, e AS _kafka_offset, ts AS _kafka_timestamp FROM ({B}) b",
    s=["raw_data", "_topic"], i=["_kafka_partition", "_kafka_offset"], ts=["_kafka_timestamp"],
)
_multiplexed = ["voice", "data_usage", "sms", "voip", "ims"]
CDR_ORACLE["raw_multiplex"] = fin(" UNION ALL ".join(_plain(k) for k in _multiplexed), s=["key", "topic", "raw_data"], ts=["timestamp"])
CDR_ORACLE["multiplex_check"] = f"SELECT CAST(count(*) * {len(_multiplexed)} AS BIGINT) AS record_count FROM events"

# -- renamed -----------------------------------------------------------------------------

_renamed = {
    "voice": ("call_duration >= 0", dict(
        s="user_id imsi calling_party_number:callingPartyNumber called_party_number:calledPartyNumber call_reference_number:callReferenceNumber "
          "msc_id:mscID cause_for_termination:causeForTermination charge_id:chargeID tariff_class:tariffClass imei:NULL lac:NULL ci:NULL",
        i="call_duration:callDuration call_chargeable_duration:callChargeableDuration",
        ts="call_start_time:callEventStartTime call_end_time:callEventEndTime", tag="voice")),
    "data_usage": ("data_volume_uplink >= 0 AND data_volume_downlink >= 0", dict(
        s="user_id imsi msisdn apn rat_type:ratType qci imei:NULL serving_node_address:NULL pdn_type:NULL",
        i="duration_seconds:duration data_volume_uplink:dataVolumeUplink data_volume_downlink:dataVolumeDownlink "
          "total_bytes:dataVolumeUplink+dataVolumeDownlink",
        ts="session_start_time:recordOpeningTime session_end_time:recordClosingTime", tag="data")),
    "sms": ("message_size > 0", dict(
        s="user_id imsi originating_number:originatingNumber destination_number:destinationNumber sms_reference_number:smsReferenceNumber "
          "delivery_status:deliveryStatus smsc_address:NULL",
        i="message_size:messageSize", d="charge_amount:chargeAmount", ts="event_timestamp:eventTimestamp", tag="sms")),
    "voip": ("session_duration >= 0", dict(
        s="user_id calling_party_uri:callingPartyURI codec charge_id:chargeID called_party_uri:NULL",
        i="session_duration:sessionDuration call_quality_indicator:callQualityIndicator bytes_transferred:bytesTransferred",
        d="packet_loss:packetLoss jitter latency", ts="session_start_time:sessionStartTime session_end_time:sessionEndTime", tag="voip")),
    "ims": ("session_duration >= 0", dict(
        s="user_id service_type:serviceType originating_uri:originatingURI network_type:networkType qos_class:qosClass charge_id:chargeID "
          "destination_uri:NULL media_types:NULL",
        i="session_duration:sessionDuration", ts="session_start_time:sessionStartTime session_end_time:sessionEndTime", tag="ims")),
}


def _renames(spec: str) -> list[tuple[str, str]]:
    return [(p.split(":")[0], p.split(":")[-1]) for p in spec.split()]


for _kind, (_rule, _spec) in _renamed.items():
    _plain_cols = [f"{x} AS {n}" for k in ("s", "i", "d") for n, x in _renames(_spec.get(k, ""))]
    _time_cols = [f"{stamp(x)} AS {n}" for n, x in _renames(_spec["ts"])]
    CDR_ORACLE[f"renamed_{_kind}"] = fin(
        f"WITH {payload(_kind, 'p')}, q AS (SELECT {', '.join(_plain_cols + _time_cols)}, '{_spec['tag']}' AS cdr_type FROM p) "
        f"SELECT * FROM q WHERE user_id IS NOT NULL AND {_rule}",
        s=[*[n for n, _ in _renames(_spec["s"])], "cdr_type"], i=[n for n, _ in _renames(_spec["i"])],
        d=[n for n, _ in _renames(_spec.get("d", ""))], ts=[n for n, _ in _renames(_spec["ts"])],
    )
# broken text still gives a row (of NULLs) to the rules, a missing payload does not
CDR_ORACLE["renamed_rule_counts"] = (
    f"WITH {payload('data_usage', 'p')}, b AS (SELECT count(*) AS n FROM ({B}) z WHERE {feeds.CDR_BROKEN}) "
    "SELECT 'data' AS dataset, 'valid_user_id' AS rule, 'drop' AS action, count(user_id) AS passed, count(*) - count(user_id) + (SELECT n FROM b) AS failed FROM p "
    "UNION ALL SELECT 'data', 'valid_bytes', 'drop', count(*) FILTER (WHERE dataVolumeUplink >= 0 AND dataVolumeDownlink >= 0), "
    "count(*) FILTER (WHERE NOT (dataVolumeUplink >= 0 AND dataVolumeDownlink >= 0)) + (SELECT n FROM b) FROM p"
)

# -- users --------------------------------------------------------------------------------

_uf = ", ".join(f"{x} AS {n}" for n, x in feeds.USER_FIELDS.items())
USERS_ALL = (
    f"ua AS (SELECT {_uf}, {feeds._CITY} AS city, {feeds._STATE} AS state, {feeds._SINCE} AS since, st, e, ts FROM ({feeds.USER_BASE['duckdb']}) b "
    f"WHERE NOT ({feeds.USER_BROKEN}))"
)
USERS = (
    f"{USERS_ALL}, users AS (SELECT *, since AS activation_date FROM ua WHERE user_id IS NOT NULL "
    "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, e DESC) = 1)"
)
_plan_i = ["data_limit_gb", "voice_minutes", "sms_count"]
CDR_ORACLE["users_latest"] = fin(
    f"WITH {USERS} SELECT *, ts AS _updated_at, e AS _kafka_offset FROM users", i=[*_plan_i, "_kafka_offset"],
    s=["user_id", "msisdn", "imsi", "plan_name", "city", "state", "activation_date"], ts=["_updated_at"],
)
CDR_ORACLE["strict_users"] = fin(
    f"WITH {USERS_ALL} SELECT *, since AS activation_date, e AS _kafka_offset FROM ua WHERE user_id IS NOT NULL AND imsi IS NOT NULL "
    "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY e DESC) = 1",
    i=["data_limit_gb", "voice_minutes", "sms_count", "_kafka_offset"],
    s=["user_id", "msisdn", "imsi", "plan_name", "city", "state", "activation_date"],
)
CDR_ORACLE["renamed_users"] = fin(
    f"WITH {USERS_ALL} SELECT *, CASE WHEN st = 'F' THEN since END AS registration_date, CASE WHEN st = 'F' THEN e % 2 = 0 END AS active FROM ua "
    "WHERE user_id IS NOT NULL AND length(msisdn) >= 10",
    i=_plan_i, s=["user_id", "msisdn", "imsi", "plan_name", "registration_date", "active", "city", "state"],
)
CDR_ORACLE["raw_users_parsed"] = (
    f"SELECT concat('u', CAST(u AS STRING)) AS key, 'telco-users' AS topic, CASE WHEN NOT ({feeds.USER_BROKEN}) THEN {feeds.USER_FIELDS['user_id']} END AS user_id, "
    f"CASE WHEN NOT ({feeds.USER_BROKEN}) AND st = 'F' THEN {feeds._CITY} END AS nested_city, "
    f"CASE WHEN NOT ({feeds.USER_BROKEN}) AND st <> 'F' THEN {feeds._CITY} END AS flat_city FROM ({feeds.USER_BASE['duckdb']}) b"
)

# -- typed and strict -----------------------------------------------------------------------

for _kind in TIME:
    _cols = columns(_kind)
    CDR_ORACLE[f"typed_{_kind}"] = fin(f"WITH {typed(_kind, 'q')} SELECT * FROM q", **{**_cols, "ts": [*_cols["ts"], "_kafka_timestamp"]})

_strict = {
    "voice": "imsi IS NOT NULL AND callReferenceNumber IS NOT NULL AND callDuration >= 0",
    "data_usage": "imsi IS NOT NULL AND chargingID IS NOT NULL AND duration >= 0 AND CAST(qci AS INT) BETWEEN 1 AND 9",
    "sms": "imsi IS NOT NULL AND smsReferenceNumber IS NOT NULL", "voip": "chargeID IS NOT NULL AND sessionDuration >= 0",
    "ims": "chargeID IS NOT NULL AND sessionDuration >= 0", "mms": "imsi IS NOT NULL AND mmsReferenceNumber IS NOT NULL",
    "roaming": "imsi IS NOT NULL AND callDuration >= 0 AND fraudScore BETWEEN 0 AND 1",
    "wifi_calling": "imsi IS NOT NULL AND chargeID IS NOT NULL AND sessionDuration >= 0",
}
for _kind in TIME:
    _cols = columns(_kind)
    _cols["d"] = [c for c in _cols["d"] if not c.endswith(("_mb", "_kb"))]
    _more = f", CAST({TIME[_kind]}_ts AS DATE) AS event_date, hour({TIME[_kind]}_ts) AS event_hour, _offset AS _kafka_offset"
    if _kind == "data_usage":
        _more += (
            ", (dataVolumeUplink + dataVolumeDownlink) / 1048576 AS data_volume_total_mb, CASE ratType WHEN 'GERAN' THEN '2G' WHEN 'UTRAN' THEN '3G' "
            "WHEN 'EUTRAN' THEN '4G' WHEN 'NR' THEN '5G' WHEN 'WLAN' THEN 'WiFi' END AS network_generation"
        )
        _cols["d"].append("data_volume_total_mb")
        _cols["s"].append("network_generation")
    CDR_ORACLE[f"strict_{_kind}"] = fin(
        f"WITH {typed(_kind, 'q')}, v AS (SELECT *{_more} FROM q WHERE {TIME[_kind]} IS NOT NULL AND {_strict[_kind]}) "
        "SELECT * FROM v",  # every event is one record: what is delivered again adds none
        **{**_cols, "i": [*_cols["i"], "event_hour", "_kafka_offset"], "ts": [*_cols["ts"], "_kafka_timestamp"], "day": ["event_date"]},
    )
# every message, parsed or not, reaches the rules here; what does not parse fails them all
_roaming_rules = [
    ("valid_user_id", "drop", "user_id IS NOT NULL"), ("valid_time", "drop", "callEventStartTime IS NOT NULL"),
    ("valid_imsi", "drop", "imsi IS NOT NULL"), ("imsi_length", "warn", "length(imsi) = 15"), ("valid_duration", "drop", "callDuration >= 0"),
    ("valid_fraud_score", "drop", "fraudScore BETWEEN 0 AND 1"),
]
CDR_ORACLE["strict_rule_counts"] = f"WITH {payload('roaming', 'p')} " + " UNION ALL ".join(
    f"SELECT 'roaming' AS dataset, '{n}' AS rule, '{a}' AS action, count(*) FILTER (WHERE {p}) AS passed, "
    f"(SELECT count(*) FROM events) - count(*) FILTER (WHERE {p}) AS failed FROM p" for n, a, p in _roaming_rules
)

# -- gold -------------------------------------------------------------------------------------

ALL = ", ".join(typed(k, k) for k in TIME)
_c360 = (
    "c360 AS (SELECT u.user_id, u.msisdn, u.imsi, u.plan_name, u.city, u.state, u.activation_date, u.data_limit_gb, u.voice_minutes, u.sms_count, "
    "coalesce(v.n, 0) AS voice_call_count, coalesce(v.secs, 0) AS voice_total_seconds, coalesce(v.secs, 0) / 60 AS voice_total_minutes, v.last AS voice_last_call_ts, "
    "coalesce(d.n, 0) AS data_session_count, coalesce(d.up, 0) AS data_uplink_mb, coalesce(d.down, 0) AS data_downlink_mb, "
    "(coalesce(d.up, 0) + coalesce(d.down, 0)) / 1024 AS data_total_gb, d.last AS data_last_session_ts, "
    "coalesce(s.n, 0) AS sms_count_actual, coalesce(s.charge, 0) AS sms_total_charge, coalesce(s.failed, 0) AS sms_failed_count, s.last AS sms_last_ts, "
    "coalesce(m.n, 0) AS mms_count, coalesce(m.charge, 0) AS mms_total_charge, coalesce(r.n, 0) AS roaming_event_count, coalesce(r.charge, 0) AS roaming_total_charge, "
    "coalesce(r.countries, 0) AS roaming_countries_visited, r.last AS roaming_last_ts, coalesce(p.n, 0) AS voip_session_count, p.q AS voip_avg_quality, "
    "p.loss AS voip_avg_packet_loss_pct, p.lat AS voip_avg_latency_ms, coalesce(w.n, 0) AS wifi_call_count, w.q AS wifi_avg_quality, w.sig AS wifi_avg_signal_dbm, "
    "coalesce(w.ho, 0) AS wifi_handover_count, coalesce(s.charge, 0) + coalesce(m.charge, 0) + coalesce(r.charge, 0) AS total_charge_usd, "
    "coalesce(v.bad, 0) AS voice_anomaly_count, coalesce(d.bad, 0) AS data_anomaly_count FROM users u "
    "LEFT JOIN (SELECT user_id, count(*) n, sum(callDuration) secs, max(callEventStartTime_ts) \"last\", count(*) FILTER (WHERE is_anomaly) bad FROM voice GROUP BY 1) v ON v.user_id = u.user_id "
    "LEFT JOIN (SELECT user_id, count(*) n, sum(dataVolumeUplink_mb) up, sum(dataVolumeDownlink_mb) down, max(recordOpeningTime_ts) \"last\", "
    "count(*) FILTER (WHERE is_anomaly) bad FROM data_usage GROUP BY 1) d ON d.user_id = u.user_id "
    "LEFT JOIN (SELECT user_id, count(*) n, sum(chargeAmount) charge, max(eventTimestamp_ts) \"last\", count(*) FILTER (WHERE deliveryStatus = 'failed') failed FROM sms GROUP BY 1) s ON s.user_id = u.user_id "
    "LEFT JOIN (SELECT user_id, count(*) n, sum(chargeAmount) charge FROM mms GROUP BY 1) m ON m.user_id = u.user_id "
    "LEFT JOIN (SELECT user_id, count(*) n, sum(chargeAmount) charge, count(DISTINCT roamingCountry) countries, max(callEventStartTime_ts) \"last\" FROM roaming GROUP BY 1) r ON r.user_id = u.user_id "
    "LEFT JOIN (SELECT user_id, count(*) n, avg(callQualityIndicator) q, avg(packetLoss) loss, avg(latency) lat FROM voip GROUP BY 1) p ON p.user_id = u.user_id "
    "LEFT JOIN (SELECT user_id, count(*) n, avg(callQuality) q, avg(signalStrength) sig, count(*) FILTER (WHERE handoverToCell) ho FROM wifi_calling GROUP BY 1) w ON w.user_id = u.user_id)"
)
C360 = f"WITH {USERS}, {ALL}, {_c360}"
CDR_ORACLE["customer_360"] = fin(
    f"{C360} SELECT * FROM c360",
    i=[*_plan_i, *("voice_call_count voice_total_seconds data_session_count sms_count_actual sms_failed_count mms_count roaming_event_count roaming_countries_visited "
       "voip_session_count wifi_call_count wifi_handover_count voice_anomaly_count data_anomaly_count").split()],
    d="voice_total_minutes data_uplink_mb data_downlink_mb data_total_gb sms_total_charge mms_total_charge roaming_total_charge voip_avg_quality "
      "voip_avg_packet_loss_pct voip_avg_latency_ms wifi_avg_quality wifi_avg_signal_dbm total_charge_usd".split(),
    s=["user_id", "msisdn", "imsi", "plan_name", "city", "state", "activation_date"],
    ts=["voice_last_call_ts", "data_last_session_ts", "sms_last_ts", "roaming_last_ts"],
)
_daily = (
    "v AS (SELECT user_id, CAST(callEventStartTime_ts AS DATE) AS event_date, count(*) AS voice_calls, sum(callDuration) AS voice_seconds, "
    "count(*) FILTER (WHERE is_anomaly) AS voice_anomalies FROM voice GROUP BY 1, 2), "
    "d AS (SELECT user_id, CAST(recordOpeningTime_ts AS DATE) AS event_date, count(*) AS data_sessions, sum(dataVolumeDownlink_mb) AS data_downlink_mb, "
    "sum(dataVolumeUplink_mb) AS data_uplink_mb FROM data_usage GROUP BY 1, 2), "
    "s AS (SELECT user_id, CAST(eventTimestamp_ts AS DATE) AS event_date, count(*) AS sms_messages, sum(chargeAmount) AS sms_charge FROM sms GROUP BY 1, 2), "
    "k AS (SELECT user_id, event_date FROM v UNION SELECT user_id, event_date FROM d UNION SELECT user_id, event_date FROM s), "
    "days AS (SELECT k.*, coalesce(voice_calls, 0) AS voice_calls, coalesce(voice_seconds, 0) AS voice_seconds, coalesce(voice_anomalies, 0) AS voice_anomalies, "
    "coalesce(data_sessions, 0) AS data_sessions, coalesce(data_downlink_mb, 0) AS data_downlink_mb, coalesce(data_uplink_mb, 0) AS data_uplink_mb, "
    "coalesce(sms_messages, 0) AS sms_messages, coalesce(sms_charge, 0) AS sms_charge FROM k "
    + " ".join(f"LEFT JOIN {t} ON {t}.user_id = k.user_id AND {t}.event_date IS NOT DISTINCT FROM k.event_date" for t in "vds") + ")"
)
DAILY = f"WITH {ALL}, {_daily}"
CDR_ORACLE["daily_cdr_summary"] = fin(
    f"{DAILY} SELECT * FROM days", i=["voice_calls", "voice_seconds", "voice_anomalies", "data_sessions", "sms_messages"],
    d=["data_downlink_mb", "data_uplink_mb", "sms_charge"], s=["user_id"], day=["event_date"],
)
_roam = (
    "ro AS (SELECT user_id, count(*) AS roaming_events, count(DISTINCT roamingCountry) AS countries_visited, "
    "coalesce(array_to_string(list_sort(list(DISTINCT roamingCountry) FILTER (WHERE roamingCountry IS NOT NULL)), ','), '') AS countries_list, "
    "sum(chargeAmount) AS total_roaming_charge, sum(callDuration) AS total_roaming_seconds, avg(fraudScore) AS avg_fraud_score, "
    "count(*) FILTER (WHERE suspiciousActivity) AS suspicious_events, count(*) FILTER (WHERE connectionAllowed = false) AS blocked_connections, "
    "max(callEventStartTime_ts) AS last_roaming_ts FROM roaming GROUP BY 1)"
)
ROAM = f"WITH {typed('roaming', 'roaming')}, {_roam}"
CDR_ORACLE["roaming_summary"] = fin(
    f"{ROAM} SELECT * FROM ro", i=["roaming_events", "countries_visited", "total_roaming_seconds", "suspicious_events", "blocked_connections"],
    d=["total_roaming_charge", "avg_fraud_score"], s=["user_id", "countries_list"], ts=["last_roaming_ts"],
)
_labels = {"voice": "voice", "data_usage": "data", "sms": "sms", "voip": "voip", "ims": "ims", "mms": "mms", "roaming": "roaming", "wifi_calling": "wifi"}
_anom = ", ".join(
    f"{n}_a AS (SELECT user_id, count(*) AS {n}_anomaly_count, max(CAST({TIME[k]}_ts AS DATE)) AS {n}_last_anomaly_date, "
    f"arg_min(anomaly_type, ({TIME[k]}_ts, anomaly_type)) FILTER (WHERE anomaly_type IS NOT NULL) AS {n}_anomaly_type_sample FROM {k} WHERE is_anomaly GROUP BY 1)"
    for k, n in _labels.items()
)
CDR_ORACLE["anomaly_summary"] = fin(
    f"WITH {USERS}, {ALL}, {_anom} SELECT users.user_id, users.msisdn, users.plan_name, {_labels['voice']}_a.* EXCLUDE (user_id), "
    + ", ".join(f"{n}_a.* EXCLUDE (user_id)" for n in list(_labels.values())[1:])
    + ", " + " + ".join(f"coalesce({n}_anomaly_count, 0)" for n in _labels.values()) + " AS total_anomaly_count FROM users "
    + " ".join(f"LEFT JOIN {n}_a ON {n}_a.user_id = users.user_id" for n in _labels.values()),
    i=[*[f"{n}_anomaly_count" for n in _labels.values()], "total_anomaly_count"],
    s=["user_id", "msisdn", "plan_name", *[f"{n}_anomaly_type_sample" for n in _labels.values()]],
    day=[f"{n}_last_anomaly_date" for n in _labels.values()],
)

# -- dashboard ----------------------------------------------------------------------------------

CDR_ORACLE["subscriber_kpis"] = fin(
    f"{C360} SELECT count(*) AS total_subscribers, sum(voice_call_count) AS total_voice_calls, {r('sum(data_total_gb)', 1)} AS total_data_gb, "
    f"{r('sum(total_charge_usd)', 2)} AS total_revenue_usd FROM c360",
    i=["total_subscribers", "total_voice_calls"], d=["total_data_gb", "total_revenue_usd"],
)
CDR_ORACLE["by_plan"] = fin(
    f"{C360} SELECT plan_name, count(*) AS subscriber_count, {avg('voice_total_minutes')} AS avg_voice_minutes, {r('sum(total_charge_usd)', 2)} AS plan_revenue FROM c360 GROUP BY 1",
    i=["subscriber_count"], d=["avg_voice_minutes", "plan_revenue"], s=["plan_name"],
)
CDR_ORACLE["cdr_daily_trend"] = fin(
    f"{DAILY} SELECT event_date, sum(voice_calls) AS voice_calls, sum(data_sessions) AS data_sessions, sum(sms_messages) AS sms_messages, "
    f"{r('sum(data_downlink_mb) / 1024', 2)} AS data_downlink_gb FROM days GROUP BY 1",
    i=["voice_calls", "data_sessions", "sms_messages"], d=["data_downlink_gb"], day=["event_date"],
)
CDR_ORACLE["top_data_users"] = fin(
    f"{C360} SELECT msisdn, plan_name, voice_call_count, {r('data_total_gb', 3)} AS data_total_gb, sms_count_actual, {r('total_charge_usd', 2)} AS total_charge_usd "
    "FROM c360 ORDER BY c360.data_total_gb DESC, user_id LIMIT 20",
    i=["voice_call_count", "sms_count_actual"], d=["data_total_gb", "total_charge_usd"], s=["msisdn", "plan_name"],
)
CDR_ORACLE["top_roamers"] = fin(
    f"{ROAM} SELECT user_id, countries_visited, {r('total_roaming_charge', 2)} AS total_roaming_charge, suspicious_events, blocked_connections FROM ro "
    "ORDER BY ro.total_roaming_charge DESC, user_id LIMIT 20",
    i=["countries_visited", "suspicious_events", "blocked_connections"], d=["total_roaming_charge"], s=["user_id"],
)
CDR_ORACLE["orphan_records"] = fin(
    f"WITH {USERS}, {ALL}, o AS (" + " UNION ALL ".join(f"SELECT '{k}' AS cdr_type, user_id FROM {k}" for k in TIME)
    + ") SELECT cdr_type, count(DISTINCT user_id) AS orphan_users, count(*) AS orphan_records FROM o WHERE user_id NOT IN (SELECT user_id FROM users) GROUP BY 1",
    i=["orphan_users", "orphan_records"], s=["cdr_type"],
)
_counts = " UNION ALL ".join(f"SELECT '{k}' AS cdr_type, count(*) AS records, count(*) FILTER (WHERE is_anomaly) AS anomalies FROM {k}" for k in TIME)
CDR_ORACLE["type_distribution"] = fin(
    f"WITH {ALL}, n AS ({_counts}) SELECT *, records * 100.0 / sum(records) OVER () AS pct, anomalies * 100.0 / records AS anomaly_pct FROM n",
    i=["records", "anomalies"], d=["pct", "anomaly_pct"], s=["cdr_type"],
)
CDR_ORACLE["anomaly_breakdown"] = f"WITH {ALL} " + " UNION ALL ".join(
    f"SELECT '{k}' AS cdr_type, coalesce(anomaly_type, 'unknown') AS anomaly_type, count(*) AS records FROM {k} WHERE is_anomaly GROUP BY 2" for k in TIME
)
_cases = {
    "voice": "CASE WHEN causeForTermination = '41' OR callDuration = 0 THEN 'failed_connection' WHEN causeForTermination = '31' THEN 'dropped_call' "
             "WHEN causeForTermination = '47' THEN 'poor_quality' END",
    "data_usage": "CASE WHEN causeForRecordClosing = 'timeLimit' OR (dataVolumeUplink = 0 AND dataVolumeDownlink = 0) THEN 'connection_timeout' "
                  "WHEN causeForRecordClosing = 'abnormalRelease' THEN 'dropped_session' WHEN dataVolumeDownlink >= 500000000 THEN 'abnormal_usage' END",
    "sms": "CASE WHEN deliveryStatus = 'failed' THEN CASE WHEN failureReason = 'routing_error' THEN 'routing_error' ELSE 'delivery_failure' END END",
    "voip": "CASE WHEN packetLoss > 15 THEN 'high_packet_loss' WHEN jitter > 150 THEN 'high_jitter' WHEN sessionDuration <= 10 THEN 'codec_failure' END",
    "ims": "CASE WHEN terminationReason = 'authentication_failed' OR sessionDuration = 0 THEN 'authentication_failure' "
           "WHEN terminationReason = 'timeout' OR sessionDuration <= 5 THEN 'session_timeout' END",
    "mms": "CASE WHEN deliveryStatus = 'failed' THEN CASE WHEN failureReason = 'message_too_large' THEN 'size_limit_exceeded' ELSE 'delivery_failure' END END",
    "roaming": "CASE WHEN suspiciousActivity OR fraudScore >= 0.7 THEN 'roaming_fraud' WHEN roamingStatus = 'unauthorized' OR connectionAllowed = false THEN 'unauthorized_network' END",
}
CDR_ORACLE["anomaly_labels"] = f"WITH {ALL} " + " UNION ALL ".join(
    f"SELECT '{k}' AS cdr_type, {x} AS label, count(*) AS records FROM {k} GROUP BY 2" for k, x in _cases.items()
)
CDR_ORACLE["record_routing"] = fin(
    f"WITH {typed('voip', 'q')} SELECT user_id AS key, 'telco-voip-cdrs' AS topic, cdr_type, chargeID, sessionDuration FROM q",
    i=["sessionDuration"], s=["key", "topic", "cdr_type", "chargeID"],
)

# -- active subscribers: exact sets (the states are exact at these sizes) -----------------------------
_active = ", ".join(
    f"{k}_u AS (SELECT DISTINCT user_id FROM {k} WHERE CAST({TIME[k]}_ts AS DATE) BETWEEN DATE '2024-01-03' AND DATE '2024-01-20')"
    for k in ("voice", "data_usage", "sms", "roaming", "mms")
)
CDR_ORACLE["active_subscribers"] = (
    f"WITH {', '.join(typed(k, k) for k in ('voice', 'data_usage', 'sms', 'roaming', 'mms'))}, {_active} "
    "SELECT 'voice' AS name, count(*) AS subscribers FROM voice_u UNION ALL "
    "SELECT 'voice_not_data', count(*) FROM voice_u ANTI JOIN data_usage_u USING (user_id) UNION ALL "
    "SELECT 'voice_and_sms', count(*) FROM voice_u SEMI JOIN sms_u USING (user_id) UNION ALL "
    "SELECT 'roaming_not_mms', count(*) FROM roaming_u ANTI JOIN mms_u USING (user_id)"
)
