from __future__ import annotations

import datetime as dt
import json
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace.operators import quality
from millrace.operators.cdc import dedup, scd1
from millrace.operators.envelope import envelope
from millrace.operators.quality import Expectation, ExpectationError, keep_valid, require
from millrace.plans.cdr import gold, records
from millrace.sources.topics import ENVELOPE, TopicSource, read_topics, record_messages, sasl_options

T0 = 1_704_067_200  # 2024-01-01 00:00:00


def messages(spark, topic, payloads, start=0):
    rows = []
    for i, p in enumerate(payloads, start):
        body = p if p is None or isinstance(p, str) else json.dumps(p)
        rows.append((b"k", body.encode() if body is not None else None, topic, i % 3, i,
                     dt.datetime(2024, 1, 1, 0, 0) + dt.timedelta(minutes=i), 0))
    return spark.createDataFrame(rows, ENVELOPE)


VOICE = {"user_id": "u1", "callEventStartTime": T0, "callEventEndTime": T0 + 60, "callDuration": 60, "imsi": "310150123456789",
         "callReferenceNumber": "7", "recordSequenceNumber": 1, "is_anomaly": False}


def test_broken_missing_and_negative_records(spark):
    raw = envelope(messages(spark, "telco-voice-cdrs", [
        VOICE, None, "garbage", {**VOICE, "user_id": None}, {**VOICE, "callDuration": -1}, {**VOICE, "callDuration": 0},
    ]), "plain")
    assert records.renamed_unchecked(raw, "voice").count() == 5  # only the NULL payload is gone
    out = records.renamed(raw, "voice").orderBy("call_duration").collect()
    assert [r["call_duration"] for r in out] == [0, 60]
    assert str(out[1]["call_start_time"]) == "2024-01-01 00:00:00"


def test_byte_and_size_rules(spark):
    data = {"user_id": "u", "dataVolumeUplink": 1, "dataVolumeDownlink": 2}
    raw = envelope(messages(spark, "t", [data, {**data, "dataVolumeUplink": -1}, {**data, "dataVolumeDownlink": None}]), "plain")
    assert [r["total_bytes"] for r in records.renamed(raw, "data_usage").collect()] == [3]
    sms = envelope(messages(spark, "t", [{"user_id": "u", "messageSize": n} for n in (0, 1)]), "plain")
    assert [r["message_size"] for r in records.renamed(sms, "sms").collect()] == [1]


def test_user_forms_and_short_number(spark):
    flat = {"user_id": "a", "msisdn": "4860000000", "city": "X", "state": "S", "activation_date": "2023-01-01"}
    nested = {"user_id": "b", "msisdn": "4860000000", "location": {"city": "Y", "state": "S"}, "registration_date": "2023-02-01", "active": True}
    raw = messages(spark, "telco-users", [flat, nested, {**flat, "msisdn": "486000000"}])
    out = {r["user_id"]: r for r in records.renamed_users(records.raw_users_parsed(raw)).collect()}
    assert {k: v["city"] for k, v in out.items()} == {"a": "X", "b": "Y"}
    latest = {r["user_id"]: r for r in records.users(records.user_events(envelope(raw, "keyed"))).collect()}
    assert latest["b"]["city"] == "Y" and latest["b"]["activation_date"] == "2023-02-01"


def test_scd1_does_not_depend_on_order(spark):
    rows = [("u1", 1, 5, "old"), ("u1", 3, 1, "tie-low"), ("u1", 3, 2, "newest"), ("u2", 1, 9, "only")]
    for seed in range(4):
        random.Random(seed).shuffle(rows)
        out = scd1(spark.createDataFrame(rows, "user_id string, seq int, off int, v string"), ["user_id"], ["seq", "off"])
        assert {r["user_id"]: r["v"] for r in out.collect()} == {"u1": "newest", "u2": "only"}


def test_strict_form_dedups_warns_and_maps(spark):
    base = {"user_id": "u", "imsi": "310150123456789", "chargingID": "c", "recordSequenceNumber": 1, "recordOpeningTime": T0 + 86_399,
            "duration": 5, "qci": "9", "ratType": "NR", "dataVolumeUplink": 1048576, "dataVolumeDownlink": 1048576}
    raw = envelope(messages(spark, "t", [
        base, base, {**base, "recordSequenceNumber": 2, "ratType": "GAN"}, {**base, "chargingID": "d", "imsi": "31015012345678"},
        {**base, "chargingID": "e", "qci": "10"}, {**base, "chargingID": "f", "qci": "x"}, {**base, "chargingID": "g", "imsi": None},
    ]), "offset")
    out = {(r["chargingID"], r["recordSequenceNumber"]): r for r in records.strict(raw, "data_usage").collect()}
    assert set(out) == {("c", 1), ("c", 2), ("d", 1)}
    assert out["c", 1]["network_generation"] == "5G" and out["c", 2]["network_generation"] is None
    assert out["c", 1]["_kafka_offset"] == 0 and out["c", 1]["data_volume_total_mb"] == 2.0
    assert (str(out["c", 1]["event_date"]), out["c", 1]["event_hour"]) == ("2024-01-01", 23)
    counts = {r["rule"]: (r["action"], r["failed"]) for r in quality.rule_counts(
        records.strict_unchecked(raw, "data_usage"), records.strict_rules("data_usage"), "d").collect()}
    assert counts["imsi_length"] == ("warn", 2) and counts["valid_qci"] == ("drop", 2)


def test_fail_rule_and_empty_multiplex(spark):
    empty = envelope(messages(spark, "t", [VOICE]).filter("false"), "plain")
    with pytest.raises(PySparkException):
        records.multiplex_check(empty).collect()
    assert records.multiplex_check(envelope(messages(spark, "t", [VOICE]), "plain")).first()["record_count"] == 1
    with pytest.raises(ExpectationError):
        require(spark.range(3), Expectation("small", "id < 2"))


def test_null_predicate_is_a_violation(spark):
    df = spark.createDataFrame([(1,), (None,), (9,)], "x int")
    assert [r[0] for r in keep_valid(df, [Expectation("in_range", "x BETWEEN 0 AND 5")]).collect()] == [1]
    assert keep_valid(df, [Expectation("in_range", "x BETWEEN 0 AND 5", "warn")]).count() == 3


def test_observed_counts_match(spark):
    from pyspark.sql import Observation

    seen = Observation("q")
    df = spark.range(10).withColumn("x", F.col("id") % 4)
    quality.observe_rules(df, [Expectation("small", "x < 3")], seen).write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 10, "small": 2}


def test_multiplex_reads_only_named_topics(spark, tmp_path):
    both = messages(spark, "telco-voice-cdrs", [VOICE]).unionByName(messages(spark, "other", [VOICE, VOICE]))
    both.write.parquet(str(tmp_path / "m"))
    source = TopicSource(fmt="parquet", path=str(tmp_path / "m"))
    assert records.raw_multiplex(spark, source, stream=False).count() == 1
    made = records.raw_builders(spark, source, stream=False)
    assert len(made) == 9 and made["voice_cdrs"]().count() == 1 and made["sms_cdrs"]().count() == 0
    assert read_topics(spark, source, ["other"], stream=False).count() == 2


def test_broker_options():
    security = sasl_options("me", "pw", "org.example.Login")
    options = TopicSource(servers="b:9092", starting="earliest", security=security).options(["a", "b"])
    assert options["subscribe"] == "a,b" and options["startingOffsets"] == "earliest" and options["failOnDataLoss"] == "false"
    assert options["kafka.session.timeout.ms"] == "45000" and options["kafka.request.timeout.ms"] == "60000"
    assert options["kafka.security.protocol"] == "SASL_SSL" and 'username="me"' in options["kafka.sasl.jaas.config"]
    assert TopicSource().options(["a"])["startingOffsets"] == "latest"


def test_records_are_routed_by_type(spark):
    df = spark.createDataFrame([("voice", "u1", 5), ("sms", None, 6), ("nothing", "u2", 7)], "cdr_type string, user_id string, n int")
    out = {r["topic"]: r for r in record_messages(df, records.ROUTES).collect()}
    assert set(out) == {"telco-voice-cdrs", "telco-sms-cdrs"} and out["telco-sms-cdrs"]["key"] == "unknown"
    assert json.loads(out["telco-voice-cdrs"]["value"]) == {"cdr_type": "voice", "user_id": "u1", "n": 5}


def test_customer_360_zero_fills_and_ignores_unknown_users(spark):
    users = spark.createDataFrame([("u1", "1", "i", "Basic", "c", "s", "d", 5, 500, 1000), ("u2", "2", "i", "Basic", "c", "s", "d", 5, 500, 1000)],
                                  "user_id string, msisdn string, imsi string, plan_name string, city string, state string, "
                                  "activation_date string, data_limit_gb int, voice_minutes int, sms_count int")
    cdrs = {k: records.typed(envelope(messages(spark, "t", [{"user_id": "u1", "is_anomaly": True, "anomaly_type": "x", "callDuration": 90,
            "chargeAmount": 1.5, records.TIMES[k][0]: T0}, {"user_id": "ghost", records.TIMES[k][0]: T0}]), "keyed"), k) for k in records.SCHEMAS}
    out = {r["user_id"]: r for r in gold.customer_360(users, cdrs).collect()}
    assert set(out) == {"u1", "u2"}
    assert out["u1"]["voice_total_minutes"] == 1.5 and out["u1"]["total_charge_usd"] == 4.5
    assert out["u2"]["voice_call_count"] == 0 and out["u2"]["total_charge_usd"] == 0.0 and out["u2"]["voice_last_call_ts"] is None
    found = {r["user_id"]: r for r in gold.anomaly_summary(users, cdrs).collect()}
    assert found["u1"]["total_anomaly_count"] == 8 and found["u2"]["total_anomaly_count"] == 0 and found["u2"]["voice_anomaly_count"] is None
    orphans = gold.orphan_records(users, cdrs).collect()
    assert len(orphans) == 8 and all(r["orphan_records"] == 1 for r in orphans)


def test_spine_has_every_key_once(spark):
    day = {"voice": T0, "data_usage": T0 + 86_400, "sms": T0}
    cdrs = {k: records.typed(envelope(messages(spark, "t", [{"user_id": "u", records.TIMES[k][0]: t}, {"user_id": f"only-{k}", records.TIMES[k][0]: t}]), "keyed"), k)
            for k, t in day.items()}
    rows = gold.daily_cdr_summary(cdrs).collect()
    keys = [(r["user_id"], str(r["event_date"])) for r in rows]
    assert len(keys) == len(set(keys)) == 5
    both = next(r for r in rows if r["user_id"] == "u" and str(r["event_date"]) == "2024-01-01")
    assert (both["voice_calls"], both["sms_messages"], both["data_sessions"]) == (1, 1, 0)


def test_dedup_keeps_first(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("b", 5)], "k string, o int")
    assert sorted(dedup(df, ["k"], ["o"]).collect()) == [("a", 1), ("b", 5)]
