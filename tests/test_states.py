"""States that merge, calendar windows, rescue by field."""

from __future__ import annotations

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from millrace.functions import sketches
from millrace.operators import series
from millrace.operators.parse import rescue_fields
from millrace.plans import jsonfiles
from millrace.plans.cdr import gold

RANKS = {"p10": 0.1, "p50": 0.5, "p90": 0.9, "p999": 0.999}


@pytest.fixture(scope="module")
def rows(spark):
    chance = random.Random(2)
    made = [(i % 3, h, chance.choice([chance.gauss(0, 5), 7.0, chance.expovariate(0.01)]) if i % 50 else None) for i in range(40_000) for h in [chance.randint(0, 23)]]
    return spark.createDataFrame(made, "day int, hour int, v double").cache()


def test_days_from_hours_are_within_the_bound(spark, rows):
    hours = sketches.quantile_states(rows, ["day", "hour"], "v")
    merged = sketches.quantiles(hours, ["day"], RANKS)
    direct = sketches.quantiles(sketches.quantile_states(rows, ["day"], "v"), ["day"], RANKS)
    want = {r["day"]: r["n"] for r in rows.where("v IS NOT NULL").groupBy("day").agg(F.count("v").alias("n")).collect()}
    for made in (merged, direct):
        for r in sketches.rank_check(made, rows, ["day"], "v", RANKS).collect():
            assert r["n"] == want[r["day"]] and all(r[f"{name}_ok"] for name in RANKS)
    values = sorted(r["v"] for r in rows.where("day = 1 AND v IS NOT NULL").collect())
    got = merged.where("day = 1").first()
    for name, p in RANKS.items():
        low, high = sum(v < got[name] for v in values) / len(values), sum(v <= got[name] for v in values) / len(values)
        assert low <= p + sketches.RANK_ERROR and high >= p - sketches.RANK_ERROR


def test_a_wrong_quantile_does_not_pass(spark, rows):
    made = spark.createDataFrame([(0, 1, 1e9, 0.0, -1e9, 0.0)], "day int, n long, p10 double, p50 double, p90 double, p999 double")
    got = sketches.rank_check(made, rows, ["day"], "v", RANKS).first()
    assert not got["p10_ok"] and not got["p90_ok"]


def test_only_rows_that_count_enter_a_state(spark, rows):
    some = sketches.quantile_states(rows, [F.lit(1).alias("one")], "v", "hour = 3 AND v > 7")
    assert some.first()["n"] == rows.where("hour = 3 AND v > 7").count()
    assert sketches.quantile_states(rows, ["day"], "v", "v IS NULL").count() == 0


def test_active_subscribers_of_a_period(spark):
    chance = random.Random(4)
    made = {k: [(None if i % 17 == 0 else f"u{chance.randint(0, 300)}", dt.datetime(2024, 1, 1) + dt.timedelta(hours=chance.randint(0, 700))) for i in range(600)] for k in ("voice", "sms")}
    tables = {
        "voice": spark.createDataFrame(made["voice"], "user_id string, callEventStartTime_ts timestamp"),
        "sms": spark.createDataFrame(made["sms"], "user_id string, eventTimestamp_ts timestamp"),
    }
    states = gold.active_states(tables)
    asked = {"v": (["voice"], []), "both": (["voice", "sms"], []), "v_not_s": (["voice"], ["sms"]), "none": (["mms"], ["sms"])}
    got = dict(gold.active_subscribers(states, "2024-01-05", "2024-01-09", asked).collect())
    sets = {k: {u for u, t in some if u and dt.date(2024, 1, 5) <= t.date() <= dt.date(2024, 1, 9)} for k, some in made.items()}
    assert got == {"v": len(sets["voice"]), "both": len(sets["voice"] & sets["sms"]), "v_not_s": len(sets["voice"] - sets["sms"]), "none": 0}


def test_distinct_counts_beyond_the_exact_size(spark):
    states = sketches.distinct_states(spark.range(400_000).withColumn("k", F.col("id") % 7), ["k"], "id")
    got = states.agg(sketches.united("k >= 0").alias("s")).select(F.expr("theta_sketch_estimate(s)")).first()[0]
    assert abs(got / 400_000 - 1) < 0.03


def test_calendar_windows_see_missing_days(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=d) for d in (0, 1, 3, 4, 9, 40, 41)]
    table = spark.createDataFrame([(k, d, float(i + k)) for k in (1, 2) for i, d in enumerate(days)], "k int, day date, v double")
    made = series.moving_avg_days(series.delta_days(table, {"v": "step"}, ["k"], "day"), {"v": "mean"}, ["k"], "day", 5)
    for r in made.collect():
        near = [i + r["k"] for i, d in enumerate(days) if 0 <= (r["day"] - d).days < 5]
        before = [i + r["k"] for i, d in enumerate(days) if (r["day"] - d).days == 1]
        assert r["mean"] == sum(near) / len(near) and r["step"] == (r["v"] - before[0] if before else None)
    full = series.every_day(table, ["k"], "day")
    assert full.count() == 2 * 42 and full.where("v IS NOT NULL").count() == 2 * len(days)


SCHEMA = "n int, amount double, name string, ok boolean, at timestamp, tags array<int>, exact decimal(6,2)"
CASES = [
    ('{"n": 1, "amount": 2.5, "name": "x", "ok": true, "at": "2024-01-02 03:04:05", "tags": [1, 2], "exact": 1.25}', {}, False),
    ('{"n": "1", "amount": "n/a", "name": "x", "surprise": {"a": [1, null]}}', {"n": "1", "amount": "n/a", "surprise": {"a": [1, None]}}, False),
    ('{"n": 1.5, "amount": 3, "ok": "true", "at": 5, "tags": ["x"]}', {"n": 1.5, "ok": "true", "at": 5, "tags": ["x"]}, False),
    ('{"n": 99999999999, "at": "no time"}', {"n": 99999999999, "at": "no time"}, False),
    ('{"n": null, "amount": null, "new": null}', {"new": None}, False),
    ('{"name": 7, "it\'s": 1}', {"it's": 1}, False),
    ("{}", {}, False), ("{broken", "{broken", True), ("[1]", "[1]", True), ('"text"', '"text"', True), (None, None, True),
]


def test_only_fields_that_do_not_fit_are_rescued(spark):
    table = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, raw string")
    got = {r["i"]: r for r in rescue_fields(table, "raw", SCHEMA, ["i"]).collect()}
    for i, (_, want, whole) in enumerate(CASES):
        rescued = got[i]["_rescued_data"]
        assert rescued == want if whole else (json.loads(rescued) if rescued else {}) == want
    assert got[0]["n"] == 1 and got[0]["tags"] == [1, 2] and str(got[0]["exact"]) == "1.25" and got[0]["at"] is not None
    assert got[1]["name"] == "x" and got[1]["n"] is None and got[2]["amount"] == 3.0 and got[5]["name"] == "7"


def test_records_by_field_as_batch_and_stream(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    good, odd = {"DOLocationID": 1, "fare_amount": 2.5}, {"DOLocationID": 1, "fare_amount": "n/a", "extra": 1}
    (folder / "a.json").write_text("\n".join(map(json.dumps, [good, odd])) + "\n\n{broken\n")
    names = ["DOLocationID", "fare_amount", "_rescued_data", "file_name"]
    batch = jsonfiles.json_records_by_field(spark, str(folder), stream=False).select(names)
    run = jsonfiles.json_records_by_field(spark, str(folder)).select(names).writeStream.format("parquet")
    run.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
    want = [(1, 2.5, None, "a.json"), (1, None, '{"fare_amount":"n/a","extra":1}', "a.json"), (None, None, "{broken", "a.json")]
    assert sorted(map(tuple, batch.collect()), key=repr) == sorted(want, key=repr)
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect()), key=repr) == sorted(want, key=repr)
    whole = folder.parent / "docs"
    whole.mkdir()
    (whole / "b.json").write_text(json.dumps(odd, indent=2))
    got = jsonfiles.json_records_by_field(spark, str(whole), stream=False, multiline=True).select(names).collect()
    assert [tuple(r) for r in got] == [(1, None, '{"fare_amount":"n/a","extra":1}', "b.json")]
