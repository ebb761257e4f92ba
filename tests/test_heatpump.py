from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

import heatpump_fixture as fx
from millrace.operators.quality import rule_counts
from millrace.plans.heatpump import gold, logs, tools
from millrace.sources.files import read_lines


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("logs")
    fx.write_day(path, "a.log", fx.day_one())
    fx.write_day(path, "b.log", fx.day_two())
    return str(path)


@pytest.fixture(scope="module")
def raw(spark, folder):
    return logs.raw_logs(spark, folder, stream=False).cache()


@pytest.fixture(scope="module")
def samples(raw):
    return logs.samples(raw).cache()


def test_headers_and_file_lineage(raw):
    assert raw.filter("log_date IN ('Divisors', 'Date')").count() == 0
    assert {r[0] for r in raw.select("_source_filename").distinct().collect()} == {"a.log", "b.log"}


def test_text_lines_with_file_metadata(spark, folder):
    lines = read_lines(spark, folder, stream=False)
    assert lines.filter("raw_line LIKE 'Divisors%'").count() == 2
    assert lines.filter("_source_modified_at IS NULL").count() == 0


def test_rules_drop_what_they_should(raw, samples):
    counts = {r["rule"]: r["failed"] for r in rule_counts(logs.parse_logs(raw), logs.SAMPLE_RULES, "s").collect()}
    # the short row has no registers at all, so it also fails the range rules
    assert counts == {"valid_timestamp": 1, "valid_outdoor_temp": 2, "valid_supply_temp": 3, "valid_freq": 3}
    assert samples.filter("logged_at >= '2024-01-10 04:00:00' AND logged_at < '2024-01-10 05:00:00'").count() == 1


def test_sample_columns_and_units(samples):
    assert samples.columns == logs.SAMPLE_COLUMNS and len(logs.SAMPLE_COLUMNS) == 49
    row = samples.filter("logged_at = '2024-01-10 00:00:00'").first()
    assert (row["compr_freq_act_hz"], row["delta_t_k"], row["superheat_k"], row["bt1_outdoor_temp_c"]) == (60.0, 4.0, 5.0, -5.0)
    assert row["lp_raw"] == 55 and row["mode_name"] == "HEATING" and row["heater_stage"] == "OFF"
    stages = samples.filter("priority_mode = 20").orderBy("logged_at").select("heater_stage").collect()
    assert [r[0] for r in stages] == ["OFF", "3kW", "6kW", "9kW", "UNKNOWN"]


def test_daily_summary(samples):
    rows = {str(r["log_date"]): r for r in gold.daily_summary(samples).collect()}
    one = rows["2024-01-10"]
    # starts: row one of the day, after 50 s, after 350 s, hot water, before midnight
    assert one["compr_starts"] == 5 and one["short_cycle_count"] == 1
    assert one["defrost_cycles"] == 2 and one["defrost_samples"] == 6
    assert one["alarm_codes"] == [183, 271] and one["alarm_samples"] == 6
    assert one["total_samples"] == samples.filter("log_date_parsed = '2024-01-10'").count()
    assert one["compr_running_hours"] <= one["total_hours"] <= 24
    assert one["neg_superheat_pct"] == 0.0 and one["standby_circ_pump_pct"] is None
    assert rows["2024-01-11"]["compr_starts"] == 1


def test_alarm_episodes_change_without_pause(samples):
    rows = gold.alarm_episodes(samples).orderBy("start_time").collect()
    assert [(r["alarm_number"], r["episode_id"], r["samples"]) for r in rows] == [(183, 1, 3), (271, 2, 2), (183, 3, 1)]
    assert rows[2]["duration_min"] == 0.1  # five-second floor
    known = {r["alarm_number"]: r["severity"] for r in gold.explain_alarms(gold.alarm_episodes(samples)).collect()}
    assert known == {183: "INFO", 271: "WARNING"}


def test_defrost_and_hot_water(samples):
    assert [r["samples"] for r in gold.defrost_cycles(samples).orderBy("start_time").collect()] == [4, 2]
    (dhw,) = gold.dhw_cycles(samples).collect()
    assert (dhw["bt6_start_c"], dhw["bt6_end_c"], dhw["bt7_start_c"], dhw["bt7_end_c"]) == (44.0, 44.4, 40.0, 40.8)
    assert dhw["heater_duty_pct"] == 80.0 and dhw["samples"] == 5


def test_cycles_cut_at_midnight_and_numbered_globally(samples):
    rows = gold.cycles(samples).orderBy("start_time").collect()
    # five samples and the five-sample hot-water run are counted but not listed
    assert [(r["cycle_id"], str(r["log_date"]), r["samples"]) for r in rows] == [
        (1, "2024-01-10", 12), (2, "2024-01-10", 6), (5, "2024-01-10", 6), (6, "2024-01-11", 8),
    ]
    summary = {str(r["log_date"]): r for r in gold.cycle_summary(gold.cycles(samples)).collect()}
    assert summary["2024-01-10"]["total_cycles"] == 3 and summary["2024-01-10"]["short_cycle_pct"] == 100.0


def test_data_quality_gaps(samples):
    two = {str(r["log_date"]): r for r in gold.data_quality(samples).collect()}["2024-01-11"]
    assert (two["max_gap_seconds"], two["gaps_over_60s"], two["gaps_over_600s"]) == (596, 2, 0)
    assert two["coverage_pct"] == 0.1 and two["null_hp"] == 0


def test_frequency_bands_and_curve_threshold(spark, tmp_path):
    lines, t = [], dt.datetime(2024, 2, 1)
    for hz in (5, 399, 400, 700, 1000):
        lines.append(fx.line(t, compr_freq_act_raw=hz))
        t += dt.timedelta(seconds=5)
    for bt1, n in ((0, 20), (20, 21)):
        for _ in range(n):
            lines.append(fx.line(t, compr_freq_act_raw=500, bt1_raw=bt1))
            t += dt.timedelta(seconds=5)
    fx.write_day(tmp_path, "c.log", lines)
    s = logs.samples(logs.raw_logs(spark, str(tmp_path), stream=False))
    bands = {r["freq_band"]: r["samples"] for r in gold.flow_quality(s).collect()}
    assert bands == {None: 1, "01_low_1-39Hz": 1, "02_mid_40-69Hz": 42, "03_high_70-99Hz": 1, "04_max_100+Hz": 1}
    assert [r["bt1_rounded_c"] for r in gold.heating_curve(s).collect()] == [2.0]


def features(spark, **over):
    base = dict(
        log_date=dt.date(2024, 1, 1), delta_t_avg_k=4.0, neg_superheat_pct=0.0, heater_duty_pct=0.0, outdoor_avg_c=0.0, dm_min=-100.0,
        alarm_excl_183_pct=0.0, discharge_max_c=80.0, bt1_bt28_max_divergence_k=1.0, short_cycle_pct=0.0, coverage_pct=99.0,
    )
    row = {**base, **over}
    schema = ", ".join(f"{k} {'date' if k == 'log_date' else 'double'}" for k in row)
    return gold.anomaly_rules(spark.createDataFrame([tuple(row.values())], schema)).first()


@pytest.mark.parametrize("column,value,status,want,points", [
    ("delta_t_avg_k", 5.0, "flow_status", "OK", 0), ("delta_t_avg_k", 5.1, "flow_status", "WARNING", 15),
    ("delta_t_avg_k", 7.0, "flow_status", "WARNING", 15), ("delta_t_avg_k", 7.1, "flow_status", "CRITICAL", 30),
    ("neg_superheat_pct", 5.0, "superheat_status", "OK", 0), ("neg_superheat_pct", 5.1, "superheat_status", "MONITOR", 0),
    ("neg_superheat_pct", 15.1, "superheat_status", "WARNING", 10), ("neg_superheat_pct", 30.1, "superheat_status", "CRITICAL", 25),
    ("dm_min", -400.0, "demand_status", "OK", 0), ("dm_min", -520.0, "demand_status", "WARNING", 5),
    ("dm_min", -521.0, "demand_status", "CRITICAL", 15), ("coverage_pct", 79.9, "data_quality_status", "WARNING", 0),
    ("short_cycle_pct", 21.0, "cycling_status", "WARNING", 5), ("heater_duty_pct", None, "heater_status", "OK", 0),
    ("heater_duty_pct", 0.1, "heater_status", "WARNING", 10), ("heater_duty_pct", 10.1, "heater_status", "CRITICAL", 20),
])
def test_rule_edges(spark, column, value, status, want, points):
    row = features(spark, **{column: value})
    assert (row[status], row["anomaly_score"]) == (want, points)
    assert row["raised"] == ([status] if want != "OK" else [])


def test_overall_ignores_some_statuses_and_names_the_first_reason(spark):
    assert features(spark, coverage_pct=10.0)["overall_status"] == gold.OVERALL_OK
    worst = features(spark, delta_t_avg_k=7.5, dm_min=-600.0)
    assert worst["overall_status"] == "🔴 CRITICAL" and worst["top_issue"] == "Critical flow restriction — ΔT 7.5K at high load"


def test_moving_average_counts_rows_not_days(spark):
    days = [dt.date(2024, 1, d) for d in (1, 2, 3, 4, 5, 6, 8, 9)]  # the 7th is missing
    df = spark.createDataFrame([(d, float(i)) for i, d in enumerate(days)], "log_date date, x double")
    got = gold.series.moving_avg(df, {"x": "m"}, [], "log_date", 7).orderBy("log_date").collect()
    assert got[-1]["m"] == 4.0 and got[0]["m"] == 0.0


def test_tool_json_and_sql_functions(spark, samples):
    tables = {
        "daily_summary": gold.daily_summary(samples), "flow_quality": gold.flow_quality(samples),
        "data_quality": gold.data_quality(samples), "alarm_episodes": gold.alarm_episodes(samples),
        "defrost_cycles": gold.defrost_cycles(samples), "dhw_cycles": gold.dhw_cycles(samples),
        "cycles": gold.cycles(samples), "hourly_detail": gold.hourly_detail(samples),
    }
    tables["heating_curve"] = gold.heating_curve(samples, more_than=1)
    tables["cycle_summary"] = gold.cycle_summary(tables["cycles"])
    tables["ml_features"] = gold.ml_features(*[tables[n] for n in ("daily_summary", "flow_quality", "heating_curve", "cycle_summary", "data_quality")])
    tables["anomaly_rules"] = gold.anomaly_rules(tables["ml_features"])
    episodes = json.loads(tools.tool_json("get_alarm_episodes", tables, as_of="2024-01-12", lookback_days=7).first()[0])
    assert [e["alarm_number"] for e in episodes] == [183, 271, 183]
    heater = json.loads(tools.tool_json("get_heater_analysis", tables, as_of="2024-01-12", lookback_days=7).first()[0])
    assert [d["log_date"] for d in heater["daily"]] == ["2024-01-10", "2024-01-11"] and isinstance(heater["by_outdoor_temp"], list)
    worst = json.loads(tools.tool_json("get_worst_cycles", tables, target_date="2024-01-10", top_n=2).first()[0])
    assert len(worst) == 2 and worst[0]["problem_score"] >= worst[1]["problem_score"]
    assert json.loads(tools.tool_json("get_daily_summary", tables, as_of="2025-01-01").first()[0]) == []
    made = tools.register_tools(spark, tables, "2024-01-12")
    assert sorted(made) == sorted(tools.TOOL_NAMES) and len(made) == 14
    assert {r["name"] for r in tools.known_tools(spark).collect()} == set(made)
    periods = ("2024-01-10", "2024-01-10"), ("2024-01-10", "2024-01-11")
    calls = {
        "get_hourly_detail": ("'2024-01-10'", dict(target_date="2024-01-10")),
        "get_worst_cycles": ("'2024-01-10', 2", dict(target_date="2024-01-10", top_n=2)),
        "get_period_comparison": ("'2024-01-10', '2024-01-10', '2024-01-10', '2024-01-11'", dict(p1=periods[0], p2=periods[1])),
    }
    for name in made:
        args, named = calls.get(name, ("7", dict(as_of="2024-01-12", lookback_days=7)))
        by_sql = json.loads(spark.sql(f"SELECT {name}({args})").first()[0])
        by_frame = json.loads(tools.tool_json(name, tables, **named).first()[0])
        if name == "get_period_comparison":
            by_frame = [{k: v for k, v in row.items() if k != "comparable_weather"} for row in by_frame]
        assert by_sql == by_frame, name


def test_devices_are_kept_apart(samples):
    both = samples.withColumn("device", F.lit("x")).unionByName(samples.withColumn("device", F.lit("y")))
    one = gold.cycles(samples).drop("device").collect()
    two = gold.cycles(both, ("device",)).filter("device = 'y'").collect()
    assert sorted((r["cycle_id"], r["samples"]) for r in one) == sorted((r["cycle_id"], r["samples"]) for r in two)


def test_log_stream_equals_batch(spark, folder, raw, tmp_path):
    from millrace.streaming.tables import append_stream

    stream = logs.raw_logs(spark, folder, stream=True)
    append_stream(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).drop("_ingested_at")
    assert got.exceptAll(raw.drop("_ingested_at")).count() == 0 and got.count() == raw.count()
