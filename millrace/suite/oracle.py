"""The same results in plain SQL for an independent engine (DuckDB).

Written from the meaning of each table, not from the Spark code: one window per day or no
window partition at all, one join per part, and so on.  ``fin`` brings values into the
comparable form the registered queries use.
"""

from __future__ import annotations

from millrace.suite import feeds
from millrace.suite.oracle_cdr import CDR_ORACLE
from millrace.suite.sqltext import avg, fin, mn, mx, pct, r

AS_OF, DAY = "2024-01-21", "2024-01-15"
ORACLE: dict[str, str] = dict(CDR_ORACLE)

# -- heat pump -----------------------------------------------------------------------------

_registers = ", ".join(f"{x} AS {n}" for n, x in feeds.PUMP_REGISTERS.items())
RAW = f"raw AS (SELECT *, {_registers} FROM ({feeds.PUMP_STATE}) z WHERE NOT ({feeds.PUMP_HEADER_ROW}))"

_tenths = {
    "bt1_outdoor_temp_c": "bt1_raw", "bt1_average_c": "bt1_average_raw", "bt28_outdoor_module_c": "eb101_bt28_raw",
    "bt71_return_c": "bt71_raw", "bt6_dhw_top_c": "bt6_raw", "bt7_dhw_charge_c": "bt7_raw", "bt25_supply_c": "bt25_raw",
    "bt63_hw_supply_c": "bt63_raw", "calc_supply_c": "calc_supply_raw", "bt3_return_cond_c": "eb101_bt3_raw",
    "bt12_condenser_c": "eb101_bt12_raw", "bt14_discharge_c": "eb101_bt14_raw", "bt15_liquid_c": "eb101_bt15_raw",
    "bt16_evap_c": "eb101_bt16_raw", "bt17_suction_c": "eb101_bt17_raw", "saturation_temp_c": "saturation_temp_raw",
    "saturation_temp_sent_c": "sat_temp_sent_raw", "bp4_hp_bar": "eb101_bp4_raw", "bp4_hp_raw_bar": "eb101_bp4_adc_raw",
    "compr_freq_act_hz": "compr_freq_act_raw", "degree_minutes": "degree_minutes_raw",
    "delta_t_k": "(bt25_raw - bt71_raw)", "superheat_k": "(eb101_bt17_raw - eb101_bt16_raw)",
    "supply_deviation_k": "(bt63_raw - calc_supply_raw)", "discharge_superheat_k": "(eb101_bt14_raw - bt25_raw)",
    "bt1_bt28_divergence_k": "abs(bt1_raw - eb101_bt28_raw)",
}
_whole = {
    "sw_version": "version_raw", "r_version": "r_version_raw", "lp_raw": "eb101_low_pressure_raw",
    "compr_freq_calc_hz": "compr_freq_calc_raw", "compr_state": "compr_state_raw",
    "compr_protection_mode": "compr_protection_mode_raw", "gp12_fan_pct": "gp12_speed_raw",
    "relays_pca_base": "relays_pca_base_raw", "priority_mode": "prio_raw", "alarm_number": "alarm_number_raw",
}
PARSED = (
    f"parsed AS (SELECT CASE WHEN NOT ({feeds.PUMP_BAD_TIME}) THEN ts END AS logged_at, CAST(ts AS DATE) AS log_date, "
    "concat('d', CAST(u % 4 AS STRING)) AS device, "
    + ", ".join(f"CAST({x} AS DOUBLE) / 10 AS {n}" for n, x in _tenths.items()) + ", "
    + ", ".join(f"CAST({x} AS BIGINT) AS {n}" for n, x in _whole.items())
    + ", CAST(tot_int_add_raw AS DOUBLE) / 100 AS tot_int_add_kw, compr_state_raw = 2 AS compr_running, "
    "gp10_on_off_raw > 0 AS gp10_circ_pump_on, alarm_number_raw > 0 AS alarm_active, "
    "compr_freq_act_raw > 0 AND eb101_bt17_raw < eb101_bt16_raw AS negative_superheat, "
    "eb101_bt16_raw > 100 AND gp12_speed_raw > 30 AS defrost_active, "
    "CASE prio_raw WHEN 30 THEN 'HEATING' WHEN 20 THEN 'DHW' WHEN 10 THEN 'STANDBY' ELSE 'UNKNOWN' END AS mode_name, "
    "CASE tot_int_add_raw WHEN 0 THEN 'OFF' WHEN 300 THEN '3kW' WHEN 600 THEN '6kW' WHEN 900 THEN '9kW' ELSE 'UNKNOWN' END "
    "AS heater_stage, concat('/logs/day-', strftime(ts, '%d'), '.log') AS source_file, "
    "concat('day-', strftime(ts, '%d'), '.log') AS source_filename, ts AS ingested_at FROM raw)"
)
RULES = {
    "valid_timestamp": "logged_at IS NOT NULL",
    "valid_outdoor_temp": "bt1_outdoor_temp_c BETWEEN -40 AND 50",
    "valid_supply_temp": "bt25_supply_c BETWEEN 10 AND 65",
    "valid_freq": "compr_freq_act_hz BETWEEN 0 AND 130",
}
SILVER = f"WITH {RAW}, {PARSED}, silver AS (SELECT * FROM parsed WHERE {' AND '.join(RULES.values())})"

ORACLE["raw_logs"] = fin(
    f"WITH {RAW} SELECT *, CASE WHEN {feeds.PUMP_BAD_TIME} THEN '99:99:99' ELSE strftime(ts, '%H:%M:%S.%f') END AS log_time, "
    "concat('/logs/day-', strftime(ts, '%d'), '.log') AS _source_file, "
    "concat('day-', strftime(ts, '%d'), '.log') AS _source_filename, ts AS _ingested_at, ts AS log_date FROM raw",
    s=["log_time", "_source_file", "_source_filename"], day=["log_date"], ts=["_ingested_at"],
    x={n: ("coalesce(CAST(eb101_bp4_raw AS STRING), 'ERR')" if n == "eb101_bp4_raw" else f"CAST({n} AS STRING)")
       for n in feeds.PUMP_REGISTERS},
)
_doubles = [*_tenths, "tot_int_add_kw"]
_flags = ["compr_running", "gp10_circ_pump_on", "alarm_active", "negative_superheat", "defrost_active"]
ORACLE["samples"] = fin(
    f"{SILVER} SELECT *, log_date AS log_date_parsed FROM silver", i=list(_whole), d=_doubles,
    s=["mode_name", "heater_stage", "source_file", "source_filename", *_flags], day=["log_date_parsed"],
    ts=["logged_at", "ingested_at"],
)
ORACLE["sample_rule_counts"] = f"WITH {RAW}, {PARSED} " + " UNION ALL ".join(
    f"SELECT 'samples' AS dataset, '{n}' AS rule, 'drop' AS action, "
    f"count(*) FILTER (WHERE coalesce({p}, false)) AS passed, count(*) FILTER (WHERE NOT coalesce({p}, false)) AS failed FROM parsed"
    for n, p in RULES.items()
)
ORACLE["alarm_events"] = fin(
    f"{SILVER} SELECT *, logged_at AS alarm_start FROM silver WHERE alarm_active",
    i=["alarm_number", "compr_state", "compr_protection_mode", "lp_raw", "priority_mode"],
    d="bt1_outdoor_temp_c bt25_supply_c calc_supply_c supply_deviation_k compr_freq_act_hz bt3_return_cond_c bt16_evap_c "
      "bt17_suction_c superheat_k bp4_hp_bar bt6_dhw_top_c bt7_dhw_charge_c degree_minutes".split(),
    s=["source_filename"], ts=["alarm_start", "ingested_at"],
)
ORACLE["current_state"] = fin(
    f"{SILVER} SELECT *, log_date AS log_date_parsed FROM silver "
    "QUALIFY logged_at = max(logged_at) OVER (PARTITION BY log_date)",
    i=["sw_version", "compr_state", "compr_protection_mode", "lp_raw", "priority_mode", "alarm_number"],
    d="bt1_outdoor_temp_c bt71_return_c bt6_dhw_top_c bt25_supply_c calc_supply_c supply_deviation_k compr_freq_act_hz "
      "bt3_return_cond_c bt16_evap_c bt17_suction_c superheat_k bp4_hp_bar degree_minutes tot_int_add_kw".split(),
    s=["compr_running", "alarm_active", "source_filename"], day=["log_date_parsed"], ts=["logged_at"],
)

# name: (aggregate, column)
_stats = {
    "avg_outdoor_temp_c": "avg(bt1_outdoor_temp_c)", "min_outdoor_temp_c": "min(bt1_outdoor_temp_c)",
    "max_outdoor_temp_c": "max(bt1_outdoor_temp_c)", "avg_return_c": "avg(bt71_return_c)",
    "min_return_c": "min(bt71_return_c)", "max_return_c": "max(bt71_return_c)", "avg_hw_top_c": "avg(bt6_dhw_top_c)",
    "min_hw_top_c": "min(bt6_dhw_top_c)", "max_hw_charge_c": "max(bt7_dhw_charge_c)",
    "avg_supply_c": "avg(bt25_supply_c)", "avg_calc_supply_c": "avg(calc_supply_c)",
    "avg_supply_deviation_k": "avg(supply_deviation_k)", "stddev_supply_deviation_k": "stddev_samp(supply_deviation_k)",
    "compr_running_fraction": "avg(CASE WHEN compr_running THEN 1.0 ELSE 0.0 END)",
    "avg_compr_freq_hz": "avg(compr_freq_act_hz)", "max_compr_freq_hz": "max(compr_freq_act_hz)",
    "min_running_compr_freq_hz": "min(compr_freq_act_hz) FILTER (WHERE compr_running)",
    "avg_degree_minutes": "avg(degree_minutes)", "min_degree_minutes": "min(degree_minutes)",
    "avg_return_cond_c": "avg(bt3_return_cond_c)", "max_return_cond_c": "max(bt3_return_cond_c)",
    "avg_evap_c": "avg(bt16_evap_c)", "avg_superheat_k": "avg(superheat_k)", "min_superheat_k": "min(superheat_k)",
    "max_superheat_k": "max(superheat_k)", "stddev_superheat_k": "stddev_samp(superheat_k)",
    "avg_discharge_superheat_k": "avg(discharge_superheat_k)", "avg_hp_bar": "avg(bp4_hp_bar)",
    "max_hp_bar": "max(bp4_hp_bar)", "avg_lp_raw": "avg(lp_raw)", "avg_gp12_fan_pct": "avg(gp12_fan_pct)",
    "gp10_circ_pump_fraction": "avg(CASE WHEN gp10_circ_pump_on THEN 1.0 ELSE 0.0 END)",
    "max_tot_int_add_kw": "max(tot_int_add_kw)",
}
ORACLE["hourly_stats"] = fin(
    f"{SILVER} SELECT date_trunc('hour', logged_at) AS hour_start, sw_version, count(*) AS sample_count, "
    + ", ".join(f"{x} AS {n}" for n, x in _stats.items())
    + ", sum(compr_protection_mode) AS protection_mode_samples, max(CASE WHEN alarm_active THEN 1 ELSE 0 END) AS had_alarm, "
    "array_to_string(list_sort(list(DISTINCT alarm_number)), ',') AS alarm_codes FROM silver GROUP BY ALL",
    i=["sw_version", "sample_count", "protection_mode_samples", "had_alarm"], d=list(_stats), s=["alarm_codes"], ts=["hour_start"],
)

ON, HEAT = "compr_freq_act_hz > 0", "compr_freq_act_hz > 0 AND priority_mode = 30"
IDLE = "compr_freq_act_hz = 0 AND tot_int_add_kw = 0 AND priority_mode = 10"
SUB = "bt12_condenser_c - bt15_liquid_c"


def gapped(part: str = "log_date", src: str = "silver") -> str:
    w = f"OVER (PARTITION BY {part} ORDER BY logged_at)"
    return (
        f"gaps AS (SELECT *, CASE WHEN lag(logged_at) {w} IS NULL THEN 5 "
        f"WHEN date_sub('second', lag(logged_at) {w}, logged_at) > 10 THEN 10 "
        f"ELSE date_sub('second', lag(logged_at) {w}, logged_at) END AS gap FROM {src})"
    )


_hourly = {
    "outdoor_avg_c": avg("bt1_outdoor_temp_c"), "outdoor_min_c": mn("bt1_outdoor_temp_c"),
    "supply_avg_c": avg("bt25_supply_c"), "return_avg_c": avg("bt71_return_c"), "calc_supply_avg_c": avg("calc_supply_c"),
    "delta_t_avg_k": avg("delta_t_k", ON), "dm_avg": avg("degree_minutes", n=0), "dm_min": mn("degree_minutes", n=0),
    "freq_avg_hz": avg("compr_freq_act_hz", ON, 0), "compr_duty_pct": pct(ON, n=0),
    "heater_kwh": r("sum(tot_int_add_kw * gap) / 3600", 2), "heater_duty_pct": pct("tot_int_add_kw > 0", n=0),
    "superheat_avg_k": avg("superheat_k", ON),
    **{f"superheat_p{int(p * 100)}_k": r(f"quantile_disc(superheat_k, {p}) FILTER (WHERE {ON})", 1) for p in (0.1, 0.5, 0.9)},
    "subcooling_avg_k": avg(SUB, ON), "subcooling_min_k": mn(SUB, ON), "hp_avg_bar": avg("bp4_hp_bar", ON),
    "discharge_avg_c": avg("bt14_discharge_c", ON), "bt1_bt28_avg_divergence_k": avg("bt1_bt28_divergence_k"),
    "dhw_avg_c": avg("bt6_dhw_top_c"), "heating_pct": pct("priority_mode = 30", n=0), "dhw_pct": pct("priority_mode = 20", n=0),
}
HOURLY = (
    f"{SILVER}, {gapped()}, hourly AS (SELECT log_date, hour(logged_at) AS hour, "
    + ", ".join(f"{x} AS {n}" for n, x in _hourly.items())
    + ", count(*) FILTER (WHERE alarm_active) AS alarm_samples, count(*) AS samples FROM gaps GROUP BY 1, 2)"
)
ORACLE["hourly_detail"] = fin(f"{HOURLY} SELECT * FROM hourly", i=["hour", "alarm_samples", "samples"], d=list(_hourly), day=["log_date"])

_daily = {
    "outdoor_min_c": mn("bt1_outdoor_temp_c"), "outdoor_max_c": mx("bt1_outdoor_temp_c"), "outdoor_avg_c": avg("bt1_outdoor_temp_c"),
    "supply_avg_c": avg("bt25_supply_c", HEAT), "return_avg_c": avg("bt71_return_c", HEAT),
    "delta_t_avg_k": avg("delta_t_k", HEAT), "delta_t_max_k": mx("delta_t_k", ON),
    "calc_supply_avg_c": avg("calc_supply_c", "priority_mode = 30"),
    "supply_vs_calc_offset_k": avg("bt25_supply_c - calc_supply_c", HEAT),
    "dm_avg": avg("degree_minutes", n=0), "dm_min": "min(degree_minutes)", "dm_max": "max(degree_minutes)",
    "compr_duty_pct": pct(ON), "compr_freq_avg_hz": avg("compr_freq_act_hz", ON, 0), "compr_freq_max_hz": mx("compr_freq_act_hz", n=0),
    "compr_running_hours": r(f"coalesce(sum(gap) FILTER (WHERE {ON}), 0) / 3600", 1), "total_hours": r("sum(gap) / 3600", 1),
    "heater_duty_pct": pct("tot_int_add_kw > 0"), "heater_energy_kwh": r("sum(tot_int_add_kw * gap) / 3600", 1),
    "heater_max_kw": "max(tot_int_add_kw)", "superheat_avg_k": avg("superheat_k", ON), "superheat_min_k": mn("superheat_k", ON),
    "neg_superheat_pct": pct("negative_superheat", of=ON), "hp_avg_bar": avg("bp4_hp_bar", ON), "hp_max_bar": mx("bp4_hp_bar"),
    "lp_avg_raw": avg("lp_raw", ON), "discharge_avg_c": avg("bt14_discharge_c", ON), "discharge_max_c": mx("bt14_discharge_c"),
    "alarm_pct": pct("alarm_active"), "alarm_excl_183_pct": pct("alarm_active AND alarm_number <> 183"),
    "bt1_bt28_avg_divergence_k": avg("bt1_bt28_divergence_k"), "bt1_bt28_max_divergence_k": mx("bt1_bt28_divergence_k"),
    "heating_pct": pct("priority_mode = 30", n=0), "dhw_pct": pct("priority_mode = 20", n=0), "dhw_avg_c": avg("bt6_dhw_top_c"),
    "dhw_min_c": mn("bt6_dhw_top_c"), "subcooling_avg_k": avg(SUB, ON), "subcooling_min_k": mn(SUB, ON),
    "standby_circ_pump_pct": pct(f"{IDLE} AND gp10_circ_pump_on", of=IDLE), "standby_fan_avg_pct": avg("gp12_fan_pct", IDLE),
    "bt1_vs_avg_divergence_k": avg("abs(bt1_outdoor_temp_c - bt1_average_c)"),
}
_daily_counts = {
    "alarm_samples": "count(*) FILTER (WHERE alarm_active)", "defrost_samples": "count(*) FILTER (WHERE defrost_active)",
    "total_samples": "count(*)",
}
_codes = "coalesce(array_to_string(list_sort(list(DISTINCT alarm_number) FILTER (WHERE alarm_active AND alarm_number > 0)), ','), '')"


def daily_ctes(keys: str = "log_date") -> str:
    """Day tables the long way round: separate passes for starts, defrosts and short cycles."""
    w = f"(PARTITION BY {keys} ORDER BY logged_at)"
    on = [k.strip() for k in keys.split(",")]
    using = f"USING ({', '.join(on)})"
    return (
        f"{gapped(keys)}, lagged AS (SELECT *, lag(compr_freq_act_hz, 1, 0) OVER {w} AS pf, "
        f"coalesce(lag(defrost_active) OVER {w}, false) AS pd FROM gaps), "
        f"starts AS (SELECT {keys}, count(*) FILTER (WHERE compr_freq_act_hz > 0 AND pf = 0) AS compr_starts FROM lagged GROUP BY ALL), "
        f"defr AS (SELECT {keys}, count(*) FILTER (WHERE defrost_active AND NOT pd) AS defrost_cycles FROM lagged GROUP BY ALL), "
        "offs AS (SELECT *, last_value(CASE WHEN compr_freq_act_hz = 0 AND pf > 0 THEN logged_at END IGNORE NULLS) "
        f"OVER (PARTITION BY {keys} ORDER BY logged_at ROWS UNBOUNDED PRECEDING) AS off_start FROM lagged), "
        f"short AS (SELECT {keys}, count(*) FILTER (WHERE compr_freq_act_hz > 0 AND pf = 0 "
        "AND date_sub('second', off_start, logged_at) < 300) AS short_cycle_count FROM offs GROUP BY ALL), "
        f"sums AS (SELECT {keys}, {', '.join(f'{x} AS {n}' for n, x in {**_daily, **_daily_counts}.items())}, "
        f"{_codes} AS alarm_codes FROM gaps GROUP BY ALL), "
        f"daily AS (SELECT * FROM sums LEFT JOIN starts {using} LEFT JOIN defr {using} LEFT JOIN short {using})"
    )


_daily_fin = dict(
    i=[*_daily_counts, "compr_starts", "defrost_cycles", "short_cycle_count"], d=list(_daily), day=["log_date"],
)
ORACLE["daily_summary"] = fin(f"{SILVER}, {daily_ctes()} SELECT * FROM daily", **_daily_fin, s=["alarm_codes"])
ORACLE["daily_summary_per_device"] = fin(
    f"{SILVER}, {daily_ctes('device, log_date')} SELECT * FROM daily", **_daily_fin, s=["alarm_codes", "device"]
)

_flow = {
    "delta_t_avg_k": avg("delta_t_k"), "delta_t_max_k": mx("delta_t_k"), "hp_avg_bar": avg("bp4_hp_bar"),
    "discharge_avg_c": avg("bt14_discharge_c"), "superheat_avg_k": avg("superheat_k"), "heater_pct": pct("tot_int_add_kw > 0", n=0),
}
FLOW = (
    "flow AS (SELECT log_date, CASE WHEN compr_freq_act_hz < 1 THEN NULL WHEN compr_freq_act_hz < 40 THEN '01_low_1-39Hz' "
    "WHEN compr_freq_act_hz < 70 THEN '02_mid_40-69Hz' WHEN compr_freq_act_hz < 100 THEN '03_high_70-99Hz' "
    f"ELSE '04_max_100+Hz' END AS freq_band, {', '.join(f'{x} AS {n}' for n, x in _flow.items())}, count(*) AS samples "
    f"FROM silver WHERE {HEAT} GROUP BY 1, 2)"
)
ORACLE["flow_quality"] = fin(f"{SILVER}, {FLOW} SELECT * FROM flow", i=["samples"], d=list(_flow), s=["freq_band"], day=["log_date"])

_curve = {
    "calc_supply_c": avg("calc_supply_c"), "actual_supply_c": avg("bt25_supply_c"), "return_c": avg("bt71_return_c"),
    "delta_t_k": avg("delta_t_k"), "dm_avg": avg("degree_minutes", n=0), "freq_avg_hz": avg("compr_freq_act_hz", n=0),
    "heater_pct": pct("tot_int_add_kw > 0", n=0), "hp_avg_bar": avg("bp4_hp_bar"),
}
CURVE = (
    f"curve AS (SELECT log_date, {r('bt1_outdoor_temp_c', 0)} AS bt1_rounded_c, {', '.join(f'{x} AS {n}' for n, x in _curve.items())}, "
    f"count(*) AS samples FROM silver WHERE {HEAT} GROUP BY 1, 2 HAVING count(*) > 20)"
)
ORACLE["heating_curve"] = fin(f"{SILVER}, {CURVE} SELECT * FROM curve", i=["samples"], d=["bt1_rounded_c", *_curve], day=["log_date"])

QUALITY = (
    "rawgap AS (SELECT *, date_sub('second', lag(logged_at) OVER (PARTITION BY log_date ORDER BY logged_at), logged_at) AS g FROM silver), "
    f"quality AS (SELECT log_date, count(*) AS total_samples, {r('count(*) * 100.0 / 17280', 1)} AS coverage_pct, "
    f"{r('count(*) * 5.0 / 3600', 1)} AS logged_hours, "
    "count(*) - count(bt1_outdoor_temp_c) AS null_bt1, count(*) - count(bt25_supply_c) AS null_bt25, "
    "count(*) - count(compr_freq_act_hz) AS null_freq, count(*) - count(bp4_hp_bar) AS null_hp, count(*) - count(bt16_evap_c) AS null_bt16, "
    "max(g) AS max_gap_seconds, count(*) FILTER (WHERE g > 60) AS gaps_over_60s, count(*) FILTER (WHERE g > 600) AS gaps_over_600s "
    "FROM rawgap GROUP BY 1)"
)
_quality_i = "total_samples null_bt1 null_bt25 null_freq null_hp null_bt16 max_gap_seconds gaps_over_60s gaps_over_600s".split()
ORACLE["data_quality"] = fin(f"{SILVER}, {QUALITY} SELECT * FROM quality", i=_quality_i, d=["coverage_pct", "logged_hours"], day=["log_date"])


def runs(name: str, flagged: str, state: str, number: str, aggregates: dict[str, str], extra: str = "") -> str:
    """Gaps and islands: flag on all rows, keep the rows in state, running count, group."""
    cols = ", ".join(f"{x} AS {n}" for n, x in aggregates.items())
    more = f", {extra}" if extra else ""
    return (
        f"{name}_f AS (SELECT *, {flagged} AS flag FROM silver), "
        f"{name}_n AS (SELECT *, sum(flag) OVER (PARTITION BY log_date ORDER BY logged_at ROWS UNBOUNDED PRECEDING) AS {number} "
        f"FROM {name}_f WHERE {state}), "
        f"{name} AS (SELECT log_date, {number}{more}, min(logged_at) AS start_time, max(logged_at) AS end_time, "
        f"{r('greatest(date_sub(' + chr(39) + 'second' + chr(39) + ', min(logged_at), max(logged_at)), 5) / 60', 1)} AS duration_min, "
        f"{cols}, count(*) AS samples FROM {name}_n GROUP BY log_date, {number}{more})"
    )


_W = "OVER (PARTITION BY log_date ORDER BY logged_at)"
_alarm = {
    "outdoor_avg_c": avg("bt1_outdoor_temp_c"), "freq_avg_hz": avg("compr_freq_act_hz", n=0), "hp_avg_bar": avg("bp4_hp_bar"),
    "discharge_avg_c": avg("bt14_discharge_c"), "superheat_avg_k": avg("superheat_k"), "delta_t_avg_k": avg("delta_t_k"),
    "heater_avg_kw": avg("tot_int_add_kw"), "dm_avg": avg("degree_minutes", n=0), "bt1_bt28_divergence_k": avg("bt1_bt28_divergence_k"),
}
_code = "CASE WHEN alarm_active THEN alarm_number ELSE 0 END"
ALARMS = runs("alarms", f"CASE WHEN {_code} <> lag({_code}, 1, 0) {_W} THEN 1 ELSE 0 END", "alarm_active", "episode_id", _alarm, "alarm_number")
ORACLE["alarm_episodes"] = fin(
    f"{SILVER}, {ALARMS} SELECT * FROM alarms", i=["episode_id", "alarm_number", "samples"], d=["duration_min", *_alarm],
    day=["log_date"], ts=["start_time", "end_time"],
)
_defrost = {
    "outdoor_avg_c": avg("bt1_outdoor_temp_c"), "outdoor_min_c": mn("bt1_outdoor_temp_c"),
    "bt16_start_c": r("arg_min(bt16_evap_c, logged_at)", 1), "bt16_end_c": r("arg_max(bt16_evap_c, logged_at)", 1),
    "bt16_avg_c": avg("bt16_evap_c"), "fan_avg_pct": avg("gp12_fan_pct", n=0), "freq_avg_hz": avg("compr_freq_act_hz", n=0),
    "hp_avg_bar": avg("bp4_hp_bar"), "discharge_avg_c": avg("bt14_discharge_c"),
    "had_non_defrost_alarm": "max(CASE WHEN alarm_active AND alarm_number <> 183 THEN 1 ELSE 0 END)",
}
DEFROST = runs("defrosts", f"CASE WHEN defrost_active AND NOT coalesce(lag(defrost_active) {_W}, false) THEN 1 ELSE 0 END",
               "defrost_active", "episode_id", _defrost)
ORACLE["defrost_cycles"] = fin(
    f"{SILVER}, {DEFROST} SELECT * FROM defrosts", i=["episode_id", "samples", "had_non_defrost_alarm"],
    d=["duration_min", *[c for c in _defrost if c != "had_non_defrost_alarm"]], day=["log_date"], ts=["start_time", "end_time"],
)
_dhw = {
    **{f"{s}_{w}_c": r(f"{f}({c}, logged_at)", 1) for s, c in (("bt6", "bt6_dhw_top_c"), ("bt7", "bt7_dhw_charge_c"))
       for w, f in (("start", "arg_min"), ("end", "arg_max"))},
    "outdoor_avg_c": avg("bt1_outdoor_temp_c"), "freq_avg_hz": avg("compr_freq_act_hz", n=0), "hp_avg_bar": avg("bp4_hp_bar"),
    "superheat_avg_k": avg("superheat_k"), "heater_duty_pct": pct("tot_int_add_kw > 0", n=0),
    "heater_kwh": r("sum(tot_int_add_kw * 5) / 3600", 2), "had_alarm": "max(CASE WHEN alarm_active THEN 1 ELSE 0 END)",
}
DHW = runs("dhw", f"CASE WHEN priority_mode = 20 AND coalesce(lag(priority_mode) {_W}, 0) <> 20 THEN 1 ELSE 0 END",
           "priority_mode = 20", "episode_id", _dhw)
ORACLE["dhw_cycles"] = fin(
    f"{SILVER}, {DHW} SELECT * FROM dhw", i=["episode_id", "samples", "had_alarm"],
    d=["duration_min", *[c for c in _dhw if c != "had_alarm"]], day=["log_date"], ts=["start_time", "end_time"],
)

_cycle = {
    "freq_avg_hz": avg("compr_freq_act_hz", n=0), "freq_max_hz": mx("compr_freq_act_hz", n=0),
    "freq_stddev": r("stddev_samp(compr_freq_act_hz)", 1), "delta_t_avg_k": avg("delta_t_k"), "delta_t_max_k": mx("delta_t_k"),
    "delta_t_spread_k": r("quantile_disc(delta_t_k, 0.9) - quantile_disc(delta_t_k, 0.1)", 1), "superheat_avg_k": avg("superheat_k"),
    "superheat_min_k": mn("superheat_k"), "neg_superheat_pct": pct("negative_superheat", n=0), "hp_avg_bar": avg("bp4_hp_bar"),
    "hp_max_bar": mx("bp4_hp_bar"), "discharge_avg_c": avg("bt14_discharge_c"), "discharge_max_c": mx("bt14_discharge_c"),
    "outdoor_avg_c": avg("bt1_outdoor_temp_c"), "supply_avg_c": avg("bt25_supply_c"), "return_avg_c": avg("bt71_return_c"),
    "heater_pct": pct("tot_int_add_kw > 0", n=0), "dm_at_start": "arg_min(degree_minutes, logged_at)",
    "dm_at_end": "arg_max(degree_minutes, logged_at)", "bt1_bt28_avg_divergence_k": avg("bt1_bt28_divergence_k"),
}


def cycle_ctes(part: str = "log_date", glob: str = "") -> str:
    """A single running sum over the whole table numbers the cycles."""
    dev = "device, " if glob else ""
    return (
        f"cf AS (SELECT *, CASE WHEN compr_freq_act_hz > 0 AND lag(compr_freq_act_hz, 1, 0) OVER (PARTITION BY {part} ORDER BY logged_at) = 0 "
        f"THEN 1 ELSE 0 END AS flag FROM silver), cn AS (SELECT *, sum(flag) OVER ({glob} ORDER BY logged_at ROWS UNBOUNDED PRECEDING) AS cycle_id "
        "FROM cf WHERE compr_freq_act_hz > 0), "
        + "".join(
            f"mode_{c} AS (SELECT {dev}cycle_id, {c} AS {out} FROM (SELECT {dev}cycle_id, {c}, count(*) AS n FROM cn GROUP BY ALL) "
            f"QUALIFY row_number() OVER (PARTITION BY {dev}cycle_id ORDER BY n DESC, {c}) = 1), "
            for c, out in (("priority_mode", "dominant_mode"), ("mode_name", "dominant_mode_name"))
        )
        + f"cyc AS (SELECT {dev}cycle_id, min(log_date) AS log_date, min(logged_at) AS start_time, max(logged_at) AS end_time, "
        f"{r('date_sub(' + chr(39) + 'second' + chr(39) + ', min(logged_at), max(logged_at)) / 60', 1)} AS duration_min, "
        f"{', '.join(f'{x} AS {n}' for n, x in _cycle.items())}, max(CASE WHEN alarm_active THEN 1 ELSE 0 END) AS had_alarm, "
        f"max(alarm_number) FILTER (WHERE alarm_active) AS alarm_code, count(*) AS samples FROM cn GROUP BY {dev}cycle_id HAVING count(*) >= 6), "
        f"cycles AS (SELECT * FROM cyc LEFT JOIN mode_priority_mode USING ({dev}cycle_id) LEFT JOIN mode_mode_name USING ({dev}cycle_id))"
    )


CYCLES = cycle_ctes()
_cycle_fin = dict(
    i=["cycle_id", "had_alarm", "alarm_code", "samples", "dominant_mode"], d=["duration_min", *_cycle], day=["log_date"],
    ts=["start_time", "end_time"],
)
ORACLE["cycles"] = fin(f"{SILVER}, {CYCLES} SELECT * FROM cycles", **_cycle_fin, s=["dominant_mode_name"])
ORACLE["cycles_per_device"] = fin(
    f"{SILVER}, {cycle_ctes('device, log_date', 'PARTITION BY device')} SELECT * FROM cycles", **_cycle_fin, s=["dominant_mode_name", "device"]
)
ORACLE["incremental_cycles"] = ORACLE["cycles_per_device"]

_cs_d = {
    "cycles_per_day": r("count(*) * 24.0 / greatest(date_sub('hour', min(start_time), max(end_time)), 1)", 1),
    "avg_cycle_min": avg("duration_min"), "min_cycle_min": mn("duration_min"), "max_cycle_min": mx("duration_min"),
    "median_cycle_min": r("quantile_disc(duration_min, 0.5)", 1), "short_cycle_pct": pct("duration_min < 5", n=0),
    "avg_freq_volatility": avg("freq_stddev"), "avg_dt_spread_k": avg("delta_t_spread_k"),
}
_cs_i = {
    "total_cycles": "count(*)", "short_cycles": "count(*) FILTER (WHERE duration_min < 5)", "cycles_with_alarm": "sum(had_alarm)",
    "cycles_with_bad_superheat": "count(*) FILTER (WHERE neg_superheat_pct > 30)",
    "cycles_with_high_dt": "count(*) FILTER (WHERE delta_t_max_k > 7)", "heating_cycles": "count(*) FILTER (WHERE dominant_mode = 30)",
    "dhw_cycles": "count(*) FILTER (WHERE dominant_mode = 20)",
}
CYCLE_DAYS = f"cdays AS (SELECT log_date, {', '.join(f'{x} AS {n}' for n, x in {**_cs_d, **_cs_i}.items())} FROM cycles GROUP BY 1)"
ORACLE["cycle_summary"] = fin(f"{SILVER}, {CYCLES}, {CYCLE_DAYS} SELECT * FROM cdays", i=list(_cs_i), d=list(_cs_d), day=["log_date"])

_BIN = r("outdoor_avg_c / 2", 0) + " * 2"
FEATURES = (
    f"{SILVER}, {daily_ctes()}, {FLOW}, {CURVE}, {QUALITY}, {CYCLES}, {CYCLE_DAYS}, "
    f"base AS (SELECT {_BIN} AS bin, quantile_disc(delta_t_avg_k, 0.5) AS mdt, quantile_disc(heater_duty_pct, 0.5) AS mh FROM daily GROUP BY 1), "
    f"mild AS (SELECT log_date, {r('sum(CASE WHEN heater_pct > 0 THEN samples ELSE 0 END) * 100.0 / sum(samples)', 0)} AS heater_pct_above_minus10 "
    "FROM curve WHERE bt1_rounded_c > -10 GROUP BY 1), "
    "feat AS (SELECT d.*, fm.delta_t_avg_k AS dt_at_max_freq_k, fm.heater_pct AS heater_at_max_freq_pct, "
    "coalesce(fm.delta_t_avg_k, 0) - coalesce(fl.delta_t_avg_k, 0) AS dt_freq_gradient_k, mild.heater_pct_above_minus10, "
    "c.total_cycles, c.cycles_per_day, c.avg_cycle_min, c.short_cycle_pct, c.avg_freq_volatility, c.cycles_with_alarm, "
    "c.cycles_with_bad_superheat, c.avg_dt_spread_k, "
    "avg(d.delta_t_avg_k) OVER w7 AS delta_t_7d_avg, avg(d.neg_superheat_pct) OVER w7 AS neg_sh_7d_avg, "
    "avg(d.heater_energy_kwh) OVER w7 AS heater_kwh_7d_avg, "
    "d.delta_t_avg_k - lag(d.delta_t_avg_k) OVER (ORDER BY d.log_date) AS delta_t_dod_change, "
    "d.neg_superheat_pct - lag(d.neg_superheat_pct) OVER (ORDER BY d.log_date) AS neg_sh_dod_change, "
    "d.delta_t_avg_k - base.mdt AS dt_residual_k, d.heater_duty_pct - base.mh AS heater_residual_pct, q.coverage_pct, q.max_gap_seconds "
    "FROM daily d LEFT JOIN flow fm ON fm.log_date = d.log_date AND fm.freq_band = '04_max_100+Hz' "
    "LEFT JOIN flow fl ON fl.log_date = d.log_date AND fl.freq_band = '01_low_1-39Hz' "
    "LEFT JOIN mild ON mild.log_date = d.log_date LEFT JOIN cdays c ON c.log_date = d.log_date "
    f"LEFT JOIN quality q ON q.log_date = d.log_date LEFT JOIN base ON base.bin = {_BIN.replace('outdoor_avg_c', 'd.outdoor_avg_c')} "
    "WINDOW w7 AS (ORDER BY d.log_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))"
)
_feat_i = "total_cycles cycles_with_alarm cycles_with_bad_superheat max_gap_seconds".split()
_feat_d = (
    "outdoor_avg_c outdoor_min_c delta_t_avg_k dm_avg dm_min compr_duty_pct compr_freq_avg_hz heater_duty_pct heater_energy_kwh "
    "neg_superheat_pct superheat_avg_k hp_avg_bar discharge_max_c alarm_pct alarm_excl_183_pct bt1_bt28_max_divergence_k "
    "supply_vs_calc_offset_k dt_at_max_freq_k heater_at_max_freq_pct dt_freq_gradient_k heater_pct_above_minus10 cycles_per_day "
    "avg_cycle_min short_cycle_pct avg_freq_volatility avg_dt_spread_k delta_t_7d_avg neg_sh_7d_avg heater_kwh_7d_avg "
    "delta_t_dod_change neg_sh_dod_change dt_residual_k heater_residual_pct coverage_pct"
).split()
ORACLE["ml_features"] = fin(f"{FEATURES} SELECT * FROM feat", i=_feat_i, d=_feat_d, day=["log_date"])


def _case(*pairs: tuple[str, str], other: str) -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in pairs) + f" ELSE {other} END"


_statuses = {
    "flow_status": _case(("delta_t_avg_k > 7", "'CRITICAL'"), ("delta_t_avg_k > 5", "'WARNING'"), other="'OK'"),
    "superheat_status": _case(("neg_superheat_pct > 30", "'CRITICAL'"), ("neg_superheat_pct > 15", "'WARNING'"),
                              ("neg_superheat_pct > 5", "'MONITOR'"), other="'OK'"),
    "heater_status": _case(("heater_duty_pct > 10 AND outdoor_avg_c > -10", "'CRITICAL'"),
                           ("heater_duty_pct > 0 AND outdoor_avg_c > -10", "'WARNING'"), ("heater_duty_pct > 20", "'WARNING'"), other="'OK'"),
    "demand_status": _case(("dm_min < -520", "'CRITICAL'"), ("dm_min < -400", "'WARNING'"), other="'OK'"),
    "alarm_status": _case(("alarm_excl_183_pct > 15", "'CRITICAL'"), ("alarm_excl_183_pct > 5", "'WARNING'"), other="'OK'"),
    "discharge_status": _case(("discharge_max_c > 100", "'CRITICAL'"), ("discharge_max_c > 90", "'WARNING'"), other="'OK'"),
    "wind_snow_status": _case(("bt1_bt28_max_divergence_k > 5", "'WARNING'"), other="'OK'"),
    "cycling_status": _case(("short_cycle_pct > 20", "'WARNING'"), other="'OK'"),
    "data_quality_status": _case(("coverage_pct < 80", "'WARNING'"), other="'OK'"),
}
_points = " + ".join([
    _case(("delta_t_avg_k > 7", "30"), ("delta_t_avg_k > 5", "15"), other="0"),
    _case(("neg_superheat_pct > 30", "25"), ("neg_superheat_pct > 15", "10"), other="0"),
    _case(("heater_duty_pct > 10 AND outdoor_avg_c > -10", "20"), ("heater_duty_pct > 0 AND outdoor_avg_c > -10", "10"), other="0"),
    _case(("dm_min < -520", "15"), ("dm_min < -400", "5"), other="0"),
    _case(("alarm_excl_183_pct > 15", "10"), ("alarm_excl_183_pct > 5", "5"), other="0"),
    _case(("discharge_max_c > 100", "10"), other="0"), _case(("bt1_bt28_max_divergence_k > 5", "5"), other="0"),
    _case(("short_cycle_pct > 20", "5"), other="0"),
])
_overall = _case(
    ("delta_t_avg_k > 7 OR neg_superheat_pct > 30 OR dm_min < -520 OR (heater_duty_pct > 10 AND outdoor_avg_c > -10) "
     "OR discharge_max_c > 100 OR alarm_excl_183_pct > 15", "'🔴 CRITICAL'"),
    ("delta_t_avg_k > 5 OR neg_superheat_pct > 15 OR dm_min < -400 OR alarm_excl_183_pct > 5 OR heater_duty_pct > 20 "
     "OR discharge_max_c > 90", "'🟡 WARNING'"), other="'🟢 OK'",
)
_issue = _case(
    ("delta_t_avg_k > 7", "'Critical flow restriction — ΔT ' || CAST(delta_t_avg_k AS STRING) || 'K at high load'"),
    ("neg_superheat_pct > 30", "'Compressor at risk — negative superheat ' || CAST(neg_superheat_pct AS STRING) || '% of runtime'"),
    ("heater_duty_pct > 10 AND outdoor_avg_c > -10", "'Heater running ' || CAST(heater_duty_pct AS STRING) || '% at ' || "
     "CAST(outdoor_avg_c AS STRING) || '°C — possible flow or curve issue'"),
    ("dm_min < -520", "'DM saturated at ' || CAST(dm_min AS STRING) || ' — system cannot meet demand'"),
    ("discharge_max_c > 100", "'High discharge temp ' || CAST(discharge_max_c AS STRING) || '°C — compressor stress'"),
    ("alarm_excl_183_pct > 5", "'Actionable alarms present ' || CAST(alarm_excl_183_pct AS STRING) || '% of time (excl. defrost)'"),
    ("delta_t_avg_k > 5", "'Flow below optimal — ΔT ' || CAST(delta_t_avg_k AS STRING) || 'K'"),
    ("neg_superheat_pct > 15", "'Superheat declining — ' || CAST(neg_superheat_pct AS STRING) || '% negative, monitor trend'"),
    other="'System operating within normal parameters'",
)
_raised = "concat_ws(',', " + ", ".join(f"CASE WHEN {n} <> 'OK' THEN '{n}' END" for n in _statuses) + ")"
ANOMALY = (
    f"{FEATURES}, rules0 AS (SELECT *, {', '.join(f'{x} AS {n}' for n, x in _statuses.items())}, {_points} AS anomaly_score, "
    f"{_overall} AS overall_status, {_issue} AS top_issue FROM feat), rules AS (SELECT *, {_raised} AS raised FROM rules0)"
)
ORACLE["anomaly_rules"] = fin(
    f"{ANOMALY} SELECT * FROM rules", i=["anomaly_score"], s=[*_statuses, "overall_status", "top_issue", "raised"], day=["log_date"]
)
_ext = {
    "subcooling_status": _case(("subcooling_avg_k < 2 OR subcooling_avg_k > 10", "'WARNING'"), other="'OK'"),
    "defrost_count_status": _case(("defrost_cycles > 20", "'CRITICAL'"), ("defrost_cycles > 15", "'WARNING'"), other="'OK'"),
    "defrost_duration_status": _case(("defrost_avg_min > 12", "'CRITICAL'"), ("defrost_avg_min > 8", "'WARNING'"), other="'OK'"),
    "dhw_end_temp_status": _case(("dhw_min_end_c < 42", "'CRITICAL'"), ("dhw_min_end_c < 48", "'WARNING'"), other="'OK'"),
    "dhw_duration_status": _case(("dhw_max_min > 60", "'WARNING'"), other="'OK'"),
    "sensor_drift_status": _case(("bt1_vs_avg_divergence_k > 2", "'WARNING'"), other="'OK'"),
    "standby_pump_status": _case(("standby_circ_pump_pct > 10", "'WARNING'"), other="'OK'"),
}
ORACLE["extended_rules"] = fin(
    f"{SILVER}, {daily_ctes()}, {DEFROST}, {DHW}, "
    f"a AS (SELECT log_date, {avg('duration_min')} AS defrost_avg_min FROM defrosts GROUP BY 1), "
    "b AS (SELECT log_date, min(bt6_end_c) AS dhw_min_end_c, max(duration_min) AS dhw_max_min FROM dhw GROUP BY 1), "
    "j AS (SELECT * FROM daily LEFT JOIN a USING (log_date) LEFT JOIN b USING (log_date)) "
    f"SELECT *, {', '.join(f'{x} AS {n}' for n, x in _ext.items())} FROM j",
    i=["defrost_cycles"], s=list(_ext), day=["log_date"],
    d=["subcooling_avg_k", "bt1_vs_avg_divergence_k", "standby_circ_pump_pct", "defrost_avg_min", "dhw_min_end_c", "dhw_max_min"],
)
ORACLE["explained_alarms"] = fin(
    f"{SILVER}, {ALARMS} SELECT *, CASE alarm_number WHEN 162 THEN 'High discharge temp' WHEN 183 THEN 'Defrost in progress' "
    "WHEN 271 THEN 'Cold outdoor air' END AS description, CASE alarm_number WHEN 162 THEN 'CRITICAL' WHEN 183 THEN 'INFO' "
    "WHEN 271 THEN 'WARNING' END AS severity FROM alarms",
    i=["episode_id", "alarm_number"], s=["description", "severity"], day=["log_date"],
)
_alerts = [
    ("high_delta_t", "daily", "delta_t_avg_k > 6", "max(delta_t_avg_k)", ">", 6),
    ("negative_superheat", "daily", "neg_superheat_pct > 20", "max(neg_superheat_pct)", ">", 20),
    ("heater_mild_temp", "daily", "heater_duty_pct > 5 AND outdoor_avg_c > -10", "max(heater_duty_pct)", ">", 5),
    ("data_gap", "quality", "coverage_pct < 80 OR max_gap_seconds > 600", "min(coverage_pct)", "<", 80),
    ("degree_minutes", "daily", "dm_min < -500", "min(dm_min)", "<", -500),
    ("actionable_alarms", "daily", "alarm_excl_183_pct > 5", "max(alarm_excl_183_pct)", ">", 5),
]
ORACLE["alerts"] = fin(
    f"{SILVER}, {daily_ctes()}, {QUALITY} " + " UNION ALL ".join(
        f"SELECT '{n}' AS alert, count(*) AS rows, {v} AS value, {t} AS threshold, coalesce({v} {op} {t}, false) AS triggered "
        f"FROM {src} WHERE log_date = DATE '{AS_OF}' - 1 AND ({p})" for n, src, p, v, op, t in _alerts),
    i=["rows"], d=["value", "threshold"], s=["alert", "triggered"],
)

# -- tools ----------------------------------------------------------------------------------

_recent = f"WHERE log_date >= DATE '{AS_OF}' - 7"
_kind = {"compr_starts": "i", "short_cycle_count": "i", "defrost_cycles": "i", "alarm_codes": "s", "log_date": "day", "freq_band": "s",
         "samples": "i", "alarm_number": "i", "start_time": "ts", "max_gap_seconds": "i", "null_bt1": "i", "null_freq": "i",
         "null_hp": "i", "total_cycles": "i", "cycles_with_alarm": "i", "cycles_with_bad_superheat": "i", "cycles_with_high_dt": "i",
         "heating_cycles": "i", "dhw_cycles": "i", "episode_id": "i", "had_non_defrost_alarm": "i", "had_alarm": "i",
         "anomaly_score": "i", "overall_status": "s", "top_issue": "s", "hour": "i", "alarm_samples": "i", "cycle_id": "i",
         "alarm_code": "i", "dominant_mode_name": "s", "problem_score": "i", "days": "i", "period": "s", "start_date": "day",
         "end_date": "day", "comparable_weather": "s", **{n: "s" for n in _statuses}}


def _fields(sql: str, fields: str) -> str:
    sorts: dict[str, list[str]] = {"i": [], "d": [], "s": [], "day": [], "ts": []}
    for f in fields.split():
        sorts[_kind.get(f, "d")].append(f)
    return fin(sql, **sorts)


ORACLE["get_daily_summary"] = _fields(
    f"{SILVER}, {daily_ctes()} SELECT * FROM daily {_recent}",
    "log_date outdoor_min_c outdoor_avg_c delta_t_avg_k dm_avg dm_min compr_duty_pct compr_freq_avg_hz compr_starts heater_duty_pct "
    "heater_energy_kwh superheat_avg_k neg_superheat_pct hp_avg_bar discharge_max_c alarm_pct alarm_excl_183_pct alarm_codes "
    "bt1_bt28_max_divergence_k supply_vs_calc_offset_k total_hours subcooling_avg_k subcooling_min_k short_cycle_count "
    "standby_circ_pump_pct standby_fan_avg_pct bt1_vs_avg_divergence_k defrost_cycles",
)
ORACLE["get_flow_diagnosis"] = _fields(
    f"{SILVER}, {FLOW} SELECT * FROM flow {_recent}",
    "log_date freq_band delta_t_avg_k delta_t_max_k hp_avg_bar discharge_avg_c superheat_avg_k heater_pct samples",
)
ORACLE["flow_diagnosis_json"] = _fields(f"{SILVER}, {FLOW} SELECT * FROM flow {_recent}", "log_date freq_band delta_t_avg_k heater_pct samples")
ORACLE["get_superheat_status"] = _fields(
    f"{SILVER}, {daily_ctes()} SELECT * FROM daily {_recent}",
    "log_date superheat_avg_k superheat_min_k neg_superheat_pct compr_freq_avg_hz hp_avg_bar discharge_avg_c discharge_max_c",
)
ORACLE["get_alarm_episodes"] = _fields(
    f"{SILVER}, {ALARMS} SELECT * FROM alarms {_recent}",
    "log_date alarm_number start_time duration_min outdoor_avg_c freq_avg_hz hp_avg_bar discharge_avg_c superheat_avg_k delta_t_avg_k "
    "heater_avg_kw dm_avg",
)
ORACLE["get_data_quality"] = _fields(
    f"{SILVER}, {QUALITY} SELECT * FROM quality {_recent}", "log_date coverage_pct logged_hours max_gap_seconds null_bt1 null_freq null_hp"
)
ORACLE["get_system_health"] = _fields(
    f"{ANOMALY} SELECT * FROM rules {_recent}", "log_date overall_status anomaly_score top_issue " + " ".join(_statuses)
)
ORACLE["get_cycle_analysis"] = _fields(
    f"{SILVER}, {CYCLES}, {CYCLE_DAYS} SELECT * FROM cdays {_recent}",
    "log_date total_cycles cycles_per_day avg_cycle_min short_cycle_pct avg_freq_volatility cycles_with_alarm cycles_with_bad_superheat "
    "cycles_with_high_dt avg_dt_spread_k heating_cycles dhw_cycles",
)
ORACLE["get_defrost_analysis"] = _fields(
    f"{SILVER}, {DEFROST} SELECT * FROM defrosts {_recent}",
    "log_date episode_id start_time duration_min outdoor_avg_c bt16_start_c bt16_end_c bt16_avg_c fan_avg_pct freq_avg_hz hp_avg_bar "
    "discharge_avg_c had_non_defrost_alarm",
)
ORACLE["get_dhw_analysis"] = _fields(
    f"{SILVER}, {DHW} SELECT * FROM dhw {_recent}",
    "log_date episode_id start_time duration_min bt6_start_c bt6_end_c bt7_start_c bt7_end_c outdoor_avg_c freq_avg_hz hp_avg_bar "
    "superheat_avg_k heater_duty_pct heater_kwh had_alarm",
)
ORACLE["get_heater_daily"] = _fields(
    f"{SILVER}, {daily_ctes()} SELECT * FROM daily {_recent}",
    "log_date outdoor_min_c outdoor_avg_c heater_duty_pct heater_energy_kwh heater_max_kw delta_t_avg_k dm_avg dm_min",
)
BY_TEMP = (
    f"bytemp AS (SELECT bt1_rounded_c, {avg('calc_supply_c')} AS calc_supply_c, {avg('actual_supply_c')} AS actual_supply_c, "
    f"{avg('return_c')} AS return_c, {avg('delta_t_k')} AS delta_t_k, {avg('dm_avg', n=0)} AS dm_avg, {avg('heater_pct', n=0)} AS heater_pct, "
    f"{avg('freq_avg_hz', n=0)} AS freq_avg_hz, sum(samples) AS samples FROM curve {_recent} GROUP BY 1 HAVING sum(samples) > 50)"
)
ORACLE["get_heater_by_outdoor"] = _fields(f"{SILVER}, {CURVE}, {BY_TEMP} SELECT * FROM bytemp", "bt1_rounded_c heater_pct freq_avg_hz delta_t_k samples")
ORACLE["get_heating_curve"] = _fields(
    f"{SILVER}, {CURVE}, {BY_TEMP} SELECT * FROM bytemp", "bt1_rounded_c calc_supply_c actual_supply_c return_c delta_t_k dm_avg heater_pct samples"
)
ORACLE["heater_analysis_json"] = fin(
    f"{SILVER}, {CURVE}, {BY_TEMP}, days AS (SELECT count(DISTINCT log_date) AS days, min(log_date) AS first_day FROM silver {_recent}) "
    "SELECT days, first_day, (SELECT count(*) FROM bytemp) AS buckets, (SELECT coalesce(sum(samples), 0) FROM bytemp) AS samples FROM days",
    i=["days", "buckets", "samples"], day=["first_day"],
)
ORACLE["get_hourly_detail"] = _fields(
    f"{HOURLY} SELECT * FROM hourly WHERE log_date = DATE '{DAY}'",
    "hour outdoor_avg_c supply_avg_c return_avg_c delta_t_avg_k dm_avg freq_avg_hz compr_duty_pct heater_kwh heater_duty_pct superheat_avg_k "
    "superheat_p10_k superheat_p50_k superheat_p90_k subcooling_avg_k hp_avg_bar discharge_avg_c alarm_samples heating_pct dhw_pct",
)
_score = " + ".join(f"CASE WHEN {c} THEN {p} ELSE 0 END" for c, p in [
    ("had_alarm = 1", 30), ("neg_superheat_pct > 30", 20), ("delta_t_avg_k > 7", 15), ("duration_min < 5", 10), ("hp_max_bar > 28", 10),
    ("discharge_max_c > 95", 10), ("heater_pct > 50", 5)])
ORACLE["get_worst_cycles"] = _fields(
    f"{SILVER}, {CYCLES}, sc AS (SELECT *, {_score} AS problem_score FROM cycles WHERE log_date = DATE '{DAY}'), "
    "rk AS (SELECT *, row_number() OVER (ORDER BY problem_score DESC, cycle_id) AS rn FROM sc) SELECT * FROM rk WHERE rn <= 10",
    "cycle_id start_time duration_min freq_avg_hz delta_t_avg_k superheat_avg_k neg_superheat_pct hp_max_bar discharge_max_c had_alarm "
    "alarm_code heater_pct outdoor_avg_c dominant_mode_name problem_score",
)
_cmp = ("outdoor_avg_c:1 delta_t_avg_k:1 dm_avg:0 compr_duty_pct:1 compr_freq_avg_hz:0 heater_duty_pct:1 neg_superheat_pct:1 superheat_avg_k:1 "
        "hp_avg_bar:1 alarm_pct:1 alarm_excl_183_pct:1 bt1_bt28_avg_divergence_k:1").split()
_cmp_cols = ", ".join(f"{avg(c.split(':')[0], n=int(c.split(':')[1]))} AS {c.split(':')[0]}" for c in _cmp)


def _period(name: str, start: str, end: str) -> str:
    return (
        f"SELECT '{name}' AS period, min(log_date) AS start_date, max(log_date) AS end_date, count(DISTINCT log_date) AS days, {_cmp_cols}, "
        f"{mn('outdoor_min_c')} AS outdoor_min_c, {r('sum(heater_energy_kwh)', 1)} AS heater_total_kwh FROM daily "
        f"WHERE log_date BETWEEN DATE '{start}' AND DATE '{end}'"
    )


ORACLE["get_period_comparison"] = _fields(
    f"{SILVER}, {daily_ctes()}, both_p AS ({_period('period_1', '2024-01-01', '2024-01-10')} UNION ALL {_period('period_2', '2024-01-08', '2024-01-20')}) "
    f"SELECT *, {r('max(outdoor_avg_c) OVER () - min(outdoor_avg_c) OVER ()', 6)} <= 3 AS comparable_weather FROM both_p",
    "period start_date end_date days outdoor_min_c heater_total_kwh comparable_weather " + " ".join(c.split(":")[0] for c in _cmp),
)

# -- reports ----------------------------------------------------------------------------------

ORACLE["pump_kpis"] = fin(
    f"{HOURLY} SELECT count(DISTINCT log_date) AS total_days, {avg('outdoor_avg_c')} AS avg_outdoor_c, {avg('supply_avg_c')} AS avg_supply_c, "
    f"{avg('superheat_avg_k')} AS avg_superheat_k, {avg('delta_t_avg_k')} AS avg_delta_t_k, {avg('compr_duty_pct', n=0)} AS avg_compr_duty, "
    f"{r('sum(heater_kwh)', 0)} AS total_heater_kwh FROM hourly",
    i=["total_days"], d=["avg_outdoor_c", "avg_supply_c", "avg_superheat_k", "avg_delta_t_k", "avg_compr_duty", "total_heater_kwh"],
)
ORACLE["pump_daily_trend"] = fin(
    f"{HOURLY} SELECT log_date, {avg('outdoor_avg_c')} AS outdoor_avg_c, {avg('supply_avg_c')} AS supply_avg_c, "
    f"{avg('superheat_avg_k')} AS superheat_avg_k, {avg('delta_t_avg_k')} AS delta_t_avg_k, {avg('compr_duty_pct', n=0)} AS compr_duty_pct, "
    f"{r('sum(heater_kwh)', 1)} AS heater_kwh_day FROM hourly GROUP BY 1",
    d=["outdoor_avg_c", "supply_avg_c", "superheat_avg_k", "delta_t_avg_k", "compr_duty_pct", "heater_kwh_day"], day=["log_date"],
)
ORACLE["alarm_list"] = _fields(
    f"{SILVER}, {ALARMS} SELECT * FROM alarms", "log_date alarm_number duration_min outdoor_avg_c superheat_avg_k delta_t_avg_k hp_avg_bar discharge_avg_c"
)
_q = "log_date coverage_pct logged_hours max_gap_seconds"
ORACLE["quality_list"] = fin(f"{SILVER}, {QUALITY} SELECT * FROM quality", i=["total_samples", "max_gap_seconds"], d=["coverage_pct", "logged_hours"], day=["log_date"])
_band = f"SELECT freq_band, {avg('delta_t_avg_k')} AS delta_t_avg_k, {avg('heater_pct', n=0)} AS heater_pct, sum(samples) AS samples FROM flow"
ORACLE["flow_by_band"] = _fields(f"{SILVER}, {FLOW} {_band} WHERE log_date >= DATE '{AS_OF}' - 14 GROUP BY 1", "freq_band delta_t_avg_k heater_pct samples")
ORACLE["flow_by_band_fallback"] = _fields(f"{SILVER}, {FLOW} {_band} GROUP BY 1", "freq_band delta_t_avg_k heater_pct samples")
ORACLE["kpi_strip"] = fin(
    f"{SILVER}, {daily_ctes()}, d AS (SELECT *, delta_t_avg_k - lag(delta_t_avg_k) OVER (ORDER BY log_date) AS ch FROM daily "
    f"WHERE log_date >= DATE '{AS_OF}' - 14) SELECT count(*) AS days, avg(outdoor_avg_c) AS outdoor_avg_c, avg(delta_t_avg_k) AS delta_t_avg_k, "
    "sum(heater_energy_kwh) AS heater_total_kwh, avg(neg_superheat_pct) AS neg_superheat_pct, avg(alarm_excl_183_pct) AS alarm_excl_183_pct, "
    "arg_max(ch, log_date) AS delta_t_change_k FROM d",
    i=["days"], d=["outdoor_avg_c", "delta_t_avg_k", "heater_total_kwh", "neg_superheat_pct", "alarm_excl_183_pct", "delta_t_change_k"],
)
_three = ["bt25_supply_c", "bt71_return_c", "compr_freq_act_hz"]
ORACLE["raw_window"] = fin(f"{SILVER} SELECT * FROM silver WHERE log_date = DATE '{DAY}' AND hour(logged_at) = 9", d=_three, ts=["logged_at"])
ORACLE["minute_averages"] = fin(
    f"{SILVER} SELECT date_trunc('minute', logged_at) AS ts, {', '.join(f'{avg(c, n=2)} AS {c}' for c in _three)} FROM silver GROUP BY 1", d=_three, ts=["ts"]
)
ORACLE["latest_quality"] = fin(
    f"{SILVER}, {QUALITY} SELECT * FROM quality ORDER BY log_date DESC LIMIT 1", i=_quality_i, d=["coverage_pct", "logged_hours"], day=["log_date"]
)

# -- single operators on the plain tables --------------------------------------------------------

_error = "event_type = 'error'"
_uw = "OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id)"
_run = "ROWS UNBOUNDED PRECEDING)"
ORACLE["latest_event_per_user"] = fin(
    "SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1",
    i=["event_id", "user_id"], d=["value"], s=["event_type", "props"], ts=["ts"],
)
ORACLE["dedup_events"] = fin(
    "WITH t AS (SELECT *, 1 AS copy FROM events UNION ALL SELECT *, 2 FROM events) SELECT * FROM t "
    "QUALIFY row_number() OVER (PARTITION BY user_id, event_type, value ORDER BY event_id, copy) = 1",
    i=["event_id", "user_id", "copy"], d=["value"], s=["event_type", "props"], ts=["ts"],
)
ORACLE["props_parsed"] = "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events"
ORACLE["error_starts"] = fin(
    f"WITH f AS (SELECT *, {_error} AND NOT coalesce(lag({_error}) {_uw}, false) AS start, "
    f"NOT ({_error}) AND coalesce(lag({_error}) {_uw}, false) AS stop FROM events) "
    f"SELECT *, count(*) FILTER (WHERE start) OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id {_run} AS start_no, "
    f"count(*) FILTER (WHERE stop) OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id {_run} AS stop_no, "
    f"last_value(CASE WHEN stop THEN ts END IGNORE NULLS) OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id {_run} AS stop_at FROM f",
    i=["event_id", "user_id", "start_no", "stop_no"], s=["start", "stop"], ts=["stop_at"],
)
ORACLE["error_runs"] = fin(
    f"WITH f AS (SELECT *, CASE WHEN {_error} AND NOT coalesce(lag({_error}) OVER (PARTITION BY user_id ORDER BY ts, event_id), false) THEN 1 ELSE 0 END AS s FROM events), "
    f"n AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY ts, event_id {_run} AS episode_id FROM f WHERE {_error}) "
    "SELECT user_id, episode_id, min(ts) AS start_time, max(ts) AS end_time, sum(CAST(value AS DECIMAL(18,2))) AS total, arg_min(value, ts) AS first_value, "
    f"arg_max(value, ts) AS last_value, count(*) AS samples, {r('greatest(date_sub(' + chr(39) + 'second' + chr(39) + ', min(ts), max(ts)), 5) / 60', 1)} AS duration_min FROM n GROUP BY 1, 2",
    i=["user_id", "episode_id", "samples"], d=["total", "first_value", "last_value", "duration_min"], ts=["start_time", "end_time"],
)
_g = "date_sub('second', lag(ts) OVER w, ts)"
ORACLE["type_changes"] = fin(
    "WITH c AS (SELECT *, length(event_type) AS code FROM events), f AS (SELECT *, lag(code) OVER w AS prev_code, "
    f"code <> coalesce(lag(code) OVER w, 0) AS change, {_g} AS gap_seconds, "
    f"CASE WHEN {_g} IS NULL THEN 60 WHEN {_g} > 600 THEN 600 ELSE {_g} END AS gap_interval FROM c WINDOW w AS (ORDER BY ts, event_id)) "
    "SELECT *, count(*) FILTER (WHERE change) OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS change_no FROM f",
    i=["event_id", "code", "change_no", "prev_code", "gap_seconds", "gap_interval"], s=["change"],
)
ORACLE["unique_seconds"] = fin(
    "SELECT min(event_id) AS event_id, date_trunc('second', ts) AS second FROM events GROUP BY 2", i=["event_id"], ts=["second"]
)
ORACLE["line_percentiles"] = fin(
    "WITH m AS (SELECT l_returnflag, l_linestatus, CAST(l_quantity AS INT) AS quantity_mode FROM (SELECT l_returnflag, l_linestatus, l_quantity, count(*) AS n "
    "FROM lineitem GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY l_returnflag, l_linestatus ORDER BY n DESC, l_quantity) = 1), "
    "a AS (SELECT l_returnflag, l_linestatus, count(*) AS lines, "
    + ", ".join(f"quantile_disc(l_extendedprice, {p / 100}) AS price_p{p}" for p in (10, 50, 90))
    + ", quantile_disc(l_quantity, 0.9) - quantile_disc(l_quantity, 0.1) AS quantity_spread, count(DISTINCT l_orderkey) AS orders FROM lineitem GROUP BY 1, 2) "
    "SELECT * FROM a JOIN m USING (l_returnflag, l_linestatus)",
    i=["lines", "quantity_mode", "orders"], d=["price_p10", "price_p50", "price_p90", "quantity_spread"], s=["l_returnflag", "l_linestatus"],
)
ORACLE["price_bands"] = fin(
    f"SELECT CASE WHEN l_extendedprice >= 60000 THEN '03_high' WHEN l_extendedprice >= 20000 THEN '02_mid' WHEN l_extendedprice >= 1000 THEN '01_low' END AS price_band, "
    f"{r('l_quantity / 5', 0)} * 5 AS quantity_bin, count(*) AS lines, {r('100.0 * count(*) FILTER (WHERE l_returnflag = ' + chr(39) + 'R' + chr(39) + ') / count(*)', 4)} AS returned_pct "
    "FROM lineitem GROUP BY 1, 2", i=["lines"], d=["quantity_bin", "returned_pct"], s=["price_band"],
)
ORACLE["activity_spine"] = fin(
    "WITH o AS (SELECT o_custkey AS user_id, CAST(o_orderdate AS DATE) AS day, count(*) AS orders, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS spent FROM orders GROUP BY 1, 2), "
    "e AS (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS events FROM events GROUP BY 1, 2), "
    "k AS (SELECT user_id, day FROM o UNION SELECT user_id, day FROM e) "
    "SELECT k.user_id, k.day, coalesce(orders, 0) AS orders, coalesce(spent, 0) AS spent, coalesce(events, 0) AS events FROM k "
    "LEFT JOIN o ON o.user_id = k.user_id AND o.day = k.day LEFT JOIN e ON e.user_id = k.user_id AND e.day = k.day",
    i=["user_id", "orders", "events"], d=["spent"], day=["day"],
)
ORACLE["daily_baseline"] = fin(
    f"WITH d AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n, {r('sum(CAST(value AS DECIMAL(18,2))) / count(*)', 6)} AS mean FROM events GROUP BY 1), "
    f"b AS (SELECT {r('n / 20', 0)} AS bin, quantile_disc(mean, 0.5) AS med FROM d GROUP BY 1) SELECT d.*, mean - med AS residual FROM d LEFT JOIN b ON b.bin = {r('n / 20', 0)}",
    i=["n"], d=["mean", "residual"], day=["day"],
)
ORACLE["order_trend"] = fin(
    "WITH d AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS orders FROM orders GROUP BY 1) SELECT *, "
    "avg(orders) OVER (ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS orders_7, orders - lag(orders) OVER (ORDER BY day) AS change FROM d",
    i=["orders", "change"], d=["orders_7"], day=["day"],
)
ORACLE["warn_rule_counts"] = (
    "SELECT 'customer' AS dataset, 'positive_balance' AS rule, 'warn' AS action, count(*) FILTER (WHERE c_acctbal >= 0) AS passed, "
    "count(*) FILTER (WHERE NOT coalesce(c_acctbal >= 0, false)) AS failed FROM customer UNION ALL "
    "SELECT 'customer', 'known_nation', 'drop', count(*) FILTER (WHERE c_nationkey BETWEEN 0 AND 24), "
    "count(*) FILTER (WHERE NOT coalesce(c_nationkey BETWEEN 0 AND 24, false)) FROM customer"
)
ORACLE["segment_share"] = fin(
    "SELECT c_mktsegment, count(*) AS records, count(*) * 100.0 / (SELECT count(*) FROM customer) AS pct FROM customer GROUP BY 1",
    i=["records"], d=["pct"], s=["c_mktsegment"],
)

# -- JSON files ------------------------------------------------------------------------------------

JSON = (
    "WITH j AS (SELECT " + ", ".join(f"{x} AS {n}" for n, x in feeds.JSON_FIELDS.items())
    + ", concat('/landing/part-', CAST(l_suppkey AS STRING), '.json') AS source_file_name, "
    "concat('part-', CAST(l_suppkey AS STRING), '.json') AS file_name, l_shipdate AS ingestion_timestamp, DATE '2024-01-01' AS ingestion_date FROM lineitem)"
)
_ok = "(_rescued_data IS NULL OR _rescued_data = '')"
_some = "(DOLocationID IS NOT NULL OR PULocationID IS NOT NULL OR fare_amount IS NOT NULL OR total_amount IS NOT NULL)"
ORACLE["json_basic"] = fin(
    f"{JSON} SELECT * FROM j WHERE {_ok}", i=["DOLocationID", "PULocationID"], d=["fare_amount", "total_amount"],
    s=["_rescued_data", "source_file_name", "file_name"], ts=["ingestion_timestamp"], day=["ingestion_date"],
)
ORACLE["json_checked"] = fin(
    f"{JSON} SELECT * FROM j WHERE {_ok} AND {_some}", i=["DOLocationID", "PULocationID"], d=["fare_amount", "total_amount"],
    s=["_rescued_data", "source_file_name", "file_name"], ts=["ingestion_timestamp"], day=["ingestion_date"],
)
ORACLE["file_quality"] = fin(
    f"{JSON} SELECT source_file_name, count(*) AS record_count, count(*) FILTER (WHERE _rescued_data <> '') AS malformed_records, "
    "min(ingestion_timestamp) AS first_ingestion, max(ingestion_timestamp) AS last_ingestion FROM j GROUP BY 1",
    i=["record_count", "malformed_records"], s=["source_file_name"], ts=["first_ingestion", "last_ingestion"],
)
_metrics = (
    f"{JSON}, m AS (SELECT source_file_name, file_name, ingestion_date, count(*) AS total_records, "
    "count(*) FILTER (WHERE _rescued_data <> '') AS malformed_records, min(ingestion_timestamp) AS first_record_timestamp, "
    "max(ingestion_timestamp) AS last_record_timestamp, count(DISTINCT source_file_name) AS files_processed FROM j GROUP BY 1, 2, 3), "
    f"q AS (SELECT *, total_records - malformed_records AS valid_records, {r('(total_records - malformed_records) * 100.0 / total_records', 2)} AS data_quality_percentage FROM m)"
)
_metric_fin = dict(
    i=["total_records", "malformed_records", "valid_records", "files_processed"], d=["data_quality_percentage"], day=["ingestion_date"],
    ts=["first_record_timestamp", "last_record_timestamp"],
)
ORACLE["ingestion_metrics"] = fin(f"{_metrics} SELECT * FROM q", **_metric_fin, s=["source_file_name", "file_name"])
ORACLE["quality_alerts"] = fin(
    f"{_metrics} SELECT *, CASE WHEN data_quality_percentage < 95 THEN 'HIGH' WHEN data_quality_percentage < 99 THEN 'MEDIUM' ELSE 'LOW' END AS alert_severity, "
    "CASE WHEN data_quality_percentage < 95 THEN 'Data quality below 95% - investigate malformed records' "
    "WHEN data_quality_percentage < 99 THEN 'Data quality below 99% - monitor for trends' ELSE 'Data quality acceptable' END AS alert_message "
    "FROM q WHERE data_quality_percentage < 100",
    **_metric_fin, s=["source_file_name", "file_name", "alert_severity", "alert_message"],
)
ORACLE["json_rule_counts"] = (
    f"{JSON} SELECT 'json' AS dataset, 'valid_data' AS rule, 'drop' AS action, count(*) FILTER (WHERE {_ok}) AS passed, "
    f"count(*) FILTER (WHERE NOT {_ok}) AS failed FROM j UNION ALL SELECT 'json', 'non_empty_record', 'drop', "
    f"count(*) FILTER (WHERE {_some}), count(*) FILTER (WHERE NOT {_some}) FROM j"
)


# -- streams: same result as the batch form ---------------------------------------------------------

ORACLE["stream_renamed_voice"] = ORACLE["renamed_voice"]
ORACLE["stream_samples"] = ORACLE["samples"]
ORACLE["stream_users"] = ORACLE["users_latest"]
ORACLE["stream_typed_roaming"] = ORACLE["typed_roaming"]
ORACLE["stream_dedup_sms"] = ORACLE["strict_sms"]
ORACLE["stream_counts_by_topic"] = (
    "SELECT 'telco-data-cdrs' AS _topic, user_id % 3 AS _partition, count(*) AS messages, max(event_id) AS last_offset FROM events GROUP BY 2"
)


# -- JSON of the tools, read back: same rows as typed ----------------------------------------------
for _name in [n for n in ORACLE if n.startswith("get_")]:
    ORACLE[f"{_name}_json"] = ORACLE[_name]

# -- quantiles from stored states: sizes, and that every rank is within its bound -------------------
ORACLE["superheat_of_days"] = fin(
    f"{SILVER} SELECT log_date, count(*) AS n FROM silver WHERE {ON} AND superheat_k IS NOT NULL GROUP BY 1", i=["n"], day=["log_date"],
    x={f"superheat_p{p}_k_ok": "true" for p in (10, 50, 90)},
)
ORACLE["price_quantiles"] = "SELECT l_linestatus, count(*) AS n, true AS p01_ok, true AS p25_ok, true AS p50_ok, true AS p99_ok FROM lineitem GROUP BY 1"

# -- calendar windows ---------------------------------------------------------------------------------
_by = "PARTITION BY o_custkey ORDER BY day"
ORACLE["calendar_windows"] = fin(
    f"SELECT *, avg(spent) OVER ({_by} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS avg_7_rows, "
    f"avg(spent) OVER ({_by} RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW) AS avg_7_days, spent - lag(spent) OVER ({_by}) AS change_rows, "
    f"spent - any_value(spent) OVER ({_by} RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING) AS change_days "
    "FROM (SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, sum(CAST(o_totalprice AS DECIMAL(18,2)))::DOUBLE AS spent FROM orders GROUP BY ALL)",
    i=["o_custkey"], d=["spent", "avg_7_rows", "avg_7_days", "change_rows", "change_days"], day=["day"],
)
ORACLE["calendar_spine"] = fin(
    "WITH rare AS (SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS day, count(*) AS large FROM orders WHERE o_totalprice > 400000 GROUP BY ALL), "
    "sold AS (SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY ALL), "
    "spine AS (SELECT o_orderpriority, CAST(unnest(generate_series(min(day)::TIMESTAMP, max(day)::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS day FROM rare GROUP BY 1) "
    "SELECT o_orderpriority, day, coalesce(large, 0) AS large, coalesce(n, 0) AS n, avg(coalesce(large, 0)) OVER "
    "(PARTITION BY o_orderpriority ORDER BY day RANGE BETWEEN INTERVAL 29 DAYS PRECEDING AND CURRENT ROW) AS large_30 "
    "FROM spine LEFT JOIN rare USING (o_orderpriority, day) LEFT JOIN sold USING (o_orderpriority, day)",
    i=["large", "n"], d=["large_30"], s=["o_orderpriority"], day=["day"],
)
