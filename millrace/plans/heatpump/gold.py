"""Heat-pump summary tables.

Each function takes the sample table and ``keys``: the columns that tell devices apart
(none for a single device).  Ordered work runs through the chunked scan, everything
else is one map-side-combined ``groupBy``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.metrics import Metric, summarise
from millrace.functions.scalars import band, bin_to, elapsed_seconds, rnd
from millrace.functions.sketches import quantile_states, quantiles
from millrace.operators import rules, series
from millrace.operators.episodes import episodes
from millrace.operators.series import Series, falling, gap_interval, gap_seconds, rising, scan
from millrace.operators.summaries import baseline_residual, left_join_all, pivot_band

Keys = tuple[str, ...]
TS = "logged_at"

ON = "compr_freq_act_hz > 0"
HEATING = "compr_freq_act_hz > 0 AND priority_mode = 30"
IDLE = "compr_freq_act_hz = 0 AND tot_int_add_kw = 0 AND priority_mode = 10"
SUBCOOLING = "bt12_condenser_c - bt15_liquid_c"
ACTIONABLE = "alarm_active AND alarm_number != 183"

DAY_SAMPLES = 17_280  # one sample every 5 s
SHORT_OFF_SECONDS = 300
MIN_CYCLE_SAMPLES = 6

# Lower edge and name of the compressor frequency bands.
FREQ_BANDS = [(1, "01_low_1-39Hz"), (40, "02_mid_40-69Hz"), (70, "03_high_70-99Hz"), (100, "04_max_100+Hz")]


TIE = "_tie"
CONTENT = "_content"  # a sample's content digest, where the table stores it


def day_series(keys: Keys, count_keys: Keys | None = None) -> Series:
    """A device's samples of a day; of several at one instant the first by file and content counts."""
    return Series((*keys, "log_date"), TS, (TIE,), count_keys=count_keys, unique=True)


# Columns that follow from the others: they cannot tell samples apart and need not be read for it.
DERIVED = set(
    "mode_name heater_stage supply_deviation_k delta_t_k superheat_k discharge_superheat_k bt1_bt28_divergence_k negative_superheat "
    "compr_running alarm_active defrost_active source_file ingested_at".split()
)


def content(samples: DataFrame):
    """Digest of a sample.  Stored with the samples, it spares every ordered table the reading of all their columns."""
    return F.col(CONTENT) if CONTENT in samples.columns else F.xxhash64(*[c for c in samples.columns if c not in DERIVED])


def tie_order(samples: DataFrame):
    """Total order of samples at one instant: file, then content.  Independent of arrival."""
    return F.struct("source_filename", content(samples))


def by_day(samples: DataFrame) -> DataFrame:
    return samples.withColumnRenamed("log_date_parsed", "log_date")


def ordered(samples: DataFrame) -> DataFrame:
    """By day, with the tie order that scans need."""
    return by_day(samples.withColumn(TIE, tie_order(samples)))


def running(get):
    return get("compr_freq_act_hz") > 0


def defrosting(get):
    return get("defrost_active")


def hot_water(get):
    return get("priority_mode") == 20


# -- per sample ---------------------------------------------------------------

# Columns of the alarm-sample and current-state tables.
ALARM_COLUMNS = (
    "alarm_number bt1_outdoor_temp_c bt25_supply_c calc_supply_c supply_deviation_k compr_state compr_freq_act_hz "
    "compr_protection_mode bt3_return_cond_c bt16_evap_c bt17_suction_c superheat_k bp4_hp_bar lp_raw bt6_dhw_top_c "
    "bt7_dhw_charge_c degree_minutes priority_mode source_filename ingested_at"
).split()
CURRENT_COLUMNS = (
    "logged_at log_date_parsed sw_version bt1_outdoor_temp_c bt71_return_c bt6_dhw_top_c bt25_supply_c calc_supply_c "
    "supply_deviation_k compr_state compr_running compr_freq_act_hz compr_protection_mode bt3_return_cond_c bt16_evap_c "
    "bt17_suction_c superheat_k bp4_hp_bar lp_raw degree_minutes priority_mode tot_int_add_kw alarm_number alarm_active "
    "source_filename"
).split()


def alarm_events(samples: DataFrame, keys: Keys = ()) -> DataFrame:
    return samples.filter("alarm_active").select(*keys, F.col(TS).alias("alarm_start"), *ALARM_COLUMNS)


def current_state(samples: DataFrame, keys: Keys = ()) -> DataFrame:
    picked = samples.select(*keys, *CURRENT_COLUMNS, tie_order(samples).alias(TIE))
    return series.latest(picked, [*keys, "log_date_parsed"], [TS, F.col(TIE).asc()]).drop(TIE)


# -- per hour -----------------------------------------------------------------

# Output columns, conditions and digits.
HOURLY_STATS = [
    Metric("sample_count", "count"),
    *[Metric(f"{how}_{short}", how, col) for col, short, hows in [
        ("bt1_outdoor_temp_c", "outdoor_temp_c", "avg min max"),
        ("bt71_return_c", "return_c", "avg min max"),
        ("bt6_dhw_top_c", "hw_top_c", "avg min"),
        ("bt7_dhw_charge_c", "hw_charge_c", "max"),
        ("bt25_supply_c", "supply_c", "avg"),
        ("calc_supply_c", "calc_supply_c", "avg"),
        ("supply_deviation_k", "supply_deviation_k", "avg"),
        ("compr_freq_act_hz", "compr_freq_hz", "avg max"),
        ("degree_minutes", "degree_minutes", "avg min"),
        ("bt3_return_cond_c", "return_cond_c", "avg max"),
        ("bt16_evap_c", "evap_c", "avg"),
        ("superheat_k", "superheat_k", "avg min max"),
        ("discharge_superheat_k", "discharge_superheat_k", "avg"),
        ("bp4_hp_bar", "hp_bar", "avg max"),
        ("lp_raw", "lp_raw", "avg"),
        ("gp12_fan_pct", "gp12_fan_pct", "avg"),
        ("tot_int_add_kw", "tot_int_add_kw", "max"),
    ] for how in hows.split()],
    Metric("stddev_supply_deviation_k", "std", "supply_deviation_k"),
    Metric("stddev_superheat_k", "std", "superheat_k"),
    Metric("compr_running_fraction", "avg", "cast(compr_running as int)"),
    Metric("min_running_compr_freq_hz", "min", "compr_freq_act_hz", when="compr_running"),
    Metric("protection_mode_samples", "sum", "compr_protection_mode"),
    Metric("gp10_circ_pump_fraction", "avg", "cast(gp10_circ_pump_on as int)"),
    Metric("had_alarm", "max", "cast(alarm_active as int)"),
    Metric("alarm_codes", "set", "alarm_number"),
]


def hourly_stats(samples: DataFrame, keys: Keys = ()) -> DataFrame:
    hour = F.date_trunc("hour", F.col(TS)).cast("timestamp_ntz").alias("hour_start")
    return summarise(samples, [*keys, hour, "sw_version"], HOURLY_STATS)


# Output columns, conditions and digits.
HOURLY_DETAIL = [
    Metric("outdoor_avg_c", "avg", "bt1_outdoor_temp_c", digits=1),
    Metric("outdoor_min_c", "min", "bt1_outdoor_temp_c", digits=1),
    Metric("supply_avg_c", "avg", "bt25_supply_c", digits=1),
    Metric("return_avg_c", "avg", "bt71_return_c", digits=1),
    Metric("calc_supply_avg_c", "avg", "calc_supply_c", digits=1),
    Metric("delta_t_avg_k", "avg", "delta_t_k", ON, 1),
    Metric("dm_avg", "avg", "degree_minutes", digits=0),
    Metric("dm_min", "min", "degree_minutes", digits=0),
    Metric("freq_avg_hz", "avg", "compr_freq_act_hz", ON, 0),
    Metric("compr_duty_pct", "pct", ON, digits=0),
    Metric("heater_kwh", "sum", "tot_int_add_kw * gap_interval / 3600D", digits=2),
    Metric("heater_duty_pct", "pct", "tot_int_add_kw > 0", digits=0),
    Metric("superheat_avg_k", "avg", "superheat_k", ON, 1),
    Metric("superheat_p10_k", "quantile", "superheat_k", ON, 1, p=0.1),
    Metric("superheat_p50_k", "quantile", "superheat_k", ON, 1, p=0.5),
    Metric("superheat_p90_k", "quantile", "superheat_k", ON, 1, p=0.9),
    Metric("subcooling_avg_k", "avg", SUBCOOLING, ON, 1),
    Metric("subcooling_min_k", "min", SUBCOOLING, ON, 1),
    Metric("hp_avg_bar", "avg", "bp4_hp_bar", ON, 1),
    Metric("discharge_avg_c", "avg", "bt14_discharge_c", ON, 1),
    Metric("alarm_samples", "count", when="alarm_active"),
    Metric("bt1_bt28_avg_divergence_k", "avg", "bt1_bt28_divergence_k", digits=1),
    Metric("dhw_avg_c", "avg", "bt6_dhw_top_c", digits=1),
    Metric("heating_pct", "pct", "priority_mode = 30", digits=0),
    Metric("dhw_pct", "pct", "priority_mode = 20", digits=0),
    Metric("samples", "count"),
]


def hourly_detail(samples: DataFrame, keys: Keys = ()) -> DataFrame:
    rows = series.with_gap(ordered(samples), day_series(keys))
    return summarise(rows, [*keys, "log_date", F.hour(TS).alias("hour")], HOURLY_DETAIL)


# The quantiles of hourly_detail.
SUPERHEAT_RANKS = {"superheat_p10_k": 0.1, "superheat_p50_k": 0.5, "superheat_p90_k": 0.9}


def superheat_states(samples: DataFrame, keys: Keys = ()) -> DataFrame:
    """Superheat of the running compressor: a mergeable state per hour, to be stored."""
    return quantile_states(by_day(samples), [*keys, "log_date", F.hour(TS).alias("hour")], "superheat_k", ON)


def superheat_quantiles(states: DataFrame, by: Sequence[str]) -> DataFrame:
    """Quantiles per day, month, device ... from the states of hours; ``hourly_detail`` has the exact ones of an hour."""
    return quantiles(states, by, SUPERHEAT_RANKS)


# -- per day ------------------------------------------------------------------

# Output columns, conditions and digits.
DAILY = [
    Metric("outdoor_min_c", "min", "bt1_outdoor_temp_c", digits=1),
    Metric("outdoor_max_c", "max", "bt1_outdoor_temp_c", digits=1),
    Metric("outdoor_avg_c", "avg", "bt1_outdoor_temp_c", digits=1),
    Metric("supply_avg_c", "avg", "bt25_supply_c", HEATING, 1),
    Metric("return_avg_c", "avg", "bt71_return_c", HEATING, 1),
    Metric("delta_t_avg_k", "avg", "delta_t_k", HEATING, 1),
    Metric("delta_t_max_k", "max", "delta_t_k", ON, 1),
    Metric("calc_supply_avg_c", "avg", "calc_supply_c", "priority_mode = 30", 1),
    Metric("supply_vs_calc_offset_k", "avg", "bt25_supply_c - calc_supply_c", HEATING, 1),
    Metric("dm_avg", "avg", "degree_minutes", digits=0),
    Metric("dm_min", "min", "degree_minutes"),
    Metric("dm_max", "max", "degree_minutes"),
    Metric("compr_duty_pct", "pct", ON, digits=1),
    Metric("compr_freq_avg_hz", "avg", "compr_freq_act_hz", ON, 0),
    Metric("compr_freq_max_hz", "max", "compr_freq_act_hz", digits=0),
    Metric("compr_running_hours", "sum", f"CASE WHEN {ON} THEN gap_interval ELSE 0 END / 3600D", digits=1),
    Metric("total_hours", "sum", "gap_interval / 3600D", digits=1),
    Metric("heater_duty_pct", "pct", "tot_int_add_kw > 0", digits=1),
    Metric("heater_energy_kwh", "sum", "tot_int_add_kw * gap_interval / 3600D", digits=1),
    Metric("heater_max_kw", "max", "tot_int_add_kw"),
    Metric("superheat_avg_k", "avg", "superheat_k", ON, 1),
    Metric("superheat_min_k", "min", "superheat_k", ON, 1),
    Metric("neg_superheat_pct", "pct", "negative_superheat", of=ON, digits=1),
    Metric("hp_avg_bar", "avg", "bp4_hp_bar", ON, 1),
    Metric("hp_max_bar", "max", "bp4_hp_bar", digits=1),
    Metric("lp_avg_raw", "avg", "lp_raw", ON, 1),
    Metric("discharge_avg_c", "avg", "bt14_discharge_c", ON, 1),
    Metric("discharge_max_c", "max", "bt14_discharge_c", digits=1),
    Metric("alarm_samples", "count", when="alarm_active"),
    Metric("alarm_pct", "pct", "alarm_active", digits=1),
    Metric("alarm_excl_183_pct", "pct", ACTIONABLE, digits=1),
    Metric("defrost_samples", "count", when="defrost_active"),
    Metric("bt1_bt28_avg_divergence_k", "avg", "bt1_bt28_divergence_k", digits=1),
    Metric("bt1_bt28_max_divergence_k", "max", "bt1_bt28_divergence_k", digits=1),
    Metric("heating_pct", "pct", "priority_mode = 30", digits=0),
    Metric("dhw_pct", "pct", "priority_mode = 20", digits=0),
    Metric("dhw_avg_c", "avg", "bt6_dhw_top_c", digits=1),
    Metric("dhw_min_c", "min", "bt6_dhw_top_c", digits=1),
    Metric("subcooling_avg_k", "avg", SUBCOOLING, ON, 1),
    Metric("subcooling_min_k", "min", SUBCOOLING, ON, 1),
    Metric("standby_circ_pump_pct", "pct", f"{IDLE} AND gp10_circ_pump_on", of=IDLE, digits=1),
    Metric("standby_fan_avg_pct", "avg", "gp12_fan_pct", IDLE, 1),
    Metric("bt1_vs_avg_divergence_k", "avg", "abs(bt1_outdoor_temp_c - bt1_average_c)", digits=1),
    Metric("total_samples", "count"),
    Metric("compr_starts", "count", when="start"),
    Metric("defrost_cycles", "count", when="defrost_start"),
    Metric("short_cycle_count", "count", when=f"start AND off_seconds < {SHORT_OFF_SECONDS}"),
]


def daily_summary(samples: DataFrame, keys: Keys = ()) -> DataFrame:
    """One row per day.  Gaps, compressor starts, defrost starts and short cycles all come
    from a single scan, and all numbers from a single aggregation; the list of alarm codes
    is made from the alarm samples alone."""
    s, on = day_series(keys), [*keys, "log_date"]
    first = F.min_by(F.struct("alarm_active", "alarm_number"), TIE).alias("a")
    codes = (
        ordered(samples).groupBy(*on, TS).agg(first).select(*on, "a.*")
        .filter("alarm_active AND alarm_number > 0").select(*on, "alarm_number").distinct()
        .groupBy(*on).agg(F.sort_array(F.collect_set("alarm_number")).alias("alarm_codes"))
    )
    rows = scan(
        ordered(samples), s, ["compr_freq_act_hz", "defrost_active"],
        {"start": rising(running), "stop": falling(running), "defrost_start": rising(defrosting)},
    )
    rows = rows.withColumns({
        "gap_interval": gap_interval(s),
        # how long the compressor had been off, if it stopped earlier the same day
        "off_seconds": elapsed_seconds("stop_at", TS),
    })
    days = summarise(rows, on, DAILY).join(codes, on, "left")
    return days.withColumn("alarm_codes", F.coalesce("alarm_codes", F.array().cast("array<int>")))


# Output columns, conditions and digits.
FLOW = [
    Metric("delta_t_avg_k", "avg", "delta_t_k", digits=1),
    Metric("delta_t_max_k", "max", "delta_t_k", digits=1),
    Metric("hp_avg_bar", "avg", "bp4_hp_bar", digits=1),
    Metric("discharge_avg_c", "avg", "bt14_discharge_c", digits=1),
    Metric("superheat_avg_k", "avg", "superheat_k", digits=1),
    Metric("heater_pct", "pct", "tot_int_add_kw > 0", digits=0),
    Metric("samples", "count"),
]


def flow_quality(samples: DataFrame, keys: Keys = ()) -> DataFrame:
    rows = by_day(samples).filter(HEATING)
    return summarise(rows, [*keys, "log_date", band("compr_freq_act_hz", FREQ_BANDS).alias("freq_band")], FLOW)


# Output columns, conditions and digits.
CURVE = [
    Metric("calc_supply_c", "avg", "calc_supply_c", digits=1),
    Metric("actual_supply_c", "avg", "bt25_supply_c", digits=1),
    Metric("return_c", "avg", "bt71_return_c", digits=1),
    Metric("delta_t_k", "avg", "delta_t_k", digits=1),
    Metric("dm_avg", "avg", "degree_minutes", digits=0),
    Metric("freq_avg_hz", "avg", "compr_freq_act_hz", digits=0),
    Metric("heater_pct", "pct", "tot_int_add_kw > 0", digits=0),
    Metric("hp_avg_bar", "avg", "bp4_hp_bar", digits=1),
    Metric("samples", "count"),
]


def heating_curve(samples: DataFrame, keys: Keys = (), more_than: int = 20) -> DataFrame:
    rows = by_day(samples).filter(HEATING)
    grouped = summarise(rows, [*keys, "log_date", bin_to("bt1_outdoor_temp_c").alias("bt1_rounded_c")], CURVE)
    return grouped.filter(F.col("samples") > more_than)


# Output columns, conditions and digits.
QUALITY = [
    Metric("total_samples", "count"),
    Metric("null_bt1", "count", when="bt1_outdoor_temp_c IS NULL"),
    Metric("null_bt25", "count", when="bt25_supply_c IS NULL"),
    Metric("null_freq", "count", when="compr_freq_act_hz IS NULL"),
    Metric("null_hp", "count", when="bp4_hp_bar IS NULL"),
    Metric("null_bt16", "count", when="bt16_evap_c IS NULL"),
    Metric("max_gap_seconds", "max", "gap_seconds"),
    Metric("gaps_over_60s", "count", when="gap_seconds > 60"),
    Metric("gaps_over_600s", "count", when="gap_seconds > 600"),
]


def data_quality(samples: DataFrame, keys: Keys = ()) -> DataFrame:
    s = day_series(keys)
    rows = scan(ordered(samples), s).withColumn("gap_seconds", gap_seconds(s))
    n = F.col("total_samples")
    return summarise(rows, [*keys, "log_date"], QUALITY).withColumns({
        "coverage_pct": rnd(n * F.lit(100.0) / F.lit(DAY_SAMPLES), 1),
        "logged_hours": rnd(n * F.lit(5.0) / F.lit(3600), 1),
    })


# -- episodes -----------------------------------------------------------------

def alarm_episodes(samples: DataFrame, keys: Keys = ()) -> DataFrame:
    """Runs of one alarm code within a day; a change of code starts a new run."""
    rows = ordered(samples).withColumn("_code", F.expr("CASE WHEN alarm_active THEN alarm_number ELSE 0 END"))
    return episodes(
        rows, day_series(keys), series.changed("_code", "_code > 0"), "alarm_active", ["_code"],
        [
            Metric("outdoor_avg_c", "avg", "bt1_outdoor_temp_c", digits=1),
            Metric("freq_avg_hz", "avg", "compr_freq_act_hz", digits=0),
            Metric("hp_avg_bar", "avg", "bp4_hp_bar", digits=1),
            Metric("discharge_avg_c", "avg", "bt14_discharge_c", digits=1),
            Metric("superheat_avg_k", "avg", "superheat_k", digits=1),
            Metric("delta_t_avg_k", "avg", "delta_t_k", digits=1),
            Metric("heater_avg_kw", "avg", "tot_int_add_kw", digits=1),
            Metric("dm_avg", "avg", "degree_minutes", digits=0),
            Metric("bt1_bt28_divergence_k", "avg", "bt1_bt28_divergence_k", digits=1),
        ],
        also_by=["alarm_number"],
    )


def defrost_cycles(samples: DataFrame, keys: Keys = ()) -> DataFrame:
    return episodes(
        ordered(samples), day_series(keys), rising(defrosting), "defrost_active", ["defrost_active"],
        [
            Metric("outdoor_avg_c", "avg", "bt1_outdoor_temp_c", digits=1),
            Metric("outdoor_min_c", "min", "bt1_outdoor_temp_c", digits=1),
            Metric("bt16_start_c", "first", "bt16_evap_c", by=TS, digits=1),
            Metric("bt16_end_c", "last", "bt16_evap_c", by=TS, digits=1),
            Metric("bt16_avg_c", "avg", "bt16_evap_c", digits=1),
            Metric("fan_avg_pct", "avg", "gp12_fan_pct", digits=0),
            Metric("freq_avg_hz", "avg", "compr_freq_act_hz", digits=0),
            Metric("hp_avg_bar", "avg", "bp4_hp_bar", digits=1),
            Metric("discharge_avg_c", "avg", "bt14_discharge_c", digits=1),
            Metric("had_non_defrost_alarm", "any", ACTIONABLE),
        ],
    )


def dhw_cycles(samples: DataFrame, keys: Keys = ()) -> DataFrame:
    ends = [
        Metric(f"{short}_{where}_c", how, col, by=TS, digits=1)
        for short, col in (("bt6", "bt6_dhw_top_c"), ("bt7", "bt7_dhw_charge_c"))
        for where, how in (("start", "first"), ("end", "last"))
    ]
    return episodes(
        ordered(samples), day_series(keys), rising(hot_water), "priority_mode = 20", ["priority_mode"],
        [
            *ends,
            Metric("outdoor_avg_c", "avg", "bt1_outdoor_temp_c", digits=1),
            Metric("freq_avg_hz", "avg", "compr_freq_act_hz", digits=0),
            Metric("hp_avg_bar", "avg", "bp4_hp_bar", digits=1),
            Metric("superheat_avg_k", "avg", "superheat_k", digits=1),
            Metric("heater_duty_pct", "pct", "tot_int_add_kw > 0", digits=0),
            Metric("heater_kwh", "sum", "tot_int_add_kw * 5D / 3600D", digits=2),
            Metric("had_alarm", "any", "alarm_active"),
        ],
    )


# Output columns, conditions and digits.
CYCLE = [
    Metric("freq_avg_hz", "avg", "compr_freq_act_hz", digits=0),
    Metric("freq_max_hz", "max", "compr_freq_act_hz", digits=0),
    Metric("freq_stddev", "std", "compr_freq_act_hz", digits=1),
    Metric("dominant_mode", "mode", "priority_mode"),
    Metric("dominant_mode_name", "mode", "mode_name"),
    Metric("delta_t_avg_k", "avg", "delta_t_k", digits=1),
    Metric("delta_t_max_k", "max", "delta_t_k", digits=1),
    Metric("delta_t_spread_k", "spread", "delta_t_k", p=0.9, digits=1),
    Metric("superheat_avg_k", "avg", "superheat_k", digits=1),
    Metric("superheat_min_k", "min", "superheat_k", digits=1),
    Metric("neg_superheat_pct", "pct", "negative_superheat", digits=0),
    Metric("hp_avg_bar", "avg", "bp4_hp_bar", digits=1),
    Metric("hp_max_bar", "max", "bp4_hp_bar", digits=1),
    Metric("discharge_avg_c", "avg", "bt14_discharge_c", digits=1),
    Metric("discharge_max_c", "max", "bt14_discharge_c", digits=1),
    Metric("outdoor_avg_c", "avg", "bt1_outdoor_temp_c", digits=1),
    Metric("supply_avg_c", "avg", "bt25_supply_c", digits=1),
    Metric("return_avg_c", "avg", "bt71_return_c", digits=1),
    Metric("heater_pct", "pct", "tot_int_add_kw > 0", digits=0),
    Metric("had_alarm", "any", "alarm_active"),
    Metric("alarm_code", "max", "alarm_number", "alarm_active"),
    Metric("dm_at_start", "first", "degree_minutes", by=TS),
    Metric("dm_at_end", "last", "degree_minutes", by=TS),
    Metric("bt1_bt28_avg_divergence_k", "avg", "bt1_bt28_divergence_k", digits=1),
]


def cycles(samples: DataFrame, keys: Keys = ()) -> DataFrame:
    """Compressor runs, numbered over all days.  A run that crosses midnight is two runs."""
    return episodes(
        ordered(samples).filter("compr_freq_act_hz IS NOT NULL"), day_series(keys, keys),
        rising(running), ON, ["compr_freq_act_hz"], CYCLE,
        number="cycle_id", min_rows=MIN_CYCLE_SAMPLES, floor_seconds=None,
    )


# Output columns, conditions and digits.
CYCLE_SUMMARY = [
    Metric("total_cycles", "count"),
    Metric("avg_cycle_min", "avg", "duration_min", digits=1),
    Metric("min_cycle_min", "min", "duration_min", digits=1),
    Metric("max_cycle_min", "max", "duration_min", digits=1),
    Metric("median_cycle_min", "quantile", "duration_min", digits=1),
    Metric("short_cycles", "count", when="duration_min < 5"),
    Metric("short_cycle_pct", "pct", "duration_min < 5", digits=0),
    Metric("avg_freq_volatility", "avg", "freq_stddev", digits=1),
    Metric("cycles_with_alarm", "sum", "had_alarm"),
    Metric("cycles_with_bad_superheat", "count", when="neg_superheat_pct > 30"),
    Metric("cycles_with_high_dt", "count", when="delta_t_max_k > 7"),
    Metric("avg_dt_spread_k", "avg", "delta_t_spread_k", digits=1),
    Metric("heating_cycles", "count", when="dominant_mode = 30"),
    Metric("dhw_cycles", "count", when="dominant_mode = 20"),
    Metric("_from", "min", "start_time"),
    Metric("_to", "max", "end_time"),
]


def cycle_summary(cycle_rows: DataFrame, keys: Keys = ()) -> DataFrame:
    hours = F.greatest(F.timestamp_diff("HOUR", F.col("_from"), F.col("_to")), F.lit(1))
    return (
        summarise(cycle_rows, [*keys, "log_date"], CYCLE_SUMMARY)
        .withColumn("cycles_per_day", rnd(F.col("total_cycles") * F.lit(24.0) / hours, 1))
        .drop("_from", "_to")
    )


# -- features and rules ---------------------------------------------------------

# Columns taken over from the daily tables.
FROM_DAILY = (
    "outdoor_avg_c outdoor_min_c delta_t_avg_k dm_avg dm_min compr_duty_pct compr_freq_avg_hz heater_duty_pct "
    "heater_energy_kwh neg_superheat_pct superheat_avg_k hp_avg_bar discharge_max_c alarm_pct alarm_excl_183_pct "
    "bt1_bt28_max_divergence_k supply_vs_calc_offset_k"
).split()
FROM_CYCLES = (
    "total_cycles cycles_per_day avg_cycle_min short_cycle_pct avg_freq_volatility cycles_with_alarm "
    "cycles_with_bad_superheat avg_dt_spread_k"
).split()
TREND = {"delta_t_avg_k": "delta_t_7d_avg", "neg_superheat_pct": "neg_sh_7d_avg", "heater_energy_kwh": "heater_kwh_7d_avg"}
CHANGE = {"delta_t_avg_k": "delta_t_dod_change", "neg_superheat_pct": "neg_sh_dod_change"}
RESIDUAL = {"delta_t_avg_k": "dt_residual_k", "heater_duty_pct": "heater_residual_pct"}


def ml_features(
    daily: DataFrame, flow: DataFrame, curve: DataFrame, cycle_days: DataFrame, quality: DataFrame, keys: Keys = ()
) -> DataFrame:
    """Day features.  All inputs have one row per day (and band), so they are small next to
    the samples; write them as tables first when samples are large."""
    on = [*keys, "log_date"]
    bands = pivot_band(flow, on, "freq_band", {
        "dt_at_max_freq_k": (FREQ_BANDS[3][1], "delta_t_avg_k"),
        "heater_at_max_freq_pct": (FREQ_BANDS[3][1], "heater_pct"),
        "_dt_low": (FREQ_BANDS[0][1], "delta_t_avg_k"),
    })
    mild = summarise(curve.filter("bt1_rounded_c > -10"), on, [
        Metric("_heated", "sum", "CASE WHEN heater_pct > 0 THEN samples ELSE 0 END"),
        Metric("_all", "sum", "samples"),
    ]).select(*on, rnd(F.col("_heated") * F.lit(100.0) / F.col("_all"), 0).alias("heater_pct_above_minus10"))
    base = daily.select(*on, *FROM_DAILY)
    base = baseline_residual(base, RESIDUAL, "outdoor_avg_c", 2.0, keys)
    base = series.moving_avg(base, TREND, keys, "log_date", 7)
    base = series.delta(base, CHANGE, keys, "log_date")
    joined = left_join_all(base, [
        bands, mild, cycle_days.select(*on, *FROM_CYCLES), quality.select(*on, "coverage_pct", "max_gap_seconds"),
    ], on)
    gradient = F.coalesce("dt_at_max_freq_k", F.lit(0.0)) - F.coalesce("_dt_low", F.lit(0.0))
    return joined.withColumn("dt_freq_gradient_k", gradient).drop("_dt_low")


L, R = rules.Level, rules.Rule

# Thresholds, points and texts of the anomaly rules.
HOT_HEATER = "heater_duty_pct > 10 AND outdoor_avg_c > -10"
MILD_HEATER = "heater_duty_pct > 0 AND outdoor_avg_c > -10"
ANOMALY_RULES = [
    R("flow_status", (L("delta_t_avg_k > 7", "CRITICAL", 30), L("delta_t_avg_k > 5", "WARNING", 15))),
    R("superheat_status", (
        L("neg_superheat_pct > 30", "CRITICAL", 25),
        L("neg_superheat_pct > 15", "WARNING", 10),
        L("neg_superheat_pct > 5", "MONITOR"),
    )),
    R("heater_status", (
        L(HOT_HEATER, "CRITICAL", 20), L(MILD_HEATER, "WARNING", 10), L("heater_duty_pct > 20", "WARNING"),
    )),
    R("demand_status", (L("dm_min < -520", "CRITICAL", 15), L("dm_min < -400", "WARNING", 5))),
    R("alarm_status", (L("alarm_excl_183_pct > 15", "CRITICAL", 10), L("alarm_excl_183_pct > 5", "WARNING", 5))),
    R("discharge_status", (L("discharge_max_c > 100", "CRITICAL", 10), L("discharge_max_c > 90", "WARNING"))),
    R("wind_snow_status", (L("bt1_bt28_max_divergence_k > 5", "WARNING", 5),)),
    R("cycling_status", (L("short_cycle_pct > 20", "WARNING", 5),)),
    R("data_quality_status", (L("coverage_pct < 80", "WARNING"),)),
]
OVERALL = [
    (
        f"delta_t_avg_k > 7 OR neg_superheat_pct > 30 OR dm_min < -520 OR ({HOT_HEATER}) "
        "OR discharge_max_c > 100 OR alarm_excl_183_pct > 15",
        "🔴 CRITICAL",
    ),
    (
        "delta_t_avg_k > 5 OR neg_superheat_pct > 15 OR dm_min < -400 OR alarm_excl_183_pct > 5 "
        "OR heater_duty_pct > 20 OR discharge_max_c > 90",
        "🟡 WARNING",
    ),
]
OVERALL_OK = "🟢 OK"
REASONS = [
    ("delta_t_avg_k > 7", "Critical flow restriction — ΔT {delta_t_avg_k}K at high load"),
    ("neg_superheat_pct > 30", "Compressor at risk — negative superheat {neg_superheat_pct}% of runtime"),
    (HOT_HEATER, "Heater running {heater_duty_pct}% at {outdoor_avg_c}°C — possible flow or curve issue"),
    ("dm_min < -520", "DM saturated at {dm_min} — system cannot meet demand"),
    ("discharge_max_c > 100", "High discharge temp {discharge_max_c}°C — compressor stress"),
    ("alarm_excl_183_pct > 5", "Actionable alarms present {alarm_excl_183_pct}% of time (excl. defrost)"),
    ("delta_t_avg_k > 5", "Flow below optimal — ΔT {delta_t_avg_k}K"),
    ("neg_superheat_pct > 15", "Superheat declining — {neg_superheat_pct}% negative, monitor trend"),
]
REASON_OK = "System operating within normal parameters"


def anomaly_rules(features: DataFrame, keys: Keys = ()) -> DataFrame:
    return rules.score(
        features, ANOMALY_RULES, OVERALL, OVERALL_OK, REASONS, REASON_OK, [*keys, "log_date"]
    )


# Further thresholds of the diagnosis guide, on day and episode tables.
EXTENDED_RULES = [
    R("subcooling_status", (L("subcooling_avg_k < 2 OR subcooling_avg_k > 10", "WARNING"),)),
    R("defrost_count_status", (L("defrost_cycles > 20", "CRITICAL"), L("defrost_cycles > 15", "WARNING"))),
    R("defrost_duration_status", (L("defrost_avg_min > 12", "CRITICAL"), L("defrost_avg_min > 8", "WARNING"))),
    R("dhw_end_temp_status", (L("dhw_min_end_c < 42", "CRITICAL"), L("dhw_min_end_c < 48", "WARNING"))),
    R("dhw_duration_status", (L("dhw_max_min > 60", "WARNING"),)),
    R("sensor_drift_status", (L("bt1_vs_avg_divergence_k > 2", "WARNING"),)),
    R("standby_pump_status", (L("standby_circ_pump_pct > 10", "WARNING"),)),
]


def extended_rules(daily: DataFrame, defrosts: DataFrame, hot_water_runs: DataFrame, keys: Keys = ()) -> DataFrame:
    on = [*keys, "log_date"]
    joined = left_join_all(
        daily.select(*on, "subcooling_avg_k", "defrost_cycles", "bt1_vs_avg_divergence_k", "standby_circ_pump_pct"),
        [
            summarise(defrosts, on, [Metric("defrost_avg_min", "avg", "duration_min", digits=1)]),
            summarise(hot_water_runs, on, [
                Metric("dhw_min_end_c", "min", "bt6_end_c"), Metric("dhw_max_min", "max", "duration_min"),
            ]),
        ],
        on,
    )
    return joined.withColumns({r.name: r.status() for r in EXTENDED_RULES})


# Known alarm codes, ranges included (first, last, description, severity).
ALARM_CODES = [
    (162, 162, "High discharge temp", "CRITICAL"),
    (163, 163, "High condenser inlet temp", "CRITICAL"),
    (183, 183, "Defrost in progress", "INFO"),
    (220, 220, "High pressure (HP) alarm", "CRITICAL"),
    (221, 221, "Low pressure (LP) alarm", "CRITICAL"),
    (223, 223, "Communication error MZ", "WARNING"),
    (224, 224, "Fan alarm", "WARNING"),
    (230, 230, "Continuous high hot gas temp", "CRITICAL"),
    (254, 254, "Communication error", "WARNING"),
    (261, 261, "High heat exchanger temp", "CRITICAL"),
    (262, 268, "Inverter / power transistor errors", "CRITICAL"),
    (271, 271, "Cold outdoor air", "WARNING"),
    (272, 272, "Hot outdoor air", "WARNING"),
    (277, 281, "Sensor fault", "WARNING"),
    (294, 294, "Incompatible outdoor unit", "CRITICAL"),
]


def explain_alarms(alarm_rows: DataFrame) -> DataFrame:
    """Description and severity per alarm code; unknown codes stay, with NULLs.

    The dimension has a few dozen fixed rows, so broadcasting it is safe at any scale.
    """
    spark = alarm_rows.sparkSession
    codes = [(n, text, sev) for lo, hi, text, sev in ALARM_CODES for n in range(lo, hi + 1)]
    dim = spark.createDataFrame(codes, "alarm_number int, description string, severity string")
    return alarm_rows.join(F.broadcast(dim), "alarm_number", "left")


A = rules.Alert

# The six daily alerts.
ALERTS = [
    A("high_delta_t", "daily_summary", "delta_t_avg_k > 6", "delta_t_avg_k", "max", True, 6.0),
    A("negative_superheat", "daily_summary", "neg_superheat_pct > 20", "neg_superheat_pct", "max", True, 20.0),
    A("heater_mild_temp", "daily_summary", "heater_duty_pct > 5 AND outdoor_avg_c > -10", "heater_duty_pct", "max", True, 5.0),
    A("data_gap", "data_quality", "coverage_pct < 80 OR max_gap_seconds > 600", "coverage_pct", "min", False, 80.0),
    A("degree_minutes", "daily_summary", "dm_min < -500", "dm_min", "min", False, -500.0),
    A("actionable_alarms", "daily_summary", "alarm_excl_183_pct > 5", "alarm_excl_183_pct", "max", True, 5.0),
]


def alerts(daily: DataFrame, quality: DataFrame, as_of: str, keys: Keys = ()) -> DataFrame:
    return rules.evaluate_alerts({"daily_summary": daily, "data_quality": quality}, ALERTS, as_of, keys=keys)


