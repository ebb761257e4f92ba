"""Heat-pump logs: raw text rows and the typed sample table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from millrace.functions.scalars import label
from millrace.operators.envelope import drop_headers
from millrace.operators.parse import local_timestamp, register, register_diff
from millrace.operators.quality import Expectation, keep_valid
from millrace.sources.files import read_tsv, with_file_lineage

# Column order of the log files.
LOG_COLUMNS = (
    "log_date log_time version_raw r_version_raw bt1_raw bt6_raw bt7_raw bt25_raw bt71_raw bt63_raw "
    "tot_int_add_raw alarm_number_raw calc_supply_raw degree_minutes_raw bt1_average_raw relays_pca_base_raw "
    "compr_freq_calc_raw compr_freq_act_raw compr_state_raw compr_protection_mode_raw gp12_speed_raw gp10_on_off_raw "
    "eb101_bt3_raw eb101_bt12_raw eb101_bt14_raw eb101_bt15_raw eb101_bt16_raw eb101_bt17_raw eb101_bt28_raw "
    "eb101_bp4_raw eb101_bp4_adc_raw saturation_temp_raw sat_temp_sent_raw eb101_low_pressure_raw prio_raw"
).split()

LOG_SCHEMA = StructType([StructField(c, StringType()) for c in LOG_COLUMNS])
HEADER_WORDS = ("Divisors", "Date")
DATE_SHAPE = r"^\d{4}-\d{2}-\d{2}$"

# Output column, raw register, divisor.
REGISTERS = [
    ("sw_version", "version_raw", 1),
    ("r_version", "r_version_raw", 1),
    ("bt1_outdoor_temp_c", "bt1_raw", 10),
    ("bt1_average_c", "bt1_average_raw", 10),
    ("bt28_outdoor_module_c", "eb101_bt28_raw", 10),
    ("bt71_return_c", "bt71_raw", 10),
    ("bt6_dhw_top_c", "bt6_raw", 10),
    ("bt7_dhw_charge_c", "bt7_raw", 10),
    ("bt25_supply_c", "bt25_raw", 10),
    ("bt63_hw_supply_c", "bt63_raw", 10),
    ("calc_supply_c", "calc_supply_raw", 10),
    ("bt3_return_cond_c", "eb101_bt3_raw", 10),
    ("bt12_condenser_c", "eb101_bt12_raw", 10),
    ("bt14_discharge_c", "eb101_bt14_raw", 10),
    ("bt15_liquid_c", "eb101_bt15_raw", 10),
    ("bt16_evap_c", "eb101_bt16_raw", 10),
    ("bt17_suction_c", "eb101_bt17_raw", 10),
    ("saturation_temp_c", "saturation_temp_raw", 10),
    ("saturation_temp_sent_c", "sat_temp_sent_raw", 10),
    ("bp4_hp_bar", "eb101_bp4_raw", 10),
    ("bp4_hp_raw_bar", "eb101_bp4_adc_raw", 10),
    ("lp_raw", "eb101_low_pressure_raw", 1),
    ("compr_freq_calc_hz", "compr_freq_calc_raw", 1),
    ("compr_freq_act_hz", "compr_freq_act_raw", 10),
    ("compr_state", "compr_state_raw", 1),
    ("compr_protection_mode", "compr_protection_mode_raw", 1),
    ("gp12_fan_pct", "gp12_speed_raw", 1),
    ("degree_minutes", "degree_minutes_raw", 10),
    ("relays_pca_base", "relays_pca_base_raw", 1),
    ("priority_mode", "prio_raw", 1),
    ("tot_int_add_kw", "tot_int_add_raw", 100),
    ("alarm_number", "alarm_number_raw", 1),
]

# Output column, register minus register (both in tenths).
DIFFERENCES = [
    ("delta_t_k", "bt25_raw", "bt71_raw"),
    ("superheat_k", "eb101_bt17_raw", "eb101_bt16_raw"),
    ("supply_deviation_k", "bt63_raw", "calc_supply_raw"),
    ("discharge_superheat_k", "eb101_bt14_raw", "bt25_raw"),
]

MODE_NAMES = {30: "HEATING", 20: "DHW", 10: "STANDBY"}
HEATER_STAGES = {0: "OFF", 300: "3kW", 600: "6kW", 900: "9kW"}

SAMPLE_RULES = [
    Expectation("valid_timestamp", "logged_at IS NOT NULL"),
    Expectation("valid_outdoor_temp", "bt1_outdoor_temp_c BETWEEN -40 AND 50"),
    Expectation("valid_supply_temp", "bt25_supply_c BETWEEN 10 AND 65"),
    Expectation("valid_freq", "compr_freq_act_hz BETWEEN 0 AND 130"),
]

# Column order of the sample table.
SAMPLE_COLUMNS = (
    "logged_at log_date_parsed sw_version r_version bt1_outdoor_temp_c bt1_average_c bt28_outdoor_module_c "
    "bt71_return_c bt6_dhw_top_c bt7_dhw_charge_c bt25_supply_c bt63_hw_supply_c calc_supply_c supply_deviation_k "
    "bt3_return_cond_c bt12_condenser_c bt14_discharge_c bt15_liquid_c bt16_evap_c bt17_suction_c saturation_temp_c "
    "saturation_temp_sent_c bp4_hp_bar bp4_hp_raw_bar lp_raw compr_freq_calc_hz compr_freq_act_hz compr_state "
    "compr_running compr_protection_mode gp12_fan_pct gp10_circ_pump_on degree_minutes relays_pca_base priority_mode "
    "tot_int_add_kw alarm_number alarm_active delta_t_k superheat_k negative_superheat defrost_active "
    "bt1_bt28_divergence_k mode_name heater_stage discharge_superheat_k source_file source_filename ingested_at"
).split()


def clean_log_rows(rows: DataFrame) -> DataFrame:
    return drop_headers(rows, "log_date", HEADER_WORDS, DATE_SHAPE)


def raw_logs(spark: SparkSession, path: str, stream: bool = True) -> DataFrame:
    """Log files to raw rows with file lineage."""
    rows = clean_log_rows(read_tsv(spark, path, LOG_SCHEMA, stream))
    return with_file_lineage(rows, "_source_file", "_source_filename", "_ingested_at")


def parse_logs(raw: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Typed samples before any rule is applied.  ``keys`` (e.g. a device) pass through."""
    typed = raw.select(
        *keys,
        local_timestamp("log_date", "log_time").alias("logged_at"),
        F.col("log_date").try_cast("date").alias("log_date_parsed"),
        *[register(src, div).alias(out) for out, src, div in REGISTERS],
        *[register_diff(a, b, 10).alias(out) for out, a, b in DIFFERENCES],
        F.abs(register_diff("bt1_raw", "eb101_bt28_raw", 10)).alias("bt1_bt28_divergence_k"),
        (register("gp10_on_off_raw") > 0).alias("gp10_circ_pump_on"),
        label(register("tot_int_add_raw"), HEATER_STAGES, "UNKNOWN").alias("heater_stage"),
        F.col("_source_file").alias("source_file"),
        F.col("_source_filename").alias("source_filename"),
        F.col("_ingested_at").alias("ingested_at"),
    )
    flagged = typed.withColumns({
        "compr_running": F.col("compr_state") == 2,
        "alarm_active": F.col("alarm_number") > 0,
        "negative_superheat": F.expr("compr_freq_act_hz > 0 AND superheat_k < 0"),
        "defrost_active": F.expr("bt16_evap_c > 10 AND gp12_fan_pct > 30"),
        "mode_name": label("priority_mode", MODE_NAMES, "UNKNOWN"),
    })
    return flagged.select(*keys, *SAMPLE_COLUMNS)


def samples(raw: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Typed, range-checked samples.  Map-only, so it serves batch and streaming alike."""
    return keep_valid(parse_logs(raw, keys), SAMPLE_RULES)
