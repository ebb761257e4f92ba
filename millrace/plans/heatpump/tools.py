"""Question-sized query functions over the heat-pump summary tables.

``tool(name, tables, **args)`` returns typed rows, ``tool_json`` the same rows as one JSON
array per device.  Dates are arguments, never the clock, so answers repeat.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.metrics import Metric, summarise
from millrace.functions.scalars import in_period, lookback, on_day, rnd
from millrace.operators.rules import problem_score
from millrace.operators.series import latest, top_n
from millrace.operators.summaries import json_rows

Tables = Mapping[str, DataFrame]
Keys = tuple[str, ...]

# Source table, fields and order of each lookback tool.
LOOKBACK_TOOLS = {
    "get_daily_summary": ("daily_summary", ["log_date"], (
        "log_date outdoor_min_c outdoor_avg_c delta_t_avg_k dm_avg dm_min compr_duty_pct compr_freq_avg_hz compr_starts "
        "heater_duty_pct heater_energy_kwh superheat_avg_k neg_superheat_pct hp_avg_bar discharge_max_c alarm_pct "
        "alarm_excl_183_pct alarm_codes bt1_bt28_max_divergence_k supply_vs_calc_offset_k total_hours subcooling_avg_k "
        "subcooling_min_k short_cycle_count standby_circ_pump_pct standby_fan_avg_pct bt1_vs_avg_divergence_k "
        "defrost_cycles"
    )),
    "get_flow_diagnosis": ("flow_quality", ["log_date", "freq_band"], (
        "log_date freq_band delta_t_avg_k delta_t_max_k hp_avg_bar discharge_avg_c superheat_avg_k heater_pct samples"
    )),
    "get_superheat_status": ("daily_summary", ["log_date"], (
        "log_date superheat_avg_k superheat_min_k neg_superheat_pct compr_freq_avg_hz hp_avg_bar discharge_avg_c "
        "discharge_max_c"
    )),
    "get_alarm_episodes": ("alarm_episodes", ["start_time"], (
        "log_date alarm_number start_time duration_min outdoor_avg_c freq_avg_hz hp_avg_bar discharge_avg_c "
        "superheat_avg_k delta_t_avg_k heater_avg_kw dm_avg"
    )),
    "get_data_quality": ("data_quality", ["log_date"], (
        "log_date coverage_pct logged_hours max_gap_seconds null_bt1 null_freq null_hp"
    )),
    "get_system_health": ("anomaly_rules", ["log_date"], (
        "log_date overall_status anomaly_score top_issue flow_status superheat_status heater_status demand_status "
        "alarm_status discharge_status wind_snow_status cycling_status data_quality_status"
    )),
    "get_cycle_analysis": ("cycle_summary", ["log_date"], (
        "log_date total_cycles cycles_per_day avg_cycle_min short_cycle_pct avg_freq_volatility cycles_with_alarm "
        "cycles_with_bad_superheat cycles_with_high_dt avg_dt_spread_k heating_cycles dhw_cycles"
    )),
    "get_defrost_analysis": ("defrost_cycles", ["start_time"], (
        "log_date episode_id start_time duration_min outdoor_avg_c bt16_start_c bt16_end_c bt16_avg_c fan_avg_pct "
        "freq_avg_hz hp_avg_bar discharge_avg_c had_non_defrost_alarm"
    )),
    "get_dhw_analysis": ("dhw_cycles", ["start_time"], (
        "log_date episode_id start_time duration_min bt6_start_c bt6_end_c bt7_start_c bt7_end_c outdoor_avg_c "
        "freq_avg_hz hp_avg_bar superheat_avg_k heater_duty_pct heater_kwh had_alarm"
    )),
}

HOURLY_FIELDS = (
    "hour outdoor_avg_c supply_avg_c return_avg_c delta_t_avg_k dm_avg freq_avg_hz compr_duty_pct heater_kwh "
    "heater_duty_pct superheat_avg_k superheat_p10_k superheat_p50_k superheat_p90_k subcooling_avg_k hp_avg_bar "
    "discharge_avg_c alarm_samples heating_pct dhw_pct"
)
HEATER_FIELDS = (
    "log_date outdoor_min_c outdoor_avg_c heater_duty_pct heater_energy_kwh heater_max_kw delta_t_avg_k dm_avg dm_min"
)
WORST_FIELDS = (
    "cycle_id start_time duration_min freq_avg_hz delta_t_avg_k superheat_avg_k neg_superheat_pct hp_max_bar "
    "discharge_max_c had_alarm alarm_code heater_pct outdoor_avg_c dominant_mode_name"
)
# Points per problem of a compressor cycle.
CYCLE_PROBLEMS = [
    ("had_alarm = 1", 30),
    ("neg_superheat_pct > 30", 20),
    ("delta_t_avg_k > 7", 15),
    ("duration_min < 5", 10),
    ("hp_max_bar > 28", 10),
    ("discharge_max_c > 95", 10),
    ("heater_pct > 50", 5),
]

TOOL_NAMES = (
    *LOOKBACK_TOOLS, "get_heater_analysis", "get_hourly_detail", "get_heating_curve", "get_period_comparison",
    "get_worst_cycles",
)


def _recent(tables: Tables, table: str, as_of: str, days: int) -> DataFrame:
    return tables[table].filter(lookback("log_date", as_of, days))


# Decimals of the heating-curve columns when folded over days.
HEATER_DIGITS = {"heater_pct": 0, "freq_avg_hz": 0, "delta_t_k": 1}
CURVE_DIGITS = {"calc_supply_c": 1, "actual_supply_c": 1, "return_c": 1, "delta_t_k": 1, "dm_avg": 0, "heater_pct": 0}


def _by_outdoor(tables: Tables, as_of: str, days: int, keys: Keys, digits: dict[str, int]) -> DataFrame:
    """Heating-curve rows of many days folded per outdoor degree, where there are enough samples."""
    metrics = [Metric(c, "avg", c, digits=d) for c, d in digits.items()]
    rows = summarise(_recent(tables, "heating_curve", as_of, days), [*keys, "bt1_rounded_c"],
                     [*metrics, Metric("samples", "sum", "samples")])
    return rows.filter("samples > 50")


def heater_daily(tables: Tables, as_of: str, lookback_days: int = 7, keys: Keys = ()) -> DataFrame:
    return _recent(tables, "daily_summary", as_of, lookback_days).select(*keys, *HEATER_FIELDS.split())


def heater_by_outdoor(tables: Tables, as_of: str, lookback_days: int = 7, keys: Keys = ()) -> DataFrame:
    return _by_outdoor(tables, as_of, lookback_days, keys, HEATER_DIGITS)


def heating_curve(tables: Tables, as_of: str, lookback_days: int = 7, keys: Keys = ()) -> DataFrame:
    return _by_outdoor(tables, as_of, lookback_days, keys, CURVE_DIGITS)


def hourly_detail(tables: Tables, target_date: str, keys: Keys = ()) -> DataFrame:
    return tables["hourly_detail"].filter(on_day("log_date", target_date)).select(*keys, *HOURLY_FIELDS.split())


def worst_cycles(tables: Tables, target_date: str, n: int = 10, keys: Keys = ()) -> DataFrame:
    """Top-n (per device): each task keeps n rows before anything is gathered; no global sort."""
    scored = problem_score(tables["cycles"].filter(on_day("log_date", target_date)), CYCLE_PROBLEMS)
    best = latest(scored, keys, [F.col("problem_score").desc(), F.col("cycle_id").asc()], n) if keys else top_n(
        scored, "problem_score", ["cycle_id"], n)
    return best.select(*keys, *WORST_FIELDS.split(), "problem_score")


COMPARED = [
    Metric("start_date", "min", "log_date"),
    Metric("end_date", "max", "log_date"),
    Metric("days", "distinct", "log_date"),
    *[Metric(c, "avg", c, digits=d) for c, d in {
        "outdoor_avg_c": 1, "delta_t_avg_k": 1, "dm_avg": 0, "compr_duty_pct": 1, "compr_freq_avg_hz": 0,
        "heater_duty_pct": 1, "neg_superheat_pct": 1, "superheat_avg_k": 1, "hp_avg_bar": 1, "alarm_pct": 1,
        "alarm_excl_183_pct": 1, "bt1_bt28_avg_divergence_k": 1,
    }.items()],
    Metric("outdoor_min_c", "min", "outdoor_min_c", digits=1),
    Metric("heater_total_kwh", "sum", "heater_energy_kwh", digits=1),
]


def period_comparison(
    tables: Tables, p1: tuple[str, str], p2: tuple[str, str], keys: Keys = (), max_weather_gap_k: float = 3.0
) -> DataFrame:
    """Both periods side by side, and whether their weather is close enough to compare.

    A day in both periods counts in both.  With no device key an empty period still gives a
    row (of NULLs), as a global aggregate does.
    """
    daily = tables["daily_summary"]
    parts = [
        summarise(daily.filter(in_period("log_date", *p)), keys, COMPARED).withColumn("period", F.lit(name))
        for name, p in (("period_1", p1), ("period_2", p2))
    ]
    both = reduce(lambda a, b: a.unionByName(b), parts)
    spread = both.groupBy(*keys).agg(
        (F.max("outdoor_avg_c") - F.min("outdoor_avg_c")).alias("_gap"), F.count("outdoor_avg_c").alias("_n")
    )
    comparable = F.when(F.col("_n") == 2, rnd("_gap", 6) <= F.lit(max_weather_gap_k))
    if keys:
        joined = both.join(spread, list(keys))
    else:
        joined = both.withColumns({c: spread.select(c).scalar() for c in ("_gap", "_n")})
    return joined.withColumn("comparable_weather", comparable).drop("_gap", "_n")


def tool(name: str, tables: Tables, as_of: str | None = None, lookback_days: int = 7, keys: Keys = (), **args) -> DataFrame:
    if name in LOOKBACK_TOOLS:
        table, _, fields = LOOKBACK_TOOLS[name]
        return _recent(tables, table, as_of, lookback_days).select(*keys, *fields.split())
    if name == "get_heater_analysis":
        part = heater_by_outdoor if args.get("part") == "by_outdoor_temp" else heater_daily
        return part(tables, as_of, lookback_days, keys)
    if name == "get_heating_curve":
        return heating_curve(tables, as_of, lookback_days, keys)
    if name == "get_hourly_detail":
        return hourly_detail(tables, args["target_date"], keys)
    if name == "get_period_comparison":
        return period_comparison(tables, args["p1"], args["p2"], keys)
    if name == "get_worst_cycles":
        return worst_cycles(tables, args["target_date"], args.get("top_n", 10), keys)
    raise KeyError(name)


_ORDER = {
    **{name: order for name, (_, order, _) in LOOKBACK_TOOLS.items()},
    "get_heating_curve": ["bt1_rounded_c"],
    "get_hourly_detail": ["hour"],
    "get_period_comparison": ["period"],
}


def tool_json(name: str, tables: Tables, keys: Keys = (), **args) -> DataFrame:
    """One row (per device) with the JSON text a caller gets.

    ``get_heater_analysis`` gives an object of two arrays, all others one array.
    """
    if name == "get_heater_analysis":
        daily = json_rows(tool(name, tables, keys=keys, **args), ["log_date"], keys, "daily")
        by_temp = json_rows(
            tool(name, tables, keys=keys, part="by_outdoor_temp", **args), ["bt1_rounded_c"], keys, "by_outdoor_temp"
        )
        if keys:
            joined = daily.join(by_temp, list(keys), "full")
        else:
            joined = daily.withColumn("by_outdoor_temp", by_temp.scalar())
        empty = F.lit("[]")
        return joined.select(*keys, F.concat(
            F.lit('{"daily":'), F.coalesce("daily", empty),
            F.lit(',"by_outdoor_temp":'), F.coalesce("by_outdoor_temp", empty), F.lit("}"),
        ).alias("result"))
    rows = tool(name, tables, keys=keys, **args)
    if name == "get_worst_cycles":  # worst first: sort by the negated score, then leave it out
        return json_rows(rows.withColumn("_rank", -F.col("problem_score")), ["_rank", "cycle_id"], keys, leave_out=["_rank"])
    return json_rows(rows, _ORDER[name], keys)


def _array(fields: str, order: list[str], source: str) -> str:
    """SQL for a JSON array of rows, in the order of ``order`` (a leading ``-`` is descending)."""
    names = fields.split()
    first = [f"-{o[1:]} AS _{i}" if o.startswith("-") else f"{o} AS _{i}" for i, o in enumerate(order)]
    shown = ", ".join(f"'{n}', r.{n}" for n in names)
    rows = f"array_sort(collect_list(struct({', '.join([*first, *names])})))"
    return f"(SELECT transform({rows}, r -> named_struct({shown})) FROM {source})"


def _rounded(name: str, digits: int, how: str = "avg") -> str:
    return f"CAST(round(CAST({how}({name}) AS DECIMAL(28,9)), {digits}) AS DOUBLE) AS {name}"


def register_tools(spark: SparkSession, tables: Tables, as_of: str, only: Mapping[str, str] | None = None) -> list[str]:
    """Make all tools callable from SQL, e.g. ``SELECT get_daily_summary(7)``.

    The functions speak of one device.  Where the tables hold several, ``only`` names it
    (column and value); devices are never merged.

    Each becomes a temporary function holding scalar subqueries over temporary views, and
    returns the JSON text of ``tool_json``.
    """
    def view(table: str) -> str:
        rows = tables[table]
        for column, value in (only or {}).items():
            rows = rows.filter(F.col(column) == value)
        rows.createOrReplaceTempView(f"tool_{table}")
        return f"tool_{table}"

    recent = f"log_date >= date_sub(DATE'{as_of}', lookback_days)"
    days, on_date = "lookback_days INT DEFAULT 7", "log_date = CAST(target_date AS DATE)"
    made: dict[str, tuple[str, str]] = {}
    for name, (table, order, fields) in LOOKBACK_TOOLS.items():
        made[name] = (days, f"to_json({_array(fields, order, f'{view(table)} WHERE {recent}')})")
    hours = f"{view('hourly_detail')} WHERE {on_date}"
    made["get_hourly_detail"] = ("target_date STRING", f"to_json({_array(HOURLY_FIELDS, ['hour'], hours)})")

    def by_outdoor(digits: dict[str, int]) -> str:
        folded = ", ".join(_rounded(c, d) for c, d in digits.items())
        source = (
            f"(SELECT bt1_rounded_c, {folded}, sum(samples) AS samples FROM {view('heating_curve')} WHERE {recent} "
            "GROUP BY bt1_rounded_c HAVING sum(samples) > 50)"
        )
        return _array(" ".join(["bt1_rounded_c", *digits, "samples"]), ["bt1_rounded_c"], source)

    made["get_heating_curve"] = (days, f"to_json({by_outdoor(CURVE_DIGITS)})")
    daily = _array(HEATER_FIELDS, ["log_date"], f"{view('daily_summary')} WHERE {recent}")
    made["get_heater_analysis"] = (
        days, f"to_json(named_struct('daily', {daily}, 'by_outdoor_temp', {by_outdoor(HEATER_DIGITS)}))"
    )
    score = " + ".join(f"CASE WHEN {cond} THEN {points} ELSE 0 END" for cond, points in CYCLE_PROBLEMS)
    ranked = (
        f"(SELECT * FROM (SELECT *, row_number() OVER (ORDER BY problem_score DESC, cycle_id) AS _rn FROM "
        f"(SELECT *, {score} AS problem_score FROM {view('cycles')} WHERE {on_date})) WHERE _rn <= top_n)"
    )
    made["get_worst_cycles"] = (
        "target_date STRING, top_n INT DEFAULT 10",
        f"to_json({_array(WORST_FIELDS + ' problem_score', ['-problem_score', 'cycle_id'], ranked)})",
    )
    compared = ", ".join(m.sql() + f" AS {m.name}" for m in COMPARED)
    periods = " UNION ALL ".join(
        f"SELECT 'period_{i}' AS period, {compared} FROM {view('daily_summary')} "
        f"WHERE log_date BETWEEN CAST(p{i}_start AS DATE) AND CAST(p{i}_end AS DATE)" for i in (1, 2)
    )
    fields = "period " + " ".join(m.name for m in COMPARED)
    made["get_period_comparison"] = (
        "p1_start STRING, p1_end STRING, p2_start STRING, p2_end STRING",
        f"to_json({_array(fields, ['period'], f'({periods})')})",
    )
    for name, (args, body) in made.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS STRING RETURN {body}")
    return list(made)


def known_tools(spark: SparkSession) -> DataFrame:
    """Registered tools out of the expected fourteen."""
    wanted = spark.createDataFrame([(n,) for n in TOOL_NAMES], "name string")
    present = spark.sql("SHOW USER FUNCTIONS").select(F.regexp_extract("function", r"([^.]+)$", 1).alias("name"))
    return wanted.join(present, "name").orderBy("name")
