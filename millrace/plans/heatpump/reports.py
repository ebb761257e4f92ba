"""Dashboard and viewer queries over the heat-pump tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.metrics import Metric, summarise
from millrace.functions.scalars import in_period, lookback, on_day, rnd
from millrace.operators.series import delta, latest

Keys = tuple[str, ...]


def kpis(hourly: DataFrame, keys: Keys = ()) -> DataFrame:
    return summarise(hourly, keys, [
        Metric("total_days", "distinct", "log_date"),
        Metric("avg_outdoor_c", "avg", "outdoor_avg_c", digits=1),
        Metric("avg_supply_c", "avg", "supply_avg_c", digits=1),
        Metric("avg_superheat_k", "avg", "superheat_avg_k", digits=1),
        Metric("avg_delta_t_k", "avg", "delta_t_avg_k", digits=1),
        Metric("avg_compr_duty", "avg", "compr_duty_pct", digits=0),
        Metric("total_heater_kwh", "sum", "heater_kwh", digits=0),
    ])


def daily_trend(hourly: DataFrame, keys: Keys = ()) -> DataFrame:
    return summarise(hourly, [*keys, "log_date"], [
        *[Metric(c, "avg", c, digits=d) for c, d in {
            "outdoor_avg_c": 1, "supply_avg_c": 1, "superheat_avg_k": 1, "delta_t_avg_k": 1, "compr_duty_pct": 0,
        }.items()],
        Metric("heater_kwh_day", "sum", "heater_kwh", digits=1),
    ]).orderBy(*keys, "log_date")


def alarm_list(alarm_rows: DataFrame, keys: Keys = ()) -> DataFrame:
    rounded = ["duration_min", "outdoor_avg_c", "superheat_avg_k", "delta_t_avg_k", "hp_avg_bar", "discharge_avg_c"]
    return (
        alarm_rows.orderBy(*keys, "log_date", "episode_id")
        .select(
            *keys, "log_date", "alarm_number", F.col("start_time").cast("string").alias("start_time_str"),
            *[rnd(c, 1).alias(c) for c in rounded],
        )
    )


def quality_list(quality: DataFrame, keys: Keys = ()) -> DataFrame:
    return quality.select(
        *keys, "log_date", "total_samples", "coverage_pct", "logged_hours", "max_gap_seconds"
    ).orderBy(*keys, "log_date")


def flow_by_band(flow: DataFrame, as_of: str, days: int, keys: Keys = ()) -> DataFrame:
    """Recent days; if there are none, all days.

    Both are folded in one pass: recent rows are kept apart by a flag that becomes part of
    the group, and the older group is used only where no recent row exists at all.
    """
    recent = F.coalesce(lookback("log_date", as_of, days), F.lit(False))
    tagged = flow.withColumn("_recent", recent)
    parts = tagged.groupBy(*keys, "freq_band", "_recent").agg(
        F.sum("delta_t_avg_k").alias("_dt"), F.count("delta_t_avg_k").alias("_dtn"),
        F.sum("heater_pct").alias("_h"), F.count("heater_pct").alias("_hn"), F.sum("samples").alias("_s"),
    )
    any_recent = parts.groupBy(*keys).agg(F.max("_recent").alias("_any"))
    joined = parts.join(any_recent, list(keys)) if keys else parts.withColumn("_any", any_recent.scalar())
    return (
        joined.filter(F.col("_recent") | ~F.col("_any"))
        .groupBy(*keys, "freq_band")
        .agg(
            rnd(F.try_divide(F.sum("_dt"), F.sum("_dtn")), 1).alias("delta_t_avg_k"),
            rnd(F.try_divide(F.sum("_h"), F.sum("_hn")), 0).alias("heater_pct"),
            F.sum("_s").alias("samples"),
        )
        .orderBy(*keys, "freq_band")
    )


def kpi_strip(daily: DataFrame, as_of: str, days: int, keys: Keys = ()) -> DataFrame:
    """Means and sums over the lookback, and the last day's change of delta-T.

    Each day carries its change, so the last day's one is a plain maximum by date.
    """
    rows = delta(daily.filter(lookback("log_date", as_of, days)), {"delta_t_avg_k": "_change"}, keys, "log_date")
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("days"),
        F.avg("outdoor_avg_c").alias("outdoor_avg_c"),
        F.avg("delta_t_avg_k").alias("delta_t_avg_k"),
        F.sum("heater_energy_kwh").alias("heater_total_kwh"),
        F.avg("neg_superheat_pct").alias("neg_superheat_pct"),
        F.avg("alarm_excl_183_pct").alias("alarm_excl_183_pct"),
        F.max_by("_change", "log_date").alias("delta_t_change_k"),
    )


def raw_window(samples: DataFrame, target_date: str, hour: int, columns: Sequence[str], keys: Keys = ()) -> DataFrame:
    """Samples of one hour of one day."""
    day = samples.filter(on_day("log_date_parsed", target_date))
    return day.filter(F.hour("logged_at") == hour).select(*keys, "logged_at", *columns).orderBy(*keys, "logged_at")


def minute_averages(
    samples: DataFrame, start: str, end: str, columns: Sequence[str], keys: Keys = ()
) -> DataFrame:
    """One row per minute of the given days (the viewer asks for one day)."""
    minute = F.date_trunc("minute", F.col("logged_at")).cast("timestamp_ntz").alias("ts")
    rows = samples.filter(in_period("log_date_parsed", start, end))
    return summarise(rows, [*keys, minute], [Metric(c, "avg", f"cast({c} as double)", digits=2) for c in columns])


def latest_quality(quality: DataFrame, keys: Keys = ()) -> DataFrame:
    """The last day (of each device)."""
    return latest(quality, keys, ["log_date"]) if keys else quality.orderBy(F.col("log_date").desc()).limit(1)
