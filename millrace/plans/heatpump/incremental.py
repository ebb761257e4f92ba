"""Day tables kept up to date by the days that new samples touch, with cycle numbers over all days.

Every series restarts at midnight, so a day's rows follow from the samples of that day alone:
a load recomputes the days it touches, whole, and overwrites their partitions.  The one thing
that crosses midnight is the number of a compressor run.  Runs of any length are stored with their
number within the day, and beside them one row per series and day with its starts.  ``numbered`` adds the starts of all earlier days, a window over that small
table: a late day moves the numbers of all later ones, and none of them is written again.

A load that broke off, or comes twice, is run again as it was: it reads all samples of the same days
and overwrites the same partitions.  Rows carry the name of their load, and one row per day says
which load counts; so a partition that a day without rows leaves behind is not read.  An empty load
changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from millrace.operators.episodes import episodes
from millrace.operators.series import rising
from millrace.plans.heatpump import gold
from millrace.sources.tables import Layout, read_table, replace_partitions

DAY, LOAD = "log_date", "load"
SAMPLE_DAY = "log_date_parsed"
RUNS, STARTS, DAYS = "day_cycles", "day_starts", "days"
Builder = Callable[[DataFrame, gold.Keys], DataFrame]

#: Tables with rows of single days, and no number that runs on.
DAY_TABLES: dict[str, Builder] = {
    "daily_summary": gold.daily_summary, "data_quality": gold.data_quality, "alarm_episodes": gold.alarm_episodes,
    "defrost_cycles": gold.defrost_cycles, "dhw_cycles": gold.dhw_cycles,
}


def of_touched_days(samples: DataFrame, arrived: DataFrame) -> DataFrame:
    """All samples of the days that ``arrived`` has rows of; partitions of other days are not read."""
    return samples.join(arrived.select(SAMPLE_DAY).distinct(), SAMPLE_DAY, "left_semi")


def day_runs(samples: DataFrame, keys: gold.Keys = ()) -> DataFrame:
    """Compressor runs of any length, numbered within their day."""
    return episodes(
        gold.ordered(samples).filter("compr_freq_act_hz IS NOT NULL"), gold.day_series(keys),
        rising(gold.running), gold.ON, ["compr_freq_act_hz"], gold.CYCLE, number="cycle_id", floor_seconds=None,
    )


def refresh(
    samples: DataFrame, arrived: DataFrame, tables: Layout, load: str, keys: gold.Keys = (), builders: Mapping[str, Builder] = DAY_TABLES,
) -> None:
    """Recompute the days of ``arrived`` in all day tables; ``samples`` holds every sample so far, the new ones too."""
    if arrived.isEmpty():
        return
    touched = of_touched_days(samples, arrived)

    def put(rows: DataFrame, name: str) -> None:
        replace_partitions(rows.withColumn(LOAD, F.lit(load)).hint("rebalance", DAY), tables.path("gold", name), [DAY])

    for name, build in {**builders, RUNS: day_runs}.items():
        put(build(touched, keys), name)
    runs = _read(samples, tables, RUNS, day_runs, keys).filter(F.col(LOAD) == load)
    put(runs.groupBy(*keys, DAY).agg(F.count("*").alias("starts")), STARTS)
    put(arrived.select(F.col(SAMPLE_DAY).alias(DAY)).distinct(), DAYS)


def _read(samples: DataFrame, tables: Layout, name: str, build: Builder, keys: gold.Keys) -> DataFrame:
    """All partitions of a table; its columns follow from the samples, so it may still be empty."""
    schema = build(samples.limit(0), keys).withColumn(LOAD, F.lit("")).schema
    return samples.sparkSession.read.schema(schema).parquet(tables.path("gold", name))


def stored(samples: DataFrame, tables: Layout, name: str, keys: gold.Keys = (), build: Builder | None = None) -> DataFrame:
    """A day table as the loads so far left it."""
    days = read_table(samples.sparkSession, tables.path("gold", DAYS))
    build = build or DAY_TABLES[name]
    rows = _read(samples, tables, name, build, keys)
    return rows.join(days, [DAY, LOAD], "left_semi").select(build(samples.limit(0), keys).columns)


def numbered(runs: DataFrame, starts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``gold.cycles`` over all days, from runs numbered within days and the starts of each day."""
    unit = [*keys, DAY]
    earlier = Window.partitionBy(*keys).orderBy(DAY).rowsBetween(Window.unboundedPreceding, -1)
    before = starts.select(*unit, F.coalesce(F.sum("starts").over(earlier), F.lit(0)).alias("_before"))
    placed = runs.filter(F.col("samples") >= gold.MIN_CYCLE_SAMPLES).join(before, unit)
    return placed.select(*[(F.col(c) + F.col("_before")).alias(c) if c == "cycle_id" else c for c in runs.columns])


def cycles(samples: DataFrame, tables: Layout, keys: gold.Keys = ()) -> DataFrame:
    """The stored compressor runs with their numbers over all days."""
    count = lambda rows, keys: day_runs(rows, keys).groupBy(*keys, DAY).agg(F.count("*").alias("starts"))
    return numbered(stored(samples, tables, RUNS, keys, day_runs), stored(samples, tables, STARTS, keys, count), keys)
