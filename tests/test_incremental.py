"""Day tables kept by loads equal those of one run over all samples."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from heatpump_fixture import ON, run, write_day
from millrace.plans.heatpump import gold, incremental, logs
from millrace.sources.tables import Layout

KEYS = ("device",)
ALARM = {"alarm_number_raw": 271}


@pytest.fixture(scope="module")
def parts(spark, tmp_path_factory):
    """Samples in four loads: two days, the next, late hours of the first, and repeats that take a day's only run away."""
    root = tmp_path_factory.mktemp("logs")
    loads = [
        [*run("2024-01-10 10:00:00", 20), *run("2024-01-10 10:10:00", 12, **ON), *run("2024-01-10 23:59:30", 6, **ON), *run("2024-01-11 00:00:00", 30, **ON), *run("2024-01-11 05:00:00", 5)],
        [*run("2024-01-12 01:00:00", 3, **ON), *run("2024-01-12 01:01:00", 9), *run("2024-01-12 02:00:00", 40, **ON, **ALARM), *run("2024-01-13 00:00:00", 8, **ON)],
        [*run("2024-01-10 03:00:00", 10, **ON), *run("2024-01-10 03:10:00", 4), *run("2024-01-10 03:20:00", 2, **ON), *run("2024-01-10 03:30:00", 4)],
        run("2024-01-13 00:00:00", 8),
    ]
    made = []
    for i, lines in enumerate(loads):
        write_day(root / str(i), f"{9 - i}.log", lines)  # of repeats the first file by name counts: the latest load
        own = logs.samples(logs.raw_logs(spark, str(root / str(i)), stream=False))
        made.append(own.withColumn("device", F.lit("x")).unionByName(own.filter("hour(logged_at) < 11").withColumn("device", F.lit("y"))).checkpoint())
    return made


def same(a, b):
    assert a.columns == b.columns
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def files(tables: Layout, name: str, day: str) -> set[str]:
    return {p.name for p in Path(tables.path("gold", name), f"log_date={day}").glob("*.parquet")}


def test_loads_equal_one_run(spark, parts, tmp_path):
    tables, so_far = Layout(str(tmp_path)), None
    for i, arrived in enumerate(parts):
        so_far = arrived if so_far is None else so_far.unionByName(arrived)
        before = files(tables, incremental.RUNS, "2024-01-11")
        for _ in range(2 if i == 2 else 1):  # one load comes twice
            incremental.refresh(so_far, arrived, tables, f"load-{i}", KEYS, {})
        if i:
            assert before and before == files(tables, incremental.RUNS, "2024-01-11")  # an untouched day is not written
    so_far = so_far.checkpoint()
    made = incremental.cycles(so_far, tables, KEYS).checkpoint()
    same(made, gold.cycles(so_far, KEYS))
    numbers = {(r["device"], str(r["log_date"])): r["cycle_id"] for r in made.collect()}
    # four starts before the 12th: two late ones, one that lasts to midnight (no sample off in between), its second half
    assert numbers["x", "2024-01-11"] == 4 and numbers["x", "2024-01-12"] == 6 and ("x", "2024-01-13") not in numbers
    assert files(tables, incremental.RUNS, "2024-01-13")  # left behind, and not read


def test_empty_loads_and_tables(spark, parts, tmp_path):
    tables, idle = Layout(str(tmp_path)), parts[3].checkpoint()
    incremental.refresh(idle, idle, tables, "a", KEYS, {"alarm_episodes": gold.alarm_episodes})
    incremental.refresh(idle, idle.limit(0), tables, "b", KEYS, {})
    assert incremental.cycles(idle, tables, KEYS).count() == 0
    assert incremental.stored(idle, tables, "alarm_episodes", KEYS).count() == 0


def test_a_day_table_equals_one_run(spark, parts, tmp_path):
    tables, build = Layout(str(tmp_path)), {"data_quality": gold.data_quality}
    both = parts[0].unionByName(parts[2]).checkpoint()
    incremental.refresh(parts[0], parts[0], tables, "a", KEYS, build)
    incremental.refresh(both, parts[2], tables, "b", KEYS, build)
    same(incremental.stored(both, tables, "data_quality", KEYS), gold.data_quality(both, KEYS))
