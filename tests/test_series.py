"""The chunked scan against brute force on small random series."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from millrace.functions import Metric
from millrace.operators import series
from millrace.operators.episodes import episodes
from millrace.operators.series import Series, changed, falling, rising, scan

START = dt.datetime(2024, 3, 1, 22, 0, 0)


def rows_for(seed: int, n: int = 160, keys=("a", "b")):
    rng = random.Random(seed)
    out, i = [], 0
    for key in keys:
        t = START
        level = 0
        for _ in range(n):
            t += dt.timedelta(seconds=rng.choice([1, 5, 7, 60, 700, 4000, 0]))
            if rng.random() < 0.3:
                level = rng.choice([0, 0, 1, 2, 3])
            out.append((key, t.date(), t, i, level))
            i += 1
    rng.shuffle(out)
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, day date, ts timestamp_ntz, id int, x int")


def brute(rows, restart):
    """Row id to (previous x, gap, start, stop, change, start_no, stop_at)."""
    groups: dict = {}
    for row in rows:
        groups.setdefault(restart(row), []).append(row)
    out = {}
    for members in groups.values():
        prev, start_no, change_no, stop_at = None, 0, 0, None
        for k, day, ts, i, x in sorted(members, key=lambda r: (r[2], r[3])):
            px = prev[4] if prev else None
            start = x > 0 and not (px or 0) > 0
            stop = not x > 0 and (px or 0) > 0
            change = x > 0 and x != (px or 0)
            start_no += start
            change_no += change
            stop_at = ts if stop else stop_at
            gap = int((ts - prev[2]).total_seconds()) if prev else None
            out[i] = (px, gap, start, stop, change, start_no, change_no, stop_at)
            prev = (k, day, ts, i, x)
    return out


@pytest.mark.parametrize("seed,keys,chunk", [
    (1, ("k", "day"), 900), (2, ("k", "day"), 60), (3, ("k",), 3600), (4, (), 600), (5, (), 86_400), (6, ("k",), 1),
])
def test_scan_equals_brute_force(spark, seed, keys, chunk):
    rows = rows_for(seed)
    at = {"k": 0, "day": 1}
    want = brute(rows, lambda r: tuple(r[at[c]] for c in keys))
    on = lambda get: get("x") > 0
    s = Series(keys, "ts", ("id",), chunk)
    got = scan(frame(spark, rows), s, ["x"], {
        "start": rising(on), "stop": falling(on), "change": changed("x", "x > 0"),
    }).select("id", F.col("prev")["x"], series.gap_seconds(s), "start", "stop", "change", "start_no", "change_no", "stop_at").collect()
    assert {r[0]: tuple(r[1:]) for r in got} == want
    assert len(got) == len(rows)


def test_gap_interval_cap_and_first_row(spark):
    times = [0, 5, 12, 22, 33, 94, 695]
    rows = [("a", START.date(), START + dt.timedelta(seconds=t), i, 0) for i, t in enumerate(times)]
    out = series.with_gap(frame(spark, rows), Series(("k", "day"), "ts")).orderBy("ts").collect()
    assert [r["gap_interval"] for r in out] == [5, 5, 7, 10, 10, 10, 10]


def test_one_second_boundary_is_truncated_not_counted(spark):
    times = [0.9, 2.1]
    rows = [("a", START.date(), START + dt.timedelta(seconds=t), i, 0) for i, t in enumerate(times)]
    s = Series(("k",), "ts")
    gaps = scan(frame(spark, rows), s).select(series.gap_seconds(s).alias("g")).collect()
    assert sorted(g["g"] for g in gaps if g["g"] is not None) == [1]


def test_unique_samples_keeps_first_in_tie_order(spark):
    rows = [("a", START.date(), START, i, i) for i in range(3)] + [("b", START.date(), START, 9, 0)]
    out = series.unique_samples(frame(spark, rows), Series(("k", "day"), "ts", ("id",))).collect()
    assert sorted((r["k"], r["id"]) for r in out) == [("a", 0), ("b", 9)]


def test_episode_samples_sum_to_rows_in_state(spark):
    rows = rows_for(11)
    s = Series(("k",), "ts", ("id",), 300)
    runs = episodes(frame(spark, rows), s, rising(lambda get: get("x") > 0), "x > 0", ["x"], [Metric("top", "max", "x")])
    got = runs.collect()
    assert sum(r["samples"] for r in got) == sum(1 for r in rows if r[4] > 0)
    for key in ("a", "b"):
        ids = sorted(r["episode_id"] for r in got if r["k"] == key)
        assert ids == list(range(1, len(ids) + 1))


def test_numbers_over_all_days_equal_single_running_sum(spark):
    rows = rows_for(12)
    on = rising(lambda get: get("x") > 0)
    s = Series(("k", "day"), "ts", ("id",), 600, count_keys=("k",))
    numbered = scan(frame(spark, rows), s, ["x"], {"start": on}).filter("x > 0").select("id", "start_no").collect()
    by_day = brute(rows, lambda r: (r[0], r[1]))
    want, no = {}, {"a": 0, "b": 0}
    for row in sorted(rows, key=lambda r: (r[2], r[3])):
        no[row[0]] += by_day[row[3]][2]
        if row[4] > 0:
            want[row[3]] = no[row[0]]
    assert {r["id"]: r["start_no"] for r in numbered} == want


@pytest.mark.parametrize("seconds", [60, 86_400 * 40])
def test_chunks_follow_density(spark, seconds, monkeypatch):
    """The largest chunk is bounded, be all rows in one minute or spread over weeks; few rows make few chunks."""
    monkeypatch.setattr(series, "CHUNK_ROWS", 50)
    rows = [("a", START.date(), START + dt.timedelta(seconds=seconds * i / 3000), i, i % 3) for i in range(3000)]
    s = Series(("k",), "ts", ("id",)).fitted(frame(spark, rows))
    groups = [r["count"] for r in frame(spark, rows).withColumn("c", s.chunk()).groupBy("c").count().collect()]
    assert max(groups) <= 60 and len(groups) <= 70
    sparse = [(f"u{i}", START.date(), START + dt.timedelta(hours=i), i, 0) for i in range(200)]
    s = Series(("k",), "ts", ("id",)).fitted(frame(spark, sparse))
    assert frame(spark, sparse).withColumn("c", s.chunk()).select("k", "c").distinct().count() == 200
    assert Series((), "ts").fitted(frame(spark, rows).limit(0)).chunk_seconds > 0


def test_repeated_times_do_not_depend_on_arrival(spark):
    rng = __import__("random").Random(3)
    rows = [("a", START.date(), START + dt.timedelta(seconds=i // 2), i, rng.randrange(2)) for i in range(300)]
    s = Series(("k", "day"), "ts", ("id",), 7, unique=True)
    on = rising(lambda get: get("x") > 0)
    seen = set()
    for _ in range(3):
        rng.shuffle(rows)
        got = scan(frame(spark, rows).repartition(5), s, ["x"], {"start": on}).select("id", "start_no", F.col("prev")["x"]).collect()
        seen.add(tuple(sorted(map(tuple, got), key=lambda r: r[0])))
    assert len(seen) == 1 and [r[0] for r in next(iter(seen))] == list(range(0, 300, 2))


def test_hot_series_is_split_over_chunks(spark):
    """One key with all rows still becomes many window groups."""
    rows = [("a", START.date(), START + dt.timedelta(seconds=5 * i), i, i % 3) for i in range(2000)]
    s = Series(("k",), "ts", ("id",), 900)
    groups = frame(spark, rows).withColumn("c", s.chunk()).groupBy("k", "c").count()
    assert groups.count() >= 11 and groups.agg(F.max("count")).first()[0] <= 180
