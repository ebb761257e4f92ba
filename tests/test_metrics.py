from __future__ import annotations

import pytest

from millrace.functions import Metric, rnd, summarise
from pyspark.sql import functions as F

METRICS = [
    Metric("n", "count"), Metric("kinds", "distinct", "v"), Metric("mid", "quantile", "v"), Metric("top", "mode", "v"),
    Metric("codes", "set", "v", "v > 1"), Metric("share", "pct", "v > 1", digits=1), Metric("none", "pct", "v > 1", of="v > 99"),
]
ROWS = [("a", 1), ("a", 2), ("a", 2), (None, 3), (None, None)]


@pytest.mark.parametrize("keys,want", [
    (["k"], {"a": (3, 2, 2, 2, [2], 66.7, None), None: (2, 1, 3, 3, [3], 50.0, None)}),
    ([], {"all": (5, 3, 2, 2, [2, 3], 60.0, None)}),
])
def test_sets_and_distinct_counts_on_the_side(spark, keys, want):
    df = spark.createDataFrame(ROWS, "k string, v int")
    got = summarise(df, keys, METRICS).select(*keys, *[m.name for m in METRICS]).collect()
    assert {(r[0] if keys else "all"): tuple(r[len(keys):]) for r in got} == want


def test_rounding_is_half_up_and_ignores_noise(spark):
    df = spark.createDataFrame([(1.15,), (-1.15,), (0.1 + 0.2 + 0.05,)], "x double")
    assert [r[0] for r in df.select(rnd(F.col("x"), 1)).collect()] == [1.2, -1.2, 0.4]
