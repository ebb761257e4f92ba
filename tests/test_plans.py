"""What the physical plans must look like at scale."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from millrace.operators.cdc import scd1
from millrace.plans.heatpump import gold, tools
from millrace.suite import queries

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["daily_summary", "customer_360", "cycles", "anomaly_summary", "alarm_episodes"])
def test_no_python_and_no_cartesian(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    for word in ("Python", "CartesianProduct", "NestedLoopJoin"):
        assert word not in text


def test_latest_is_cut_before_the_shuffle(spark):
    text = plan(scd1(spark.read.parquet(f"{SF}/events.parquet"), ["user_id"], ["ts"]))
    assert "WindowGroupLimit" in text and text.index("WindowGroupLimit") < text.rindex("WindowGroupLimit")


def test_scan_windows_are_keyed_by_chunk(spark):
    text = plan(gold.daily_summary(queries.pump(spark, SF)))
    windows = [line for line in text.splitlines() if "Window [" in line]
    over_rows = [w for w in windows if "_p" in w or "start" in w or "prev" in w]
    assert over_rows and all("_chunk" in w for w in over_rows)


def test_day_filter_and_columns_reach_the_scan(spark):
    # the summary as a view over the samples, not as a written table
    day = tools.tool("get_data_quality", {"data_quality": gold.data_quality(queries.pump(spark, SF))}, "2024-01-21", 7)
    text = plan(day)
    scans = [line for line in text.splitlines() if "FileScan" in line]
    assert scans and all("GreaterThanOrEqual(log_date_parsed" in s for s in scans)
    assert all("mode_name" not in s and "supply_deviation_k" not in s for s in scans)


def test_top_n_is_not_a_global_sort(spark):
    assert "TakeOrderedAndProject" in plan(entry.queries()["top_data_users"](spark, SF))


def test_percentages_are_one_pass(spark):
    text = plan(gold.flow_quality(queries.pump(spark, SF)))
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1
