"""What a query writes and what one task reads do not grow faster than its input."""

from __future__ import annotations

from pathlib import Path

import pytest

from millrace.plans.heatpump import gold
from millrace.suite import landing, queries, streams
from millrace.suite.staging import stage_root

SF = "/root/testdata/sf0.01"


def files(folder: str, suffix: str) -> list[Path]:
    return [p for p in Path(folder).glob("part-*") if p.name.endswith(suffix)]


@pytest.mark.parametrize("name", ["type_distribution", "anomaly_summary", "by_plan"])
def test_record_summaries_write_no_copy_of_the_records(spark, name):
    queries.QUERIES[name](spark, SF).collect()
    made = {p.name for p in Path(stage_root(spark, SF)).glob("*")}
    assert not {n for n in made if n.startswith(("messages_", "cdr_"))}


def test_files_of_a_stream_grow_in_number(spark, monkeypatch):
    assert [streams.files_a_batch(n) for n in (0, 1, 1_200_000, 1_200_001, 288_000_000)] == [1, 1, 1, 2, 240]
    monkeypatch.setattr(streams.files_a_batch, "__defaults__", (streams.BATCHES, 500))
    rows = streams.arrivals(spark, SF, "sms")
    made = files(f"{stage_root(spark, SF)}/arrivals_sms", ".parquet")
    assert len(made) > streams.BATCHES and max(spark.read.parquet(str(p)).count() for p in made) < 1_000
    assert rows.count() == queries.delivered(spark, SF, "sms").count()


def test_landed_files_are_compressed_and_bounded(spark, monkeypatch):
    monkeypatch.setattr(landing, "FILE_LINES", 20_000)
    made = files(landing.json_files(spark, SF), ".gz")
    lines = landing.feeds.table(spark, SF, "lineitem").count()
    assert len(made) >= lines / 20_000 and spark.read.text([str(p) for p in made]).count() == lines


def test_heat_pump_summaries_write_samples_in_one_pass(spark, monkeypatch):
    made, write = [], queries.staged
    monkeypatch.setattr(queries, "staged", lambda s, d, name, *a: made.append((name, len(a))) or write(s, d, name, *a))
    assert queries.QUERIES["pump_kpis"](spark, SF + "/.").count()
    assert ("gold_hourly_detail", 1) in made and ("samples", 1) in made and not {n for n, _ in made} & {"raw_logs"}


def test_the_digest_of_a_sample_is_stored_and_read_alone(spark):
    table = queries.pump_repeats(spark, SF)
    plain = table.drop("_content")
    assert not table.select(gold.tie_order(table).alias("t"), gold.tie_order(plain).alias("p")).where("t <> p").count()
    for made in (gold.hourly_detail, gold.daily_summary):
        read = made(table)._jdf.queryExecution().executedPlan().toString()
        assert "bt63_hw_supply_c" not in read and "bt63_hw_supply_c" in made(plain)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(("kind", "again"), [("ims", "/."), ("data_usage", "/./.")])  # another path each, so that the stream runs again
def test_a_fan_out_keeps_no_batch_in_memory(spark, monkeypatch, kind, again):
    in_memory, typed = [], streams.records.typed

    def watched(batch, k):
        in_memory.append(sum(i.memSize() for i in spark.sparkContext._jsc.sc().getRDDStorageInfo()))
        return typed(batch, k)

    monkeypatch.setattr(streams.records, "typed", watched)
    monkeypatch.setattr(streams.files_a_batch, "__defaults__", (streams.BATCHES, 500))
    small = SF.replace("0.01", "0.001")
    got = queries.QUERIES[f"fan_out_{kind}"](spark, small + again)
    assert len(in_memory) >= len(streams.KINDS) and not any(in_memory)
    want = queries.QUERIES[f"typed_{kind}"](spark, small)
    assert got.count() == want.count() > 0 and got.exceptAll(want).count() == 0
