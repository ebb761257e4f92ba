from __future__ import annotations

import datetime as dt
import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from millrace.operators.cdc import dedup
from millrace.operators.quality import Expectation, keep_valid, observe_rules, rule_counts
from millrace.plans import jsonfiles
from millrace.sources.files import infer_json_schema
from millrace.sources.tables import Layout, export_csv, read_table, replace_partitions, write_table
from millrace.streaming.counts import RuleCounts, stored_counts
from millrace.streaming.tables import append_stream, compacted, current, dedup_stream, dedup_within, fan_out, late_rows, upsert_stream

GOOD = {"DOLocationID": 1, "PULocationID": 2, "fare_amount": 3.5, "total_amount": 4.0}


@pytest.fixture(scope="module")
def landing(tmp_path_factory):
    folder = tmp_path_factory.mktemp("json")
    bad = {**GOOD, "fare_amount": "n/a"}
    for name, total, wrong in (("full", 200, 0), ("low", 200, 1), ("medium", 100, 3), ("high", 100, 10)):
        lines = [json.dumps(bad if i < wrong else GOOD) for i in range(total)]
        (folder / f"{name}.json").write_text("\n".join(lines) + "\n")
    (folder / "odd.json").write_text('{"DOLocationID": 1, "surprise": 2}\n{}\n{broken\n')
    return str(folder)


def test_file_quality_is_measured_before_the_drop(spark, landing):
    records = jsonfiles.json_records(spark, landing, stream=False, multiline=False).cache()
    share = {r["file_name"]: r["data_quality_percentage"] for r in jsonfiles.metrics(records).collect()}
    assert (share["full.json"], share["low.json"], share["medium.json"], share["high.json"]) == (100.0, 99.5, 97.0, 90.0)
    alerts = {r["file_name"]: r["alert_severity"] for r in jsonfiles.alerts(records).collect()}
    assert alerts == {"low.json": "LOW", "medium.json": "MEDIUM", "high.json": "HIGH", "odd.json": "HIGH"}
    assert {r["malformed_records"] for r in jsonfiles.data_quality(records).filter("source_file_name LIKE '%full.json'").collect()} == {0}
    # kept: all good ones and the record with a surprise field; dropped: wrong, empty and broken
    assert jsonfiles.raw_checked(records).count() == 200 + 199 + 97 + 90 + 1
    assert jsonfiles.raw_basic(records).count() == 200 + 199 + 97 + 90 + 2


def test_a_wrong_field_keeps_the_good_ones(spark, landing):
    row = jsonfiles.json_records(spark, landing, stream=False, multiline=False).filter("file_name = 'low.json' AND _rescued_data IS NOT NULL").first()
    assert row["DOLocationID"] == 1 and row["fare_amount"] is None and "n/a" in row["_rescued_data"]


def test_multiline_and_inferred_schema(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(GOOD, indent=2))
    rows = jsonfiles.json_records(spark, str(tmp_path), stream=False, multiline=True).collect()
    assert [r["total_amount"] for r in rows] == [4.0]
    assert "`fare_amount` double" in infer_json_schema(spark, str(tmp_path), multiline=True)


def test_json_stream_equals_batch(spark, landing, tmp_path):
    stream = jsonfiles.raw_checked(jsonfiles.json_records(spark, landing, multiline=False))
    append_stream(stream, str(tmp_path / "o"), str(tmp_path / "c")).awaitTermination()
    batch = jsonfiles.raw_checked(jsonfiles.json_records(spark, landing, stream=False, multiline=False))
    clocks = ["ingestion_timestamp", "ingestion_date"]
    got = spark.read.parquet(str(tmp_path / "o")).drop(*clocks)
    assert got.exceptAll(batch.drop(*clocks)).count() == 0 and got.count() == batch.count()


EVENTS = [(f"u{i % 5}", i // 3, i, f"v{i}") for i in range(60)]
SCHEMA = "user_id string, seq int, off int, v string"


def wanted():
    best: dict = {}
    for row in EVENTS:
        if row[0] not in best or row[1:3] > best[row[0]][1:3]:
            best[row[0]] = row
    return sorted(best.values())


def _arrive(spark, src: str, rows: list, files: int, schema: str):
    for i in range(files):
        spark.createDataFrame(rows[i::files], schema).coalesce(1).write.mode("append").parquet(src)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)


@pytest.mark.parametrize("files", [1, 3, 12])
def test_upserts_any_split_any_order(spark, tmp_path, files):
    rows = EVENTS[:]
    random.Random(files).shuffle(rows)
    stream = _arrive(spark, str(tmp_path / "src"), rows, files, SCHEMA)
    keys, out = (["user_id"], ["seq", "off"]), str(tmp_path / "t")
    upsert_stream(stream, *keys, out, str(tmp_path / "cp")).awaitTermination()
    changes = spark.read.parquet(out)
    assert sorted(map(tuple, current(changes, *keys).collect())) == wanted()
    for through in range(files):
        base = compacted(changes.where(f"batch_id <= {through}"), *keys, str(tmp_path / f"base{through}"))
        assert base.count() <= 5
        assert sorted(map(tuple, current(changes, *keys, base).collect())) == wanted()
    again = compacted(changes, *keys, str(tmp_path / "again"), base)
    assert sorted(map(tuple, current(changes, *keys, again).collect())) == wanted()


def test_replayed_upserts_change_nothing(spark, tmp_path):
    keys, out, src, cp = (["user_id"], ["seq", "off"]), *(str(tmp_path / n) for n in ("t", "src", "cp"))
    stream = _arrive(spark, src, EVENTS, 2, SCHEMA)
    upsert_stream(stream, *keys, out, cp).awaitTermination()
    _forget_commit(cp, 1)
    upsert_stream(stream, *keys, out, cp).awaitTermination()
    changes = spark.read.parquet(out)
    assert changes.groupBy("batch_id", "user_id").count().agg(F.max("count")).first()[0] == 1
    assert sorted(map(tuple, current(changes, *keys).collect())) == wanted()


def _forget_commit(checkpoint: str, batch: int) -> None:
    """As after a crash between writing a batch and committing it."""
    for name in (f"{batch}", f".{batch}.crc"):
        path = Path(checkpoint) / "commits" / name
        if path.exists():
            path.unlink()


T0 = dt.datetime(2024, 1, 1)
DELIVERED = "k string, n int, ts timestamp, o int, v string"
# every third record is delivered twice, the second time much further on
RECORDS = [(f"k{i % 7}", None if i % 11 == 0 else i, T0 + dt.timedelta(minutes=i), i, f"v{i}") for i in range(240)]
TWICE = sorted([(r, r[3]) for r in RECORDS] + [((*r[:3], r[3] + 1000, r[4]), r[3] + 65) for r in RECORDS[::3]], key=lambda x: x[1])


@pytest.mark.parametrize(("files", "shuffled"), [(1, False), (3, False), (8, False), (8, True)])
def test_redeliveries_in_later_batches(spark, tmp_path, files, shuffled):
    rows = [r for r, _ in TWICE]
    size = -(-len(rows) // files)
    parts = [rows[i * size : i * size + size] for i in range(files)]
    if shuffled:
        random.Random(5).shuffle(parts)
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    for part in parts:
        spark.createDataFrame(part, DELIVERED).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(DELIVERED).option("maxFilesPerTrigger", 1).parquet(src)
    key = ["k", "n", "ts"]
    run = dedup_within(stream, key, "ts", "2 hours", out, str(tmp_path / "c"))
    run.awaitTermination()
    arrived, kept = spark.read.parquet(src), spark.read.parquet(out)
    late = late_rows(arrived, kept, key, ["o"])
    content = ["k", "n", "ts", "v"]
    both = kept.select(content).unionByName(late.select(content))
    assert sorted(both.collect(), key=repr) == sorted(dedup(arrived, key, ["o"]).select(content).collect(), key=repr)
    dropped = sum(op.numRowsDroppedByWatermark for p in run.recentProgress for op in p.stateOperators)
    assert (late.count() > 0) == shuffled and late.count() <= dropped
    if files == 8 and not shuffled:  # repeats came in another batch than what they repeat
        per_batch = sum(len({(r[0], r[1], r[2]) for r in part}) for part in parts)
        assert per_batch > len(RECORDS) == kept.count()


def test_fan_out_writes_each_batch_once(spark, tmp_path):
    schema, cp = "topic string, n int", str(tmp_path / "cp")
    stream = _arrive(spark, str(tmp_path / "src"), [(f"t{i % 3}", i) for i in range(90)], 3, schema)
    tables = {f"t{i}": lambda batch, _i=i: batch.where(F.col("topic") == f"t{_i}").withColumn(f"only_{_i}", F.lit(_i)) for i in range(3)}
    for _ in range(2):
        run = fan_out(stream, tables, lambda name: str(tmp_path / name), cp)
        run.awaitTermination()
        _forget_commit(cp, 2)
    for i in range(3):
        got = spark.read.parquet(str(tmp_path / f"t{i}"))
        assert sorted(r["n"] for r in got.collect()) == list(range(i, 90, 3)) and f"only_{i}" in got.columns


def test_fan_out_holds_a_batch_outside_of_memory_and_reads_it_once(spark, tmp_path):
    cp, in_memory = str(tmp_path / "cp"), []
    stream = _arrive(spark, str(tmp_path / "src"), [(f"t{i % 3}", i) for i in range(90)], 2, "topic string, n int").withColumn("read", F.expr("uuid()"))

    def rows(batch):
        in_memory.extend(i.memSize() for i in spark.sparkContext._jsc.sc().getRDDStorageInfo())
        return batch

    fan_out(stream, dict.fromkeys("abc", rows), lambda name: str(tmp_path / name), cp).awaitTermination()
    assert not any(in_memory)
    a, b, c = (sorted(spark.read.parquet(str(tmp_path / name)).select("topic", "n", "read").collect()) for name in "abc")
    assert a == b == c and len(a) == 90
    assert not [p for p in Path(cp).rglob("*.parquet") if spark.read.parquet(str(p)).count()]


def test_counts_of_a_stream_survive_a_replay(spark, tmp_path):
    rules = {"nums": [Expectation("even", "n % 2 = 0"), Expectation("small", "n < 50", "warn"), Expectation("known", "n IS NOT NULL")]}
    schema, cp, counts = "n int", str(tmp_path / "cp"), str(tmp_path / "counts")
    rows = [(None if i % 9 == 0 else i,) for i in range(100)]
    stream = _arrive(spark, str(tmp_path / "src"), rows, 4, schema)
    listener = RuleCounts(spark, counts, rules).start()
    try:
        for _ in range(2):
            run = append_stream(keep_valid(observe_rules(stream, rules["nums"], "nums"), rules["nums"]), str(tmp_path / "out"), cp)
            run.awaitTermination()
            assert listener.ended(run.runId)
            _forget_commit(cp, 3)
    finally:
        listener.stop()
    want = rule_counts(spark.createDataFrame(rows, schema), rules["nums"], "nums").collect()
    assert sorted(stored_counts(spark, counts, rules).collect()) == sorted(want)
    assert spark.read.parquet(counts).select("batch_id").distinct().count() == 4


def test_stream_dedup_loses_no_late_row(spark, tmp_path):
    src, t0 = str(tmp_path / "src"), dt.datetime(2024, 1, 1)
    batches = [[("a", 1, t0, 5), ("a", 1, t0, 2), ("a", 2, t0, 3)], [("b", 1, t0 + dt.timedelta(days=90), 6)], [("c", 1, t0, 7), ("c", 1, t0, 8)]]
    for rows in batches:
        spark.createDataFrame(rows, "k string, n int, ts timestamp, o int").coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema("k string, n int, ts timestamp, o int").option("maxFilesPerTrigger", 1).parquet(src)
    dedup_stream(stream, ["k", "n"], ["o"], str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).select("k", "n", "o").collect()
    assert sorted(got) == [("a", 1, 2), ("a", 2, 3), ("b", 1, 6), ("c", 1, 7)]


def test_append_stream_reads_each_file_once(spark, tmp_path):
    src, out, cp = (str(tmp_path / n) for n in ("src", "out", "cp"))
    for round_ in (1, 2):
        spark.range(10).withColumn("r", F.lit(round_)).coalesce(1).write.mode("append").parquet(src)
        append_stream(spark.readStream.schema("id long, r int").parquet(src), out, cp).awaitTermination()
    assert spark.read.parquet(out).count() == 20


def test_continuous_trigger_runs_until_stopped(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    spark.range(5).coalesce(1).write.parquet(src)
    q = append_stream(spark.readStream.schema("id long").parquet(src), out, str(tmp_path / "cp"), trigger="continuous", every="1 second")
    q.processAllAvailable()
    assert q.isActive
    q.stop()
    assert spark.read.parquet(out).count() == 5


def test_tables_and_touched_days(spark, tmp_path):
    lay = Layout(str(tmp_path), "dev", "pump")
    path = lay.path("gold", "daily")
    assert path.endswith("dev_gold/pump/daily")
    df = spark.createDataFrame([(1, "d1"), (2, "d2")], "x int, day string")
    write_table(df, path, partition_by=["day"])
    replace_partitions(spark.createDataFrame([(9, "d2")], "x int, day string"), path, ["day"])
    assert sorted((r["x"], r["day"]) for r in read_table(spark, path).collect()) == [(1, "d1"), (9, "d2")]
    flat = lay.path("gold", "flat")
    write_table(spark.range(100), flat, cluster_by=["id"], clusters=4)
    assert read_table(spark, flat).count() == 100
    export_csv(df, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 2
