"""Registered queries that read real files: the feed written as text, taken in by the library's own readers.

Logs are tab-separated lines with header rows, bad times and rows cut short; JSON records
are lines of which some hold text where a number belongs and some are no JSON.  File names
are Spark's, so of the lineage only what follows from it is compared: the path ends with the
name, and the time of ingestion is there.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from millrace.plans import jsonfiles
from millrace.plans.heatpump import logs
from millrace.sources.files import read_lines
from millrace.sources.tables import read_table
from millrace.streaming.tables import append_stream
from millrace.suite import feeds
from millrace.suite.oracle import ORACLE, RAW
from millrace.suite.queries import query
from millrace.suite.sqltext import fin
from millrace.suite.staging import stage_root

_landed: set[str] = set()
FILE_LINES = 500_000  # a compressed file is read by one task
SHORT, SHORT_FIELDS = "('777', '333', '555', '901')", 12  # compressor frequencies whose lines are cut


def landed(spark, sf_dir: str, name: str, lines: Callable[[], DataFrame]) -> str:
    """Folder of compressed text files of at most ``FILE_LINES`` lines each, written once per application."""
    path = f"{stage_root(spark, sf_dir)}/landing_{name}"
    if path not in _landed:
        lines().write.mode("overwrite").options(compression="gzip", maxRecordsPerFile=FILE_LINES).text(path)
        _landed.add(path)
    return path


def log_files(spark, sf_dir: str) -> str:
    def lines() -> DataFrame:
        whole = F.concat_ws("\t", *logs.LOG_COLUMNS)
        cut = F.concat_ws("\t", *logs.LOG_COLUMNS[:SHORT_FIELDS])
        return feeds.pump_log(spark, sf_dir).select(F.when(F.expr(f"compr_freq_act_raw IN {SHORT}"), cut).otherwise(whole).alias("value"))

    return landed(spark, sf_dir, "logs", lines)


def _named(df: DataFrame) -> DataFrame:
    named = F.expr("endswith(_source_file, _source_filename) AND _source_filename LIKE 'part-%' AND _ingested_at IS NOT NULL")
    return df.withColumn("named", named).drop("_source_file", "_source_filename", "_ingested_at")


@query
def file_raw_logs(spark, sf_dir):
    """Log files to raw rows with lineage."""
    return _named(logs.raw_logs(spark, log_files(spark, sf_dir), stream=False))


@query
def file_raw_logs_stream(spark, sf_dir):
    """The same by a stream that takes files as they come."""
    out = f"{stage_root(spark, sf_dir)}/streams/{uuid.uuid4().hex}"
    append_stream(logs.raw_logs(spark, log_files(spark, sf_dir)), f"{out}/rows", f"{out}/checkpoint").awaitTermination()
    return _named(read_table(spark, f"{out}/rows"))


@query
def file_lines(spark, sf_dir):
    """Log files as plain lines."""
    rows = read_lines(spark, log_files(spark, sf_dir), stream=False)
    return rows.select("raw_line", F.expr("_source_filename LIKE 'part-%' AND _source_modified_at IS NOT NULL").alias("named"))


def json_files(spark, sf_dir: str) -> str:
    def lines() -> DataFrame:
        good = {n: F.expr(x).alias(n) for n, x in feeds.JSON_FIELDS.items() if n != "_rescued_data"}
        wrong = {**good, "fare_amount": F.lit("n/a").alias("fare_amount")}
        text = (
            F.when(F.expr(_MISTYPED), F.to_json(F.struct(*wrong.values()))).when(F.expr(_BROKEN), "{broken")
            .otherwise(F.to_json(F.struct(*good.values())))
        )
        return feeds.table(spark, sf_dir, "lineitem").select(text.alias("value"))

    return landed(spark, sf_dir, "json", lines)


_MISTYPED, _BROKEN = "l_discount >= 0.1 AND l_suppkey % 4 = 1", "l_discount >= 0.1 AND l_suppkey % 4 = 2"


def _json_rows(spark, sf_dir) -> DataFrame:
    return jsonfiles.json_records(spark, json_files(spark, sf_dir), stream=False, multiline=False)


@query
def file_json_records(spark, sf_dir):
    """JSON files with their rescue column and lineage."""
    return _json_rows(spark, sf_dir).select(
        "DOLocationID", "PULocationID", "fare_amount", "total_amount", F.col("_rescued_data").isNotNull().alias("rescued"),
        F.expr("endswith(source_file_name, file_name) AND file_name LIKE 'part-%' AND ingestion_timestamp IS NOT NULL").alias("named"),
        "ingestion_method",
    )


@query
def file_json_checked(spark, sf_dir):
    """Records that pass the rules."""
    return jsonfiles.raw_checked(_json_rows(spark, sf_dir)).select("DOLocationID", "PULocationID", "fare_amount", "total_amount")


def odd_json_files(spark, sf_dir: str) -> str:
    """Records of which some have a field of the wrong kind, a field nobody knows, both, or are no object."""

    def lines() -> DataFrame:
        known = {n: F.expr(x) for n, x in feeds.JSON_FIELDS.items() if n != "_rescued_data"}
        fare = F.when(F.expr(_TEXT_FARE), F.parse_json(F.lit('"n/a"'))).otherwise(F.expr(f"CAST({feeds.JSON_FIELDS['fare_amount']} AS VARIANT)"))
        place = F.when(F.expr(_PART_PLACE), F.expr("CAST(l_suppkey + 0.5BD AS VARIANT)")).otherwise(F.expr(f"CAST({feeds.JSON_FIELDS['PULocationID']} AS VARIANT)"))
        note = F.when(F.expr(_NOTE), F.struct(F.col("l_linestatus").alias("by")))
        text = F.to_json(F.struct(
            known["DOLocationID"].alias("DOLocationID"), place.alias("PULocationID"), fare.alias("fare_amount"), note.alias("note"),
            known["total_amount"].alias("total_amount"),
        ))
        return feeds.table(spark, sf_dir, "lineitem").select(F.when(F.expr(_BROKEN), "[1]").otherwise(text).alias("value"))

    return landed(spark, sf_dir, "json_odd", lines)


_TEXT_FARE, _PART_PLACE, _NOTE = "l_discount = 0.01", "l_linenumber = 3", "l_returnflag = 'R'"
_BY_FIELD = ["DOLocationID", "PULocationID", "fare_amount", "total_amount", "_rescued_data"]


@query
def file_json_by_field(spark, sf_dir):
    """JSON files of which only the fields that do not fit are rescued."""
    return jsonfiles.json_records_by_field(spark, odd_json_files(spark, sf_dir), stream=False).select(_BY_FIELD)


@query
def file_json_by_field_stream(spark, sf_dir):
    """The same by a stream."""
    out = f"{stage_root(spark, sf_dir)}/streams/{uuid.uuid4().hex}"
    rows = jsonfiles.json_records_by_field(spark, odd_json_files(spark, sf_dir)).select(_BY_FIELD)
    append_stream(rows, f"{out}/rows", f"{out}/checkpoint").awaitTermination()
    return read_table(spark, f"{out}/rows")


_cut = f"compr_freq_act_raw IN ({SHORT[1:-1].replace(chr(39), '')})"
_time = f"CASE WHEN {feeds.PUMP_BAD_TIME} THEN '99:99:99' ELSE strftime(ts, '%H:%M:%S.%f') END"


def _field(name: str) -> str:
    return "coalesce(CAST(eb101_bp4_raw AS STRING), 'ERR')" if name == "eb101_bp4_raw" else f"CAST({name} AS STRING)"


_registers = [c for c in logs.LOG_COLUMNS if c in feeds.PUMP_REGISTERS]
ORACLE["file_raw_logs"] = ORACLE["file_raw_logs_stream"] = fin(
    f"WITH {RAW} SELECT *, {_time} AS log_time, ts AS log_date, true AS named FROM raw", s=["log_time", "named"], day=["log_date"],
    x={n: f"CASE WHEN NOT ({_cut}) THEN {_field(n)} END" if logs.LOG_COLUMNS.index(n) >= SHORT_FIELDS else _field(n) for n in _registers},
)
_shown = {"log_date": f"CASE WHEN {feeds.PUMP_HEADER_ROW} THEN 'Divisors' ELSE strftime(ts, '%Y-%m-%d') END", "log_time": _time}
_line = [_shown.get(c) or _field(c) for c in logs.LOG_COLUMNS]
ORACLE["file_lines"] = (
    f"WITH {RAW.replace(f' WHERE NOT ({feeds.PUMP_HEADER_ROW})', '')} SELECT CASE WHEN {_cut} THEN concat_ws('\t', {', '.join(_line[:SHORT_FIELDS])}) "
    f"ELSE concat_ws('\t', {', '.join(_line)}) END AS raw_line, true AS named FROM raw"
)
_json = ", ".join(
    f"CASE WHEN {_BROKEN}{f' OR {_MISTYPED}' * (n == 'fare_amount')} THEN NULL ELSE {x} END AS {n}" for n, x in feeds.JSON_FIELDS.items() if n != "_rescued_data"
)
_read = f"SELECT {_json}, ({_BROKEN}) OR ({_MISTYPED}) AS rescued, true AS named, 'streaming' AS ingestion_method FROM lineitem"
_numbers = {"i": ["DOLocationID", "PULocationID"], "d": ["fare_amount", "total_amount"]}
ORACLE["file_json_records"] = fin(_read, **_numbers, s=["rescued", "named", "ingestion_method"])
ORACLE["file_json_checked"] = fin(
    f"SELECT * FROM ({_read}) z WHERE NOT rescued AND (DOLocationID IS NOT NULL OR PULocationID IS NOT NULL OR fare_amount IS NOT NULL OR total_amount IS NOT NULL)",
    **_numbers,
)
_values = {n: x for n, x in feeds.JSON_FIELDS.items() if n != "_rescued_data"}
_values["PULocationID"] = f"CASE WHEN NOT ({_PART_PLACE}) THEN {_values['PULocationID']} END"
_values["fare_amount"] = f"CASE WHEN NOT ({_TEXT_FARE}) THEN {_values['fare_amount']} END"
_odd = [
    f"CASE WHEN {_PART_PLACE} THEN concat('\"PULocationID\":', CAST(l_suppkey AS VARCHAR), '.5') END",
    f"CASE WHEN {_TEXT_FARE} THEN '\"fare_amount\":\"n/a\"' END",
    f"CASE WHEN {_NOTE} THEN concat('\"note\":{{\"by\":\"', l_linestatus, '\"}}') END",
]
_rescued = f"CASE WHEN {' OR '.join((_PART_PLACE, _TEXT_FARE, _NOTE))} THEN concat('{{', concat_ws(',', {', '.join(_odd)}), '}}') END"
ORACLE["file_json_by_field"] = ORACLE["file_json_by_field_stream"] = fin(
    "SELECT " + ", ".join(f"CASE WHEN NOT ({_BROKEN}) THEN {x} END AS {n}" for n, x in _values.items())
    + f", CASE WHEN {_BROKEN} THEN '[1]' ELSE {_rescued} END AS _rescued_data FROM lineitem", **_numbers, s=["_rescued_data"],
)
