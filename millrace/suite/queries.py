"""Registered queries: every operator and table on the supplied data."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import sketches
from millrace.functions.metrics import Metric, summarise
from millrace.functions.scalars import band, bin_to
from millrace.operators import cdc, quality, rules, series, summaries
from millrace.operators.episodes import episodes
from millrace.operators.envelope import envelope
from millrace.plans import jsonfiles
from millrace.plans.cdr import gold as cdr_gold
from millrace.plans.cdr import records
from millrace.plans.heatpump import gold, incremental, logs, reports, tools
from millrace.session import apply_runtime
from millrace.sources.tables import Layout
from millrace.sources.topics import record_messages
from millrace.suite import feeds
from millrace.suite.staging import stage_root, staged

Query = Callable[[SparkSession, str], DataFrame]
AS_OF = "2024-01-21"
DAY = "2024-01-15"
QUERIES: dict[str, Query] = {}


def canonical(df: DataFrame) -> DataFrame:
    """Comparable values: whole numbers as bigint, doubles to six places, dates and times as text."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = F.round(c.cast("decimal(28,9)"), 6).cast("double")
        elif isinstance(f.dataType, T.IntegralType):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c.cast("array<string>"), ",")
        elif isinstance(f.dataType, T.BinaryType):
            c = c.cast("string")
        out.append(c.alias(f.name))
    return df.select(*out)


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        apply_runtime(spark)
        return canonical(fn(spark, sf_dir))

    run.__name__ = fn.__name__
    QUERIES[fn.__name__] = run
    return fn


def _add(name: str, fn: Query) -> None:
    fn.__name__ = name
    query(fn)


# -- heat pump ---------------------------------------------------------------------

def pump_feed(spark, sf_dir):
    return logs.clean_log_rows(feeds.pump_log(spark, sf_dir))


def pump_raw(spark, sf_dir):
    """The raw table as written, text rows in file order: for streams, which need files.  Others read the text rows where they are made."""
    return staged(spark, sf_dir, "raw_logs", lambda: pump_feed(spark, sf_dir))


def _sample_table(spark, sf_dir, name, feed, keys):
    """Samples as written: text to typed rows in one pass, in the order of the files, with the digest that orders samples at one instant."""

    def build():
        table = logs.samples(feed(), ("device",))
        return table.withColumn(gold.CONTENT, gold.content(table.drop("device")))

    table = staged(spark, sf_dir, name, build)
    return table.drop(gold.CONTENT) if keys else table.drop("device")  # the digest leaves out the device


def pump(spark, sf_dir, keys=()):
    """The sample table as written."""
    return _sample_table(spark, sf_dir, "samples", lambda: pump_feed(spark, sf_dir), keys)


def pump_repeats(spark, sf_dir, keys=()):
    """The sample table of a device whose files overlap: some instants occur twice."""
    return _sample_table(spark, sf_dir, "samples_repeats", lambda: feeds.with_repeats(pump_feed(spark, sf_dir)), keys)


# Ordered work decides which of several samples at one instant counts; the others see all rows.
ORDERED = "current_state hourly_detail daily_summary data_quality alarm_episodes defrost_cycles dhw_cycles cycles".split()


@query
def raw_logs(spark, sf_dir):
    return pump_feed(spark, sf_dir).drop("device")


@query
def samples(spark, sf_dir):
    return logs.samples(pump_feed(spark, sf_dir))


@query
def sample_rule_counts(spark, sf_dir):
    return quality.rule_counts(logs.parse_logs(pump_feed(spark, sf_dir)), logs.SAMPLE_RULES, "samples")


for _name in (
    "alarm_events current_state hourly_stats hourly_detail daily_summary flow_quality heating_curve data_quality "
    "alarm_episodes defrost_cycles dhw_cycles cycles"
).split():
    _add(_name, lambda spark, sf_dir, _n=_name: getattr(gold, _n)((pump_repeats if _n in ORDERED else pump)(spark, sf_dir)))


@query
def daily_summary_per_device(spark, sf_dir):
    return gold.daily_summary(pump_repeats(spark, sf_dir, ("device",)), ("device",))


@query
def cycles_per_device(spark, sf_dir):
    return gold.cycles(pump(spark, sf_dir, ("device",)), ("device",))


def in_loads(spark, sf_dir, samples: DataFrame) -> Layout:
    """Compressor runs after three loads: whole days, then parts of days, then late hours of days long loaded."""
    tables = Layout(f"{stage_root(spark, sf_dir)}/loads/{uuid.uuid4().hex}")
    load = F.when(F.crc32(F.date_format("logged_at", "yyyy-MM-dd HH")) % 3 == 0, 3).otherwise(F.crc32(F.col("log_date_parsed").cast("string")) % 2 + 1)
    for n in (1, 2, 3):
        incremental.refresh(samples.filter(load <= n), samples.filter(load == n), tables, f"load-{n}", ("device",), {})
    return tables


@query
def incremental_cycles(spark, sf_dir):
    samples = pump(spark, sf_dir, ("device",))
    return incremental.cycles(samples, in_loads(spark, sf_dir, samples), ("device",))


@query
def cycle_summary(spark, sf_dir):
    return pump_tables(spark, sf_dir).build("cycle_summary")


class PumpTables(Mapping):
    """Summary tables by name, each written when first asked for: what query functions, reports
    and alerts read, as in a pipeline."""

    NAMES = (
        "daily_summary flow_quality heating_curve data_quality alarm_episodes defrost_cycles dhw_cycles hourly_detail "
        "cycles cycle_summary ml_features anomaly_rules"
    ).split()

    def __init__(self, spark, sf_dir):
        self.spark, self.sf_dir = spark, sf_dir

    def build(self, name: str) -> DataFrame:
        if name == "cycle_summary":
            return gold.cycle_summary(self["cycles"])
        if name == "ml_features":
            return gold.ml_features(*[self[n] for n in (
                "daily_summary", "flow_quality", "heating_curve", "cycle_summary", "data_quality")])
        if name == "anomaly_rules":
            return gold.anomaly_rules(self["ml_features"])
        return getattr(gold, name)(pump(self.spark, self.sf_dir))

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.NAMES:
            raise KeyError(name)
        return staged(self.spark, self.sf_dir, f"gold_{name}", lambda: self.build(name))

    def __iter__(self):
        return iter(self.NAMES)

    def __len__(self):
        return len(self.NAMES)


pump_tables = PumpTables

_add("ml_features", lambda spark, sf_dir: pump_tables(spark, sf_dir).build("ml_features"))
_add("anomaly_rules", lambda spark, sf_dir: pump_tables(spark, sf_dir).build("anomaly_rules"))


@query
def extended_rules(spark, sf_dir):
    tables = pump_tables(spark, sf_dir)
    return gold.extended_rules(tables["daily_summary"], tables["defrost_cycles"], tables["dhw_cycles"])


@query
def explained_alarms(spark, sf_dir):
    return gold.explain_alarms(pump_tables(spark, sf_dir)["alarm_episodes"]).select(
        "log_date", "episode_id", "alarm_number", "description", "severity"
    )


@query
def alerts(spark, sf_dir):
    tables = pump_tables(spark, sf_dir)
    return gold.alerts(tables["daily_summary"], tables["data_quality"], AS_OF)


# tools: typed rows
for _name in tools.LOOKBACK_TOOLS:
    _add(_name, lambda spark, sf_dir, _n=_name: tools.tool(_n, pump_tables(spark, sf_dir), AS_OF, 7))
_add("get_heater_daily", lambda spark, sf_dir: tools.heater_daily(pump_tables(spark, sf_dir), AS_OF, 7))
_add("get_heater_by_outdoor", lambda spark, sf_dir: tools.heater_by_outdoor(pump_tables(spark, sf_dir), AS_OF, 7))
_add("get_heating_curve", lambda spark, sf_dir: tools.tool("get_heating_curve", pump_tables(spark, sf_dir), AS_OF, 7))
_add("get_hourly_detail", lambda spark, sf_dir: tools.tool("get_hourly_detail", pump_tables(spark, sf_dir), target_date=DAY))
_add("get_worst_cycles", lambda spark, sf_dir: tools.tool("get_worst_cycles", pump_tables(spark, sf_dir), target_date=DAY, top_n=10))
_add("get_period_comparison", lambda spark, sf_dir: tools.tool(
    "get_period_comparison", pump_tables(spark, sf_dir), p1=("2024-01-01", "2024-01-10"), p2=("2024-01-08", "2024-01-20")))


# tools: the JSON text, read back into rows
@query
def flow_diagnosis_json(spark, sf_dir):
    made = tools.tool_json("get_flow_diagnosis", pump_tables(spark, sf_dir), as_of=AS_OF, lookback_days=7)
    row = "log_date string, freq_band string, delta_t_avg_k double, heater_pct double, samples bigint"
    return made.select(F.explode(F.from_json("result", f"array<struct<{row.replace(' ', ':').replace(',:', ',')}>>")).alias("r")).select("r.*")


@query
def heater_analysis_json(spark, sf_dir):
    made = tools.tool_json("get_heater_analysis", pump_tables(spark, sf_dir), as_of=AS_OF, lookback_days=7)
    shape = "struct<daily:array<struct<log_date:string>>,by_outdoor_temp:array<struct<bt1_rounded_c:double,samples:bigint>>>"
    parsed = made.select(F.from_json("result", shape).alias("r"))
    return parsed.select(
        F.size("r.daily").alias("days"),
        F.element_at("r.daily", 1)["log_date"].alias("first_day"),
        F.size("r.by_outdoor_temp").alias("buckets"),
        F.aggregate("r.by_outdoor_temp", F.lit(0).cast("bigint"), lambda a, x: a + x["samples"]).alias("samples"),
    )


def _read_back(name: str, field: str | None = None, **args) -> Query:
    """The JSON text of a tool, parsed to the columns and types of its typed rows."""

    def run(spark, sf_dir):
        tables = pump_tables(spark, sf_dir)
        part = {"part": field} if field else {}
        rows = T.ArrayType(tools.tool(name, tables, **args, **part).schema)
        shape = T.StructType([T.StructField(field, rows)]) if field else rows
        made = tools.tool_json(name, tables, **args).select(F.from_json("result", shape).alias("r"))
        return made.select(F.inline(F.col(f"r.{field}") if field else F.col("r")))

    return run


_recently = {"as_of": AS_OF, "lookback_days": 7}
for _name in (*tools.LOOKBACK_TOOLS, "get_heating_curve"):
    _add(f"{_name}_json", _read_back(_name, **_recently))
_add("get_hourly_detail_json", _read_back("get_hourly_detail", target_date=DAY))
_add("get_worst_cycles_json", _read_back("get_worst_cycles", target_date=DAY, top_n=10))
_add("get_period_comparison_json", _read_back("get_period_comparison", p1=("2024-01-01", "2024-01-10"), p2=("2024-01-08", "2024-01-20")))
_add("get_heater_daily_json", _read_back("get_heater_analysis", "daily", **_recently))
_add("get_heater_by_outdoor_json", _read_back("get_heater_analysis", "by_outdoor_temp", **_recently))


# quantiles from stored states
@query
def superheat_of_days(spark, sf_dir):
    """Quantiles of each day merged from the states of its hours, and whether their ranks are within the bound."""
    samples = pump(spark, sf_dir)
    states = staged(spark, sf_dir, "superheat_states", lambda: gold.superheat_states(samples))
    days = gold.superheat_quantiles(states, ["log_date"])
    running = gold.by_day(samples).filter(gold.ON)
    return sketches.rank_check(days, running, ["log_date"], "superheat_k", gold.SUPERHEAT_RANKS).drop(*gold.SUPERHEAT_RANKS)


@query
def price_quantiles(spark, sf_dir):
    """Quantiles of each line status over all time, merged from states by month."""
    rows = feeds.table(spark, sf_dir, "lineitem")
    ranks = {"p01": 0.01, "p25": 0.25, "p50": 0.5, "p99": 0.99}
    month = F.trunc("l_shipdate", "month").alias("month")
    states = staged(spark, sf_dir, "price_states", lambda: sketches.quantile_states(rows, ["l_linestatus", month], "l_extendedprice"))
    made = sketches.quantiles(states, ["l_linestatus"], ranks)
    return sketches.rank_check(made, rows, ["l_linestatus"], "l_extendedprice", ranks).drop(*ranks)


# reports
_add("pump_kpis", lambda spark, sf_dir: reports.kpis(pump_tables(spark, sf_dir)["hourly_detail"]))
_add("pump_daily_trend", lambda spark, sf_dir: reports.daily_trend(pump_tables(spark, sf_dir)["hourly_detail"]))
_add("alarm_list", lambda spark, sf_dir: reports.alarm_list(pump_tables(spark, sf_dir)["alarm_episodes"]).drop("start_time_str"))
_add("quality_list", lambda spark, sf_dir: reports.quality_list(pump_tables(spark, sf_dir)["data_quality"]))
_add("flow_by_band", lambda spark, sf_dir: reports.flow_by_band(pump_tables(spark, sf_dir)["flow_quality"], AS_OF, 14))
_add("flow_by_band_fallback", lambda spark, sf_dir: reports.flow_by_band(pump_tables(spark, sf_dir)["flow_quality"], "2025-01-01", 14))
_add("kpi_strip", lambda spark, sf_dir: reports.kpi_strip(pump_tables(spark, sf_dir)["daily_summary"], AS_OF, 14))
_add("raw_window", lambda spark, sf_dir: reports.raw_window(
    pump(spark, sf_dir), DAY, 9, ["bt25_supply_c", "bt71_return_c", "compr_freq_act_hz"]))
_add("minute_averages", lambda spark, sf_dir: reports.minute_averages(
    pump(spark, sf_dir), "2024-01-01", "2024-12-31", ["bt25_supply_c", "bt71_return_c", "compr_freq_act_hz"]))
_add("latest_quality", lambda spark, sf_dir: reports.latest_quality(pump_tables(spark, sf_dir)["data_quality"]))


# -- call-detail records ---------------------------------------------------------------

KINDS = list(records.SCHEMAS)


def messages(spark, sf_dir, kind):
    """Messages of one topic, made row by row where they are read; streams, which need files, write them first."""
    return feeds.cdr_messages(spark, sf_dir, kind, records.ROUTES[kind])


def delivered(spark, sf_dir, kind):
    """The same with some messages delivered twice."""
    return feeds.with_redeliveries(messages(spark, sf_dir, kind))


def user_messages(spark, sf_dir):
    return feeds.user_messages(spark, sf_dir, "telco-users")


def keyed(spark, sf_dir, kind):
    return envelope(messages(spark, sf_dir, kind), "keyed")


class Cdrs(Mapping):
    """Cleaned record tables by type: map-only, so each is made in the scan of the query that reads it, with its columns alone."""

    def __init__(self, spark, sf_dir):
        self.spark, self.sf_dir = spark, sf_dir

    def __getitem__(self, kind: str) -> DataFrame:
        if kind not in records.SCHEMAS:
            raise KeyError(kind)
        return records.typed(keyed(self.spark, self.sf_dir, kind), kind)

    def __iter__(self):
        return iter(KINDS)

    def __len__(self):
        return len(KINDS)


cdrs = Cdrs


def subscribers(spark, sf_dir) -> DataFrame:
    build = lambda: records.users(records.user_events(envelope(user_messages(spark, sf_dir), "keyed")))
    return staged(spark, sf_dir, "users", build)


# Raw envelopes.  JSON text differs between engines, so its length class is compared, and the
# clock columns are left out.
def _comparable(df: DataFrame, raw: str, *clocks: str) -> DataFrame:
    shape = F.when(F.col(raw).isNull(), "missing").when(F.col(raw).startswith("{"), "json").otherwise("broken")
    return df.drop(*clocks).withColumn(raw, shape)


_add("raw_plain", lambda s, d: _comparable(envelope(messages(s, d, "voice"), "plain"), "raw_data", "processing_time"))
_add("raw_keyed", lambda s, d: _comparable(keyed(s, d, "data_usage"), "_raw_json", "_ingested_at"))
_add("raw_offset", lambda s, d: _comparable(envelope(messages(s, d, "sms"), "offset"), "raw_data", "_ingested_at"))


@query
def raw_multiplex(spark, sf_dir):
    parts = [messages(spark, sf_dir, k) for k in records.MULTIPLEX]
    stacked = parts[0]
    for p in parts[1:]:
        stacked = stacked.unionByName(p)
    return _comparable(envelope(stacked, "plain"), "raw_data", "processing_time")


@query
def raw_users_parsed(spark, sf_dir):
    out = records.raw_users_parsed(user_messages(spark, sf_dir))
    return out.select("key", "topic", F.col("parsed_data.user_id").alias("user_id"),
                      F.col("parsed_data.location.city").alias("nested_city"), F.col("parsed_data.city").alias("flat_city"))


@query
def multiplex_check(spark, sf_dir):
    parts = [envelope(messages(spark, sf_dir, k), "plain") for k in records.MULTIPLEX]
    stacked = parts[0]
    for p in parts[1:]:
        stacked = stacked.unionByName(p)
    return records.multiplex_check(stacked).drop("test_timestamp")


_CLOCKS = ("bronze_processing_time", "silver_processing_time")
for _kind in records.RENAMED:
    _add(f"renamed_{_kind}", lambda s, d, _k=_kind: records.renamed(envelope(messages(s, d, _k), "plain"), _k).drop(*_CLOCKS))


@query
def renamed_users(spark, sf_dir):
    return records.renamed_users(records.raw_users_parsed(user_messages(spark, sf_dir))).drop(*_CLOCKS).drop("imei")


@query
def renamed_rule_counts(spark, sf_dir):
    raw = envelope(messages(spark, sf_dir, "data_usage"), "plain")
    return quality.rule_counts(records.renamed_unchecked(raw, "data_usage"), records.RENAMED_RULES["data_usage"], "data")


# Payload fields that this feed does not fill are left out of the comparison.
def _filled(df: DataFrame, kind: str) -> DataFrame:
    absent = [f.strip().split(" ")[0] for f in records.SCHEMAS[kind].split(",")]
    absent = [c for c in absent if c not in feeds.CDR_FIELDS[kind]]
    return df.drop(*absent, "_ingested_at", "_updated_at")


for _kind in KINDS:
    _add(f"typed_{_kind}", lambda s, d, _k=_kind: _filled(records.typed(keyed(s, d, _k), _k), _k))
    _add(f"strict_{_kind}", lambda s, d, _k=_kind: _filled(records.strict(envelope(delivered(s, d, _k), "offset"), _k), _k))


@query
def users_latest(spark, sf_dir):
    latest = records.users(records.user_events(envelope(user_messages(spark, sf_dir), "keyed")))
    return latest.drop("_ingested_at", "imei", "registration_date", "active")


@query
def strict_users(spark, sf_dir):
    out = records.strict_users(envelope(user_messages(spark, sf_dir), "offset"))
    return out.drop("_ingested_at", "_updated_at", "imei", "registration_date", "active")


@query
def strict_rule_counts(spark, sf_dir):
    raw = envelope(messages(spark, sf_dir, "roaming"), "offset")
    return quality.rule_counts(records.strict_unchecked(raw, "roaming"), records.strict_rules("roaming"), "roaming")


@query
def customer_360(spark, sf_dir):
    return cdr_gold.customer_360(subscribers(spark, sf_dir), cdrs(spark, sf_dir))


_add("daily_cdr_summary", lambda s, d: cdr_gold.daily_cdr_summary(cdrs(s, d)))
_add("roaming_summary", lambda s, d: cdr_gold.roaming_summary(cdrs(s, d)["roaming"]))
_add("anomaly_summary", lambda s, d: cdr_gold.anomaly_summary(subscribers(s, d), cdrs(s, d)))
_add("subscriber_kpis", lambda s, d: cdr_gold.subscriber_kpis(cdr_gold.customer_360(subscribers(s, d), cdrs(s, d))))
_add("by_plan", lambda s, d: cdr_gold.by_plan(cdr_gold.customer_360(subscribers(s, d), cdrs(s, d))))
_add("cdr_daily_trend", lambda s, d: cdr_gold.daily_trend(cdr_gold.daily_cdr_summary(cdrs(s, d))))
_add("top_data_users", lambda s, d: cdr_gold.top_data_users(cdr_gold.customer_360(subscribers(s, d), cdrs(s, d))))
_add("top_roamers", lambda s, d: cdr_gold.top_roamers(cdr_gold.roaming_summary(cdrs(s, d)["roaming"])))
_add("orphan_records", lambda s, d: cdr_gold.orphan_records(subscribers(s, d), cdrs(s, d)))
_add("type_distribution", lambda s, d: cdr_gold.type_distribution(cdrs(s, d)))
_add("anomaly_breakdown", lambda s, d: cdr_gold.anomaly_breakdown(cdrs(s, d)))


@query
def anomaly_labels(spark, sf_dir):
    parts = []
    for kind, df in cdrs(spark, sf_dir).items():
        if kind in cdr_gold.ANOMALY_CASES:
            found = cdr_gold.anomaly_labels(df, kind)
            parts.append(found.groupBy("label").agg(F.count(F.lit(1)).alias("records")).withColumn("cdr_type", F.lit(kind)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query
def record_routing(spark, sf_dir):
    made = record_messages(cdrs(spark, sf_dir)["voip"], records.ROUTES)
    back = F.from_json("value", "cdr_type string, chargeID string, sessionDuration int")
    return made.select("key", "topic", back.alias("p")).select("key", "topic", "p.*")


# -- JSON files --------------------------------------------------------------------------

def json_lines(spark, sf_dir):
    return feeds.json_feed(spark, sf_dir)


_add("json_basic", lambda s, d: jsonfiles.raw_basic(json_lines(s, d)))
_add("json_checked", lambda s, d: jsonfiles.raw_checked(json_lines(s, d)))
_add("file_quality", lambda s, d: jsonfiles.data_quality(json_lines(s, d)))
_add("ingestion_metrics", lambda s, d: jsonfiles.metrics(json_lines(s, d)))
_add("quality_alerts", lambda s, d: jsonfiles.alerts(json_lines(s, d)))
_add("json_rule_counts", lambda s, d: quality.rule_counts(json_lines(s, d), jsonfiles.FULL_RULES, "json"))


# -- single operators on the plain tables ------------------------------------------------

def events(spark, sf_dir):
    return feeds.table(spark, sf_dir, "events")


def user_day(spark, sf_dir):
    return events(spark, sf_dir).withColumn("day", F.to_date("ts"))


def is_error(get):
    return get("event_type") == "error"


@query
def latest_event_per_user(spark, sf_dir):
    return cdc.scd1(events(spark, sf_dir), ["user_id"], ["ts", "event_id"])


@query
def dedup_events(spark, sf_dir):
    twice = events(spark, sf_dir).withColumn("copy", F.lit(1)).unionByName(events(spark, sf_dir).withColumn("copy", F.lit(2)))
    return cdc.dedup(twice, ["user_id", "event_type", "value"], ["event_id", "copy"])


@query
def props_parsed(spark, sf_dir):
    return events(spark, sf_dir).select("event_id", F.from_json("props", "k int")["k"].alias("k"))


@query
def error_starts(spark, sf_dir):
    s = series.Series(("user_id", "day"), "ts", ("event_id",))
    return series.scan(user_day(spark, sf_dir), s, ["event_type"], {
        "start": series.rising(is_error), "stop": series.falling(is_error),
    }).select("event_id", "user_id", "start", "stop", "start_no", "stop_no", "stop_at")


@query
def error_runs(spark, sf_dir):
    """Runs that may cross midnight: the series restarts per user only."""
    s = series.Series(("user_id",), "ts", ("event_id",))
    return episodes(events(spark, sf_dir), s, series.rising(is_error), "event_type = 'error'", ["event_type"], [
        Metric("total", "sum", "cast(value as decimal(18,2))"),
        Metric("first_value", "first", "value", by="ts"),
        Metric("last_value", "last", "value", by="ts"),
    ])


@query
def type_changes(spark, sf_dir):
    """One series over the whole table, no key at all."""
    s = series.Series((), "ts", ("event_id",))
    coded = events(spark, sf_dir).withColumn("code", F.length("event_type"))
    return series.scan(coded, s, ["code"], {"change": series.changed("code", "code > 0")}).select(
        "event_id", "code", "change", "change_no", F.col("prev")["code"].alias("prev_code"),
        series.gap_seconds(s).alias("gap_seconds"), series.gap_interval(s, 600, 60).alias("gap_interval"),
    )


@query
def unique_seconds(spark, sf_dir):
    seconds = user_day(spark, sf_dir).withColumn("second", F.date_trunc("second", "ts").cast("timestamp_ntz"))
    s = series.Series(("day",), "second", ("event_id",))
    return series.unique_samples(seconds, s).select("event_id", "second")


@query
def line_percentiles(spark, sf_dir):
    return summarise(feeds.table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], [
        Metric("lines", "count"),
        *[Metric(f"price_p{p}", "quantile", "l_extendedprice", p=p / 100) for p in (10, 50, 90)],
        Metric("quantity_spread", "spread", "l_quantity", p=0.9),
        Metric("quantity_mode", "mode", "cast(l_quantity as int)"),
        Metric("orders", "distinct", "l_orderkey"),
    ])


@query
def price_bands(spark, sf_dir):
    edges = [(1_000, "01_low"), (20_000, "02_mid"), (60_000, "03_high")]
    li = feeds.table(spark, sf_dir, "lineitem")
    return summarise(li, [band("l_extendedprice", edges).alias("price_band"), bin_to("l_quantity", 5.0).alias("quantity_bin")], [
        Metric("lines", "count"), Metric("returned_pct", "pct", "l_returnflag = 'R'", digits=4),
    ])


@query
def activity_spine(spark, sf_dir):
    """(customer, day) keys of orders and events, both sides' figures, zeros where absent."""
    keys = ["user_id", "day"]
    parts = {
        "orders": summarise(
            feeds.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("user_id"), F.to_date("o_orderdate").alias("day"), "o_totalprice"),
            keys, [Metric("orders", "count"), Metric("spent", "sum", "cast(o_totalprice as decimal(18,2))")]),
        "events": summarise(user_day(spark, sf_dir), keys, [Metric("events", "count")]),
    }
    folded = summaries.spine_join(parts, keys)
    return folded.select(*keys, *[F.coalesce(c, F.lit(0)).alias(c) for c in ("orders", "spent", "events")])


@query
def daily_baseline(spark, sf_dir):
    """Deviation of each day's mean from the median of days with a similar count."""
    days = summarise(user_day(spark, sf_dir), ["day"], [
        Metric("n", "count"), Metric("mean", "avg", "cast(value as decimal(18,2))"),
    ]).withColumn("mean", F.round(F.col("mean").cast("decimal(28,9)"), 6).cast("double"))
    return summaries.baseline_residual(days, {"mean": "residual"}, "n", 20.0)


@query
def order_trend(spark, sf_dir):
    days = summarise(
        feeds.table(spark, sf_dir, "orders").withColumn("day", F.to_date("o_orderdate")), ["day"],
        [Metric("orders", "count")])
    days = series.moving_avg(days, {"orders": "orders_7"}, [], "day", 7)
    return series.delta(days, {"orders": "change"}, [], "day")


@query
def warn_rule_counts(spark, sf_dir):
    rows = feeds.table(spark, sf_dir, "customer")
    return quality.rule_counts(rows, [
        quality.Expectation("positive_balance", "c_acctbal >= 0", "warn"),
        quality.Expectation("known_nation", "c_nationkey BETWEEN 0 AND 24"),
    ], "customer")


@query
def segment_share(spark, sf_dir):
    return rules.share_by(feeds.table(spark, sf_dir, "customer"), ["c_mktsegment"])



@query
def calendar_windows(spark, sf_dir):
    """Spending of a customer over seven rows and over seven days, and the change since the row and since the day before."""
    spent = feeds.table(spark, sf_dir, "orders").groupBy("o_custkey", F.to_date("o_orderdate").alias("day")).agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("spent"))
    rows = series.moving_avg(spent, {"spent": "avg_7_rows"}, ["o_custkey"], "day")
    rows = series.moving_avg_days(rows, {"spent": "avg_7_days"}, ["o_custkey"], "day")
    rows = series.delta(rows, {"spent": "change_rows"}, ["o_custkey"], "day")
    return series.delta_days(rows, {"spent": "change_days"}, ["o_custkey"], "day")


@query
def calendar_spine(spark, sf_dir):
    """Orders of each day and priority, days without any included, with the sum of the last thirty days."""
    sold = feeds.table(spark, sf_dir, "orders").groupBy("o_orderpriority", F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("n"))
    rare = feeds.table(spark, sf_dir, "orders").where("o_totalprice > 400000").groupBy("o_orderpriority", F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("large"))
    rows = series.every_day(rare, ["o_orderpriority"], "day").join(sold, ["o_orderpriority", "day"], "left")
    rows = rows.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("n", "large")})
    return series.moving_avg_days(rows, {"large": "large_30"}, ["o_orderpriority"], "day", 30)


# active subscribers of any period, from one state per day and type
ACTIVE_DAYS = ("2024-01-03", "2024-01-20")


@query
def active_subscribers(spark, sf_dir):
    """Subscribers active in some types of records and not in others, over a period, from day states alone."""
    tables = cdrs(spark, sf_dir)
    states = staged(spark, sf_dir, "active_states", lambda: cdr_gold.active_states(tables))
    asked = {"voice": (["voice"], []), "voice_not_data": (["voice"], ["data_usage"]), "voice_and_sms": (["voice", "sms"], []), "roaming_not_mms": (["roaming"], ["mms"])}
    return cdr_gold.active_subscribers(states, *ACTIVE_DAYS, asked)
