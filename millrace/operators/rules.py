"""Rules over summary rows: statuses, composite score, first reason, alerts, labels."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalars import on_day


@dataclass(frozen=True)
class Level:
    when: str
    status: str
    points: int = 0


@dataclass(frozen=True)
class Rule:
    """Levels are tried in order; a row that meets none (or compares with NULL) is OK."""

    name: str
    levels: tuple[Level, ...]

    def status(self) -> Column:
        return _first_match([(lv.when, F.lit(lv.status)) for lv in self.levels], F.lit("OK"))

    def points(self) -> Column:
        return _first_match([(lv.when, F.lit(lv.points)) for lv in self.levels], F.lit(0))


def _first_match(cases: Sequence[tuple[str, Column]], default: Column) -> Column:
    out = None
    for when, value in cases:
        out = F.when(F.expr(when), value) if out is None else out.when(F.expr(when), value)
    return out.otherwise(default)


def message(template: str) -> Column:
    """``"DM at {dm_min}"`` with column values filled in; NULL if a value is NULL."""
    pieces = re.split(r"\{(\w+)\}", template)
    parts = [F.lit(p) if i % 2 == 0 else F.col(p).cast("string") for i, p in enumerate(pieces) if p]
    return F.concat(*parts)


def score(
    df: DataFrame,
    rules: Sequence[Rule],
    overall: Sequence[tuple[str, str]],
    overall_default: str,
    reasons: Sequence[tuple[str, str]],
    reason_default: str,
    keep: Sequence[str],
) -> DataFrame:
    """Status per rule, total points, overall status, first matching reason, and the list
    of rules that are not OK.  Row-wise: no shuffle."""
    raised = F.array_compact(F.array(*[F.when(F.col(r.name) != "OK", F.lit(r.name)) for r in rules]))
    return (
        df.withColumns({r.name: r.status() for r in rules})
        .withColumn("anomaly_score", reduce(lambda a, b: a + b, [r.points() for r in rules]))
        .withColumn("overall_status", _first_match([(p, F.lit(s)) for p, s in overall], F.lit(overall_default)))
        .withColumn("top_issue", _first_match([(p, message(m)) for p, m in reasons], F.lit(reason_default)))
        .withColumn("raised", raised)
        .select(*keep, *[r.name for r in rules], "anomaly_score", "overall_status", "top_issue", "raised")
    )


@dataclass(frozen=True)
class Alert:
    """On yesterday's rows that meet ``when``: compare an aggregate of ``value`` with a limit."""

    name: str
    table: str
    when: str
    value: str
    aggregate: str  # max | min
    above: bool
    threshold: float


def evaluate_alerts(
    tables: Mapping[str, DataFrame], alerts: Sequence[Alert], as_of: str, day: str = "log_date", keys: Sequence[str] = ()
) -> DataFrame:
    """``(alert, rows, value, triggered)`` per key.  All alerts of one table share one scan
    of a single day, and the day filter reaches the scan."""
    per_table = []
    for name in dict.fromkeys(a.table for a in alerts):
        mine = [a for a in alerts if a.table == name]
        yesterday = tables[name].filter(F.col(day) == F.date_sub(F.lit(as_of).cast("date"), 1))
        aggregates = []
        for i, a in enumerate(mine):
            picked = F.when(F.expr(a.when), F.col(a.value).cast("double"))
            aggregates.append((F.max(picked) if a.aggregate == "max" else F.min(picked)).alias(f"_v{i}"))
            aggregates.append(F.count_if(F.expr(a.when)).alias(f"_n{i}"))
        lines = []
        for i, a in enumerate(mine):
            hit = F.col(f"_v{i}") > a.threshold if a.above else F.col(f"_v{i}") < a.threshold
            lines.append(F.struct(
                F.lit(a.name).alias("alert"),
                F.col(f"_n{i}").alias("rows"),
                F.col(f"_v{i}").alias("value"),
                F.lit(float(a.threshold)).alias("threshold"),
                F.coalesce(hit, F.lit(False)).alias("triggered"),
            ))
        per_table.append(yesterday.groupBy(*keys).agg(*aggregates).select(*keys, F.inline(F.array(*lines))))
    return reduce(lambda a, b: a.unionByName(b), per_table)


def problem_score(df: DataFrame, points: Sequence[tuple[str, int]], out: str = "problem_score") -> DataFrame:
    """Sum of the points of all conditions that hold."""
    terms = [F.when(F.expr(cond), F.lit(p)).otherwise(F.lit(0)) for cond, p in points]
    return df.withColumn(out, reduce(lambda a, b: a + b, terms))


def label_first(df: DataFrame, cases: Sequence[tuple[str, str]], out: str) -> DataFrame:
    """Name of the first condition that holds, NULL if none does."""
    return df.withColumn(out, _first_match([(c, F.lit(n)) for n, c in cases], F.lit(None).cast("string")))


def share_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key and their share of all rows in percent."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("records"))
    total = counts.agg(F.sum("records")).scalar()  # one value, whatever the data
    return counts.select(*keys, "records", (F.col("records") * F.lit(100.0) / total).alias("pct"))


__all__ = [
    "Alert", "Level", "Rule", "evaluate_alerts", "label_first", "message", "on_day", "problem_score", "score", "share_by",
]
