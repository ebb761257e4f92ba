"""Row expectations (drop, warn, fail) with counts, and file-level quality tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from millrace.functions.scalars import rnd


class ExpectationError(RuntimeError):
    pass


@dataclass(frozen=True)
class Expectation:
    """A named SQL predicate.  NULL counts as a violation."""

    name: str
    predicate: str
    action: str = "drop"  # drop | warn | fail

    def holds(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(False))


def _all_of(rules: Sequence[Expectation]) -> Column:
    out = F.lit(True)
    for rule in rules:
        out = out & rule.holds()
    return out


def keep_valid(df: DataFrame, rules: Sequence[Expectation]) -> DataFrame:
    """Apply the rules as plain row filters.

    Works the same on batch and streaming input.  ``warn`` rules never drop; a row that
    breaks a ``fail`` rule stops the query when it is reached.
    """
    dropping = [r for r in rules if r.action == "drop"]
    failing = [r for r in rules if r.action == "fail"]
    out = df.filter(_all_of(dropping)) if dropping else df
    for rule in failing:
        # the row filter is part of the plan, so the check cannot be pruned away
        out = out.filter(F.when(rule.holds(), F.lit(True)).otherwise(
            F.raise_error(F.lit(f"expectation {rule.name} violated")).cast("boolean")
        ))
    return out


def rule_counts(df: DataFrame, rules: Sequence[Expectation], dataset: str) -> DataFrame:
    """One row per rule: how many input rows passed and failed.  One pass, no shuffle of rows."""
    flags = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(r.holds()).alias(f"_{i}") for i, r in enumerate(rules)]
    )
    lines = F.array(*[
        F.struct(
            F.lit(dataset).alias("dataset"),
            F.lit(r.name).alias("rule"),
            F.lit(r.action).alias("action"),
            F.col(f"_{i}").alias("passed"),
            (F.col("_rows") - F.col(f"_{i}")).alias("failed"),
        )
        for i, r in enumerate(rules)
    ])
    return flags.select(F.inline(lines))


def observe_rules(df: DataFrame, rules: Sequence[Expectation], observation: Observation | str) -> DataFrame:
    """Count while the data flows (batch observation or streaming listener), without a second pass."""
    return df.observe(
        observation,
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(~r.holds()).alias(r.name) for r in rules],
    )


def require(df: DataFrame, rule: Expectation) -> DataFrame:
    """Run a check now; raise if any row violates it."""
    if df.filter(~rule.holds()).limit(1).count():
        raise ExpectationError(f"expectation {rule.name} violated: {rule.predicate}")
    return df


RESCUED = "_rescued_data IS NOT NULL AND _rescued_data != ''"


def file_quality(df: DataFrame, keys: Sequence[str], ingested: str) -> DataFrame:
    """Records, malformed records and first/last ingest per file."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("record_count"),
        F.count_if(F.expr(RESCUED)).alias("malformed_records"),
        F.min(ingested).alias("first_ingestion"),
        F.max(ingested).alias("last_ingestion"),
    )


def ingestion_metrics(df: DataFrame, keys: Sequence[str], ingested: str, file_path: str) -> DataFrame:
    """Per file and ingest date, on all rows *before* bad ones are dropped."""
    out = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.expr(RESCUED)).alias("malformed_records"),
        F.min(ingested).alias("first_record_timestamp"),
        F.max(ingested).alias("last_record_timestamp"),
    )
    valid = F.col("total_records") - F.col("malformed_records")
    # a file path is a group key, so a group holds one file
    files = F.col(file_path).isNotNull().cast("long") if file_path in keys else F.lit(None).cast("long")
    return out.withColumns({
        "valid_records": valid,
        "data_quality_percentage": rnd(valid / F.col("total_records") * F.lit(100.0), 2),
        "files_processed": files,
    })


def quality_alerts(metrics: DataFrame) -> DataFrame:
    """Files below 100 %, with severity and message."""
    share = F.col("data_quality_percentage")
    severity = F.when(share < 95, "HIGH").when(share < 99, "MEDIUM").otherwise("LOW")
    message = (
        F.when(share < 95, "Data quality below 95% - investigate malformed records")
        .when(share < 99, "Data quality below 99% - monitor for trends")
        .otherwise("Data quality acceptable")
    )
    return metrics.filter(share < 100).withColumns({"alert_severity": severity, "alert_message": message})
