"""Joins of summaries: base-and-parts, spines, pivots, baselines."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalars import bin_to


def left_join_all(base: DataFrame, parts: Sequence[DataFrame], on: Sequence[str]) -> DataFrame:
    """Left-join every part on the same key.

    Parts are grouped by that key already, so each has at most one row per key (no skew)
    and arrives partitioned by it; Spark picks broadcast or sort-merge from their size.
    """
    return reduce(lambda left, part: left.join(part, list(on), "left"), parts, base)


def spine_join(parts: Mapping[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """All keys seen in any part, with every part's columns.

    Same result as union + distinct + one left join per part, but each row of a part is
    tagged and the parts are folded together by one aggregation: one shuffle instead of
    one for the spine and one per join, and no part is computed twice.
    Each part must have one row per key.
    """
    values = [c for part in parts.values() for c in part.columns if c not in keys]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts.values())
    return stacked.groupBy(*keys).agg(*[F.max(c).alias(c) for c in values])


def pivot_band(df: DataFrame, keys: Sequence[str], band: str, picks: Mapping[str, tuple[str, str]]) -> DataFrame:
    """``out: (band value, column)`` picked from a table with one row per key and band."""
    return df.groupBy(*keys).agg(
        *[F.max(F.when(F.col(band) == value, F.col(c))).alias(out) for out, (value, c) in picks.items()]
    )


def baseline_residual(
    df: DataFrame, values: Mapping[str, str], bin_by: str, step: float, keys: Sequence[str] = ()
) -> DataFrame:
    """Value minus the median of all rows in the same bin (the row itself included).

    ``values`` maps a column to the name of its residual.  Rows without a bin get NULL.
    """
    binned = df.withColumn("_bin", bin_to(bin_by, step))
    medians = binned.groupBy(*keys, "_bin").agg(
        *[F.expr(f"percentile_disc(0.5D) WITHIN GROUP (ORDER BY `{c}`)").alias(f"_m_{c}") for c in values]
    )
    return (
        binned.join(medians, [*keys, "_bin"], "left")
        .withColumns({out: F.col(c) - F.col(f"_m_{c}") for c, out in values.items()})
        .drop("_bin", *[f"_m_{c}" for c in values])
    )


def json_rows(
    df: DataFrame,
    order_by: Sequence[str],
    keys: Sequence[str] = (),
    out: str = "result",
    leave_out: Sequence[str] = (),
) -> DataFrame:
    """Rows as one JSON array per ``keys`` (all rows if none), in a fixed order.

    Meant for lookback-bounded summary tables: the array of one key is one cell.
    """
    fields = [c for c in df.columns if c not in keys]
    ordered = [*order_by, *[c for c in fields if c not in order_by]]
    rows = F.array_sort(F.collect_list(F.struct(*ordered)))
    shown = [c for c in fields if c not in leave_out]
    in_field_order = F.transform(rows, lambda r: F.struct(*[r.getField(c).alias(c) for c in shown]))
    return df.groupBy(*keys).agg(F.to_json(in_field_order).alias(out))
