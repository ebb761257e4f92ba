"""Quantiles and distinct counts from states that merge.

A state is a binary column with one sketch per group.  Fine groups (hours, days) are stored;
coarser ones (days, periods) merge the states and never read the rows again.  Error bounds
follow from the parameters: with ``k`` = 400 a quantile's rank is off by less than
``RANK_ERROR`` with a confidence of 99 %; with ``bits`` = 14 a distinct count is exact up to
about 16,000 values and beyond that has a relative standard error of 0.8 %.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

K, RANK_ERROR = 400, 0.01
BITS = 14


def quantile_states(df: DataFrame, keys: Sequence[str | Column], value: str, when: str | None = None, k: int = K) -> DataFrame:
    """(keys, n, state) of ``value`` over the rows where ``when`` holds; NULLs are left out."""
    rows = df if when is None else df.filter(when)
    return rows.filter(F.expr(value).isNotNull()).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"kll_sketch_agg_double(CAST({value} AS DOUBLE), {k})").alias("state")
    )


def quantiles(states: DataFrame, keys: Sequence[str | Column], ranks: Mapping[str, float]) -> DataFrame:
    """(keys, n, one column per rank) from merged states."""
    merged = states.groupBy(*keys).agg(F.sum("n").alias("n"), F.expr("kll_merge_agg_double(state)").alias("state"))
    return merged.select(*merged.columns[:-1], *[F.expr(f"kll_sketch_get_quantile_double(state, {p}D)").alias(name) for name, p in ranks.items()])


def rank_check(made: DataFrame, rows: DataFrame, keys: Sequence[str], value: str, ranks: Mapping[str, float], error: float = RANK_ERROR) -> DataFrame:
    """``made`` with ``<name>_ok``: whether the true rank of each quantile among ``rows`` is within ``error``.

    One pass over the rows, folded before the shuffle; ``made`` has one row per key.
    """
    v = F.expr(value)
    joined = rows.select(*keys, v.alias("_v")).where("_v IS NOT NULL").join(made, list(keys))
    both = [(F.count_if(F.col("_v") < F.col(n)).alias(f"_lt_{n}"), F.count_if(F.col("_v") <= F.col(n)).alias(f"_le_{n}")) for n in ranks]
    counted = joined.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *[c for pair in both for c in pair])
    ok = {f"{n}_ok": (F.col(f"_lt_{n}") / F.col("_n") <= p + error) & (F.col(f"_le_{n}") / F.col("_n") >= p - error) for n, p in ranks.items()}
    return made.join(counted.withColumns(ok).select(*keys, *ok), list(keys), "left")


def distinct_states(df: DataFrame, keys: Sequence[str | Column], value: str, bits: int = BITS) -> DataFrame:
    """(keys, state) of the distinct values."""
    return df.groupBy(*keys).agg(F.expr(f"theta_sketch_agg({value}, {bits})").alias("state"))


def united(when: str, state: str = "state", bits: int = BITS) -> Column:
    """Union of the states of the rows where ``when`` holds, an empty one where there are none."""
    return F.expr(f"theta_union_agg(CASE WHEN {when} THEN {state} END, {bits})")
