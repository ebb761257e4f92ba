"""Summaries declared as data.

A ``Metric`` names one output column: what to aggregate, over which rows and how to
round it.  ``summarise`` turns a list of them into one ``groupBy().agg()``, so any
number of conditional metrics costs one pass and one map-side-combined shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalars import rnd  # noqa: F401

@dataclass(frozen=True)
class Metric:
    """``how`` over ``expr`` for rows where ``when`` holds.

    avg min max sum std        plain aggregates of ``expr``
    count                      rows (where ``when`` holds)
    pct                        share of rows with ``expr`` true, in percent, of the rows
                               where ``of`` holds (all rows if not given); NULL if none
    quantile                   ``p``-quantile, nearest rank, exact at any size: its state is a
                               count per distinct value, combined map-side
    spread                     ``p``-quantile minus (1 - ``p``)-quantile
    first last                 ``expr`` at the smallest / largest ``by``
    mode                       most frequent value, smallest on a tie
    any                        1 if ``expr`` is ever true, else 0
    distinct                   number of distinct values
    set                        sorted array of distinct values
    """

    name: str
    how: str
    expr: str = "1"
    when: str | None = None
    digits: int | None = None
    of: str | None = None
    by: str | None = None
    p: float = 0.5

    def column(self) -> Column:
        return F.expr(self.sql()).alias(self.name)

    def value(self) -> str:
        return f"({self.expr})" if self.when is None else f"CASE WHEN {self.when} THEN ({self.expr}) END"

    def sql(self) -> str:
        out = _SQL[self.how].format(v=self.value(), m=self, by=self.by, p=self.p, q=round(1 - self.p, 12),
                                    base="count(1)" if self.of is None else f"count_if({self.of})",
                                    rows="count(1)" if self.when is None else f"count_if({self.when})")
        if self.digits is not None:  # see scalars.rnd
            out = f"CAST(round(TRY_CAST({out} AS DECIMAL(28,9)), {self.digits}) AS DOUBLE)"
        return out


_SQL = {
    "avg": "avg({v})",
    "min": "min({v})",
    "max": "max({v})",
    "sum": "sum({v})",
    "std": "stddev_samp({v})",
    "count": "{rows}",
    "pct": "try_divide(count_if({v}) * 100D, {base})",
    "quantile": "percentile_disc({p}D) WITHIN GROUP (ORDER BY {v})",
    "spread": "percentile_disc({p}D) WITHIN GROUP (ORDER BY {v}) - percentile_disc({q}D) WITHIN GROUP (ORDER BY {v})",
    "first": "min_by({v}, {by})",
    "last": "max_by({v}, {by})",
    "mode": "mode({v}, true)",
    "any": "coalesce(max(CAST({v} AS INT)), 0)",
    "distinct": "count(DISTINCT {v})",
    "set": "sort_array(collect_set({v}))",
}


# Aggregates whose state is an object per group.
_OBJECT_STATE = {"quantile", "spread", "mode", "set"}


def summarise(df: DataFrame, keys: Sequence[str | Column], metrics: Sequence[Metric]) -> DataFrame:
    """One aggregation, with value sets and (next to sketches) distinct counts on the side.

    *Sets*: a plain aggregate keeps fixed-width state in a hash map and never sorts.  One
    set among its metrics would turn all of it into object state, which falls back to
    sorting the rows once a task meets more than a few groups.  So sets are built from the
    distinct (keys, value) pairs, a narrow scan that shrinks before its shuffle.

    *Distinct counts*: Spark groups on the counted value first, and would build every
    sketch once per such value.
    """
    sets = [m for m in metrics if m.how == "set"]
    rest = [m for m in metrics if m.how != "set"]
    distinct = [m for m in rest if m.how == "distinct"]
    aside = [df.groupBy(*keys).agg(*[m.column() for m in distinct])] if (
        distinct and any(m.how in _OBJECT_STATE for m in rest)
    ) else []
    if aside:
        rest = [m for m in rest if m.how != "distinct"]
    if not rest:
        return df.groupBy(*keys).agg(*[m.column() for m in metrics])
    main = df.groupBy(*keys).agg(*[m.column() for m in rest])
    names = main.columns[: len(keys)]
    for m in sets:
        pairs = df.select(*keys, F.expr(m.value()).alias(m.name)).distinct()
        aside.append(pairs.groupBy(*names).agg(F.sort_array(F.collect_set(m.name)).alias(m.name)))
    for part in aside:
        main = _attach(main, part, names)
    return main


def _attach(main: DataFrame, part: DataFrame, names: Sequence[str]) -> DataFrame:
    """Join two summaries with one row per group on keys that may be NULL."""
    if not names:
        return main.withColumns({c: part.select(c).scalar() for c in part.columns})  # one row each
    right = part.withColumnsRenamed({n: f"_k_{n}" for n in names})
    on = [main[n].eqNullSafe(right[f"_k_{n}"]) for n in names]
    return main.join(right, on, "left").drop(*[f"_k_{n}" for n in names])
