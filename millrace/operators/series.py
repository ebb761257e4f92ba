"""Ordered time-series operators that do not need one task per series.

A plain ``lag().over(partitionBy(device, day))`` puts a whole device-day into one task,
and an unpartitioned running sum puts the whole table there.  Here every series is cut
into time chunks whose width follows from how dense the rows are: the table's rows, time
span and number of series are measured first, and a chunk gets ``CHUNK_ROWS`` rows of an
average series, be that an hour or a millisecond.  Windows run inside a chunk; what has to cross a chunk border
(last row, number of edges so far, time of the last edge) travels through a small table
with one row per chunk, which is windowed per series and joined back on the key the
rows are already partitioned by.  Results equal the single-window form exactly, whatever the
width, and the largest unit of work is one chunk.  A series much denser than the average has
more rows in its chunks, in proportion; rows at one instant always share a chunk.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.scalars import elapsed_seconds

# An edge looks at the current row (F.col) and at the previous one (the argument).
Edge = Callable[[Callable[[str], Column]], Column]

CHUNK = "_chunk"
CHUNK_ROWS = 2_000
EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


@dataclass(frozen=True)
class Series:
    """How rows are ordered: restart at ``keys``, order by ``ts`` then ``tie``.

    ``keys`` must not be NULL.  ``tie`` is only needed where ``ts`` repeats.  ``unique`` keeps
    only the first row, in tie order, of those at one instant of a series.
    ``chunk_seconds`` is measured (``fitted``) where it is not given.
    ``count_keys`` (a part of ``keys``) lets edge numbers run on over the other keys: with
    keys (device, day) and count_keys (device,) edges are numbered over all days, while
    every day still starts afresh.  The other keys must follow from ``ts``.
    """

    keys: tuple[str, ...]
    ts: str
    tie: tuple[str, ...] = ()
    chunk_seconds: float | None = None
    count_keys: tuple[str, ...] | None = None
    unique: bool = False

    @property
    def order(self) -> tuple[str, ...]:
        return (self.ts, *self.tie)

    @property
    def unit(self) -> list[str]:
        return [*self.keys, CHUNK]

    def inside(self):
        return Window.partitionBy(*self.unit).orderBy(*self.order)

    def across(self):
        return Window.partitionBy(*self.keys).orderBy(CHUNK)

    def before_counts(self):
        """All earlier chunks that count.  Chunk rows are few, even for one global series."""
        counted = self.keys if self.count_keys is None else self.count_keys
        rest = [k for k in self.keys if k not in counted]
        return Window.partitionBy(*counted).orderBy(CHUNK, *rest).rowsBetween(Window.unboundedPreceding, -1)

    def micros(self) -> Column:
        return F.expr(f"timestampdiff(MICROSECOND, {EPOCH}, cast(`{self.ts}` as timestamp_ntz))")

    def fitted(self, df: DataFrame) -> Series:
        """With a chunk width that fits the density of ``df``: one narrow aggregation."""
        if self.chunk_seconds is not None:
            return self
        series = F.approx_count_distinct(F.struct(*self.keys)) if self.keys else F.lit(1)
        found = df.agg(F.count(self.ts).alias("rows"), F.min(self.micros()).alias("low"), F.max(self.micros()).alias("high"), series.alias("series")).first()
        span = (found["high"] or 0) - (found["low"] or 0) + 1
        width = span * CHUNK_ROWS * max(1, found["series"]) / max(1, found["rows"]) / 1e6
        # series that restart per day do not span the table: no chunk needs more than its whole span
        return replace(self, chunk_seconds=max(1e-3, min(width, span / 1e6)))

    def chunk(self) -> Column:
        return F.floor(self.micros() / F.lit(max(1, round(self.chunk_seconds * 1_000_000))))

    def rank(self) -> Column:
        return F.col(self.ts) if not self.tie else F.struct(*self.order)


def _before(previous: Column) -> Callable[[str], Column]:
    return lambda name: previous.getField(name)


def _border_table(df: DataFrame, s: Series, cols: Sequence[str], edges: Mapping[str, Edge]) -> DataFrame:
    """One row per chunk: last row of the chunk before, edges and last edge time before."""
    names = list(dict.fromkeys([*cols, s.ts]))
    narrow = df.select(*dict.fromkeys([*s.keys, *s.order, *names, CHUNK]))
    if edges:
        narrow = narrow.withColumn("_p", F.lag(F.struct(*names)).over(s.inside()))
        inner = {e: F.col("_p").isNotNull() & F.coalesce(fn(_before(F.col("_p"))), F.lit(False)) for e, fn in edges.items()}
    else:
        inner = {}
    per_chunk = narrow.groupBy(*s.unit).agg(
        *[F.min_by(c, s.rank()).alias(f"_f_{c}") for c in names],
        *[F.max_by(c, s.rank()).alias(f"_l_{c}") for c in names],
        *[F.count_if(hit).alias(f"_n_{e}") for e, hit in inner.items()],
        *[F.max(F.when(hit, F.col(s.ts))).alias(f"_t_{e}") for e, hit in inner.items()],
    )
    last = F.struct(*[F.col(f"_l_{c}").alias(c) for c in names])
    keep_keys = [k for k in names if k not in s.keys]
    out = per_chunk.select(
        *s.unit,
        *[F.col(f"_f_{c}").alias(c) for c in keep_keys],
        F.lag(last).over(s.across()).alias("_tail"),
        *[F.col(f"_{x}_{e}") for e in inner for x in ("n", "t")],
    )
    past = s.across().rowsBetween(Window.unboundedPreceding, -1)
    for e, fn in edges.items():
        opens = F.coalesce(fn(_before(F.col("_tail"))), F.lit(False))
        out = out.withColumn(f"_n_{e}", F.col(f"_n_{e}") + opens.cast("long")).withColumn(
            f"_t_{e}", F.coalesce(F.col(f"_t_{e}"), F.when(opens, F.col(s.ts)))
        )
    return out.select(
        *s.unit,
        "_tail",
        *[F.coalesce(F.sum(f"_n_{e}").over(s.before_counts()), F.lit(0)).alias(f"_n0_{e}") for e in edges],
        *[F.last(f"_t_{e}", ignorenulls=True).over(past).alias(f"_t0_{e}") for e in edges],
    )


def _chunked(df: DataFrame, s: Series) -> DataFrame:
    """Rows with their chunk; equal times share one, so repeats are dropped inside it."""
    out = df.withColumn(CHUNK, s.chunk())
    if not s.unique:
        return out
    again = F.coalesce(F.lag(s.ts).over(s.inside()) == F.col(s.ts), F.lit(False))
    return out.withColumn("_again", again).filter(~F.col("_again")).drop("_again")


def scan(df: DataFrame, s: Series, cols: Sequence[str] = (), edges: Mapping[str, Edge] | None = None) -> DataFrame:
    """Add what each row needs to know about the rows before it.

    ``prev``          struct of ``cols`` and the time of the previous row (NULL on the first)
    ``<edge>``        whether the row is such an edge
    ``<edge>_no``     how many such edges up to and including this row (1, 2, ...)
    ``<edge>_at``     time of the latest such edge up to and including this row
    """
    edges = dict(edges or {})
    names = list(dict.fromkeys([*cols, s.ts]))
    s = s.fitted(df)
    df = _chunked(df, s)
    borders = _border_table(df, s, cols, edges)
    rows = df.withColumn("prev", F.lag(F.struct(*names)).over(s.inside()))
    drop = [CHUNK, "_tail", *[f"_{x}_{e}" for e in edges for x in ("n0", "t0")]]
    out = rows.join(borders, s.unit, "left").withColumn("prev", F.coalesce("prev", "_tail"))
    for e, fn in edges.items():
        out = out.withColumn(e, F.coalesce(fn(_before(F.col("prev"))), F.lit(False)))
    upto = s.inside().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for e in edges:
        out = out.withColumn(f"{e}_no", F.col(f"_n0_{e}") + F.sum(F.col(e).cast("long")).over(upto)).withColumn(
            f"{e}_at", F.coalesce(F.last(F.when(F.col(e), F.col(s.ts)), ignorenulls=True).over(upto), F.col(f"_t0_{e}"))
        )
    return out.drop(*drop)


# -- edges -------------------------------------------------------------------

# A state is a test on a row, given as a function of a column getter, so that the same
# test can be asked of the current and of the previous row.
State = Callable[[Callable[[str], Column]], Column]


def rising(state: State) -> Edge:
    """The state holds now and did not on the previous row (or there is none)."""
    return lambda prev: state(F.col) & ~F.coalesce(state(prev), F.lit(False))


def falling(state: State) -> Edge:
    """The state held on the previous row and does not now."""
    return lambda prev: ~F.coalesce(state(F.col), F.lit(False)) & F.coalesce(state(prev), F.lit(False))


def changed(code: str, active: str, missing: int = 0) -> Edge:
    """``code`` differs from the previous row while ``active`` holds."""

    def edge(prev):
        return F.expr(active) & (F.col(code) != F.coalesce(prev(code), F.lit(missing)))

    return edge


# -- operators over a scan ----------------------------------------------------


def gap_seconds(s: Series) -> Column:
    """Seconds since the previous row; NULL on the first row of a series."""
    return elapsed_seconds(F.col("prev").getField(s.ts), F.col(s.ts))


def gap_interval(s: Series, cap: int = 10, nominal: int = 5) -> Column:
    """Seconds a row stands for: its gap, at most ``cap``; the first row counts ``nominal``."""
    gap = gap_seconds(s)
    return F.when(gap.isNull(), F.lit(nominal)).otherwise(F.least(gap, F.lit(cap))).cast("long")


def with_gap(df: DataFrame, s: Series, cap: int = 10, nominal: int = 5) -> DataFrame:
    return scan(df, s).withColumn("gap_interval", gap_interval(s, cap, nominal)).drop("prev")


def unique_samples(df: DataFrame, s: Series) -> DataFrame:
    """Keep one row per (keys, time): the first in tie order."""
    return _chunked(df, replace(s.fitted(df), unique=True)).drop(CHUNK)


def moving_avg(df: DataFrame, cols: Mapping[str, str], keys: Sequence[str], order: str, rows: int = 7) -> DataFrame:
    """Mean over the last ``rows`` rows, for tables with one row per key and day."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(1 - rows, 0)
    return df.withColumns({out: F.avg(src).over(w) for src, out in cols.items()})


def delta(df: DataFrame, cols: Mapping[str, str], keys: Sequence[str], order: str) -> DataFrame:
    """Difference to the previous row, for tables with one row per key and day."""
    w = Window.partitionBy(*keys).orderBy(order)
    return df.withColumns({out: F.col(src) - F.lag(src).over(w) for src, out in cols.items()})


def _days(keys: Sequence[str], day: str):
    return Window.partitionBy(*keys).orderBy(F.unix_date(F.col(day).cast("date")))


def moving_avg_days(df: DataFrame, cols: Mapping[str, str], keys: Sequence[str], day: str, days: int = 7) -> DataFrame:
    """Mean over the rows of the last ``days`` calendar days, whatever days are missing."""
    w = _days(keys, day).rangeBetween(1 - days, 0)
    return df.withColumns({out: F.avg(src).over(w) for src, out in cols.items()})


def delta_days(df: DataFrame, cols: Mapping[str, str], keys: Sequence[str], day: str, days: int = 1) -> DataFrame:
    """Difference to the row ``days`` calendar days before; NULL where that day is missing."""
    w = _days(keys, day).rangeBetween(-days, -days)
    return df.withColumns({out: F.col(src) - F.first(src).over(w) for src, out in cols.items()})


def every_day(df: DataFrame, keys: Sequence[str], day: str) -> DataFrame:
    """``df`` with a row for each day between the first and the last of a key; new rows are NULL but for keys and day."""
    ends = df.groupBy(*keys).agg(F.min(day).alias("_from"), F.max(day).alias("_to"))
    spine = ends.select(*keys, F.explode(F.sequence("_from", "_to")).alias(day))
    return spine.join(df, [*keys, day], "left")


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], rows: int = 1) -> DataFrame:
    """Last row (or ``rows``) per key.  A bound on ``row_number()`` lets Spark cut each input partition to one
    row per key before the shuffle, so a hot key never gathers in one task."""
    desc = [F.col(c).desc() if isinstance(c, str) else c for c in order]
    w = Window.partitionBy(*keys).orderBy(*desc)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= rows).drop("_rn")


def top_n(df: DataFrame, score: str, ties: Sequence[str], n: int) -> DataFrame:
    return df.orderBy(F.col(score).desc(), *ties).limit(n)
