"""Column helpers: labels, bands, bins, time arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rnd(x: str | Column, digits: int) -> Column:
    """Half-up rounding that is immune to floating-point noise.

    The value first passes through nine exact decimals, so 1.15 held as
    1.1499999999999999 rounds the same way whatever order its parts were summed in.
    What no decimal can hold (NaN, infinity, from 1e19 on) gives NULL.
    """
    return F.round(col(x).try_cast("decimal(28,9)"), digits).cast("double")


def label(code: str | Column, names: dict, default: str | None = None) -> Column:
    """Map codes to names; anything else (NULL included) gets ``default``."""
    out = None
    for value, name in names.items():
        test = col(code) == F.lit(value)
        out = F.when(test, name) if out is None else out.when(test, name)
    return out.otherwise(F.lit(default).cast("string"))


def band(x: str | Column, lower_edges: list[tuple[float, str]]) -> Column:
    """Half-open bands ``[edge, next edge)``; below the first edge the band is NULL."""
    out = None
    for edge, name in sorted(lower_edges, reverse=True):
        test = col(x) >= F.lit(float(edge))
        out = F.when(test, name) if out is None else out.when(test, name)
    return out


def bin_to(x: str | Column, step: float = 1.0) -> Column:
    """Nearest multiple of ``step``, for use as a group key."""
    if step == 1.0:
        return rnd(x, 0)
    return rnd(col(x) / F.lit(float(step)), 0) * F.lit(float(step))


def epoch_ts(seconds: str | Column) -> Column:
    return F.timestamp_seconds(col(seconds))


def elapsed_seconds(start: str | Column, end: str | Column) -> Column:
    """Whole elapsed seconds, truncated."""
    return F.timestamp_diff("SECOND", col(start), col(end)).cast("long")


def lookback(day: str | Column, as_of: str, days: int) -> Column:
    """Rows of the last ``days`` days up to a given date (no clock: results repeat)."""
    return col(day) >= F.date_sub(F.lit(as_of).cast("date"), days)


def on_day(day: str | Column, target: str) -> Column:
    return col(day) == F.lit(target).cast("date")


def in_period(day: str | Column, start: str, end: str) -> Column:
    return col(day).between(F.lit(start).cast("date"), F.lit(end).cast("date"))


def defaulted(name: str, value) -> Column:
    return F.coalesce(F.col(name), F.lit(value)).alias(name)
