"""Maximal runs of rows in one state, as one row per run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.metrics import Metric, summarise
from millrace.functions.scalars import elapsed_seconds, rnd
from millrace.operators.series import Edge, Series, scan


def episodes(
    df: DataFrame,
    s: Series,
    start: Edge,
    state: str,
    watch: Sequence[str],
    metrics: Sequence[Metric],
    number: str = "episode_id",
    also_by: Sequence[str] = (),
    min_rows: int = 1,
    floor_seconds: int | None = 5,
) -> DataFrame:
    """Runs of rows where ``state`` holds; a run begins at each ``start`` edge.

    Rows are numbered by the chunked scan; the grouping that follows combines map-side,
    so the length of a run does not matter.  ``floor_seconds`` keeps a one-row run from
    lasting zero minutes.
    """
    runs = scan(df, s, watch, {"start": start}).filter(F.expr(state)).withColumnRenamed("start_no", number)
    frame = [
        Metric("start_time", "min", s.ts),
        Metric("end_time", "max", s.ts),
        *metrics,
        Metric("samples", "count"),
    ]
    out = summarise(runs, [*s.keys, number, *also_by], frame)
    if min_rows > 1:
        out = out.filter(F.col("samples") >= min_rows)
    lasted = elapsed_seconds("start_time", "end_time")
    if floor_seconds is not None:
        lasted = F.greatest(lasted, F.lit(floor_seconds))
    return out.withColumn("duration_min", rnd(lasted / F.lit(60.0), 1))
