"""Rule counts of running streams, stored batch by batch."""

from __future__ import annotations

from collections.abc import Sequence
from threading import Event

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener

from millrace.operators.quality import Expectation

COUNTS = "dataset string, rule string, passed long, failed long"


class RuleCounts(StreamingQueryListener):
    """Stores what ``observe_rules`` counts on streams, by query and batch.

    Each progress report that names one of ``rules`` (dataset to its rules) becomes rows in a
    partition (query, batch_id) below ``path``.  The query is the one of the checkpoint, so a
    batch that is replayed after a restart overwrites its own counts.
    """

    def __init__(self, spark: SparkSession, path: str, rules: dict[str, Sequence[Expectation]]):
        self.spark, self.path, self.rules = spark, path.rstrip("/"), rules
        self._ended: dict[str, Event] = {}

    def start(self) -> RuleCounts:
        self.spark.streams.addListener(self)
        return self

    def stop(self) -> None:
        self.spark.streams.removeListener(self)

    def ended(self, run: str, timeout: float = 60) -> bool:
        """Wait until all counts of a finished run are stored: reports come after the batches."""
        return self._ended.setdefault(str(run), Event()).wait(timeout)

    def onQueryStarted(self, event) -> None:
        self._ended.setdefault(str(event.runId), Event())

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        rows = []
        for dataset, counted in progress.observedMetrics.items():
            if dataset in self.rules and counted["rows"]:
                rows += [(dataset, r.name, counted["rows"] - counted[r.name], counted[r.name]) for r in self.rules[dataset]]
        if rows:
            place = f"{self.path}/query={progress.id}/batch_id={progress.batchId}"
            self.spark.createDataFrame(rows, COUNTS).coalesce(1).write.mode("overwrite").parquet(place)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._ended.setdefault(str(event.runId), Event()).set()


def stored_counts(spark: SparkSession, path: str, rules: dict[str, Sequence[Expectation]]) -> DataFrame:
    """One row per dataset and rule over all stored batches, as ``rule_counts`` has it."""
    actions = {(d, r.name): r.action for d, some in rules.items() for r in some}
    action = F.element_at(F.create_map(*[F.lit(x) for (d, n), a in actions.items() for x in (f"{d} {n}", a)]), F.concat_ws(" ", "dataset", "rule"))
    counted = spark.read.parquet(path).groupBy("dataset", "rule").agg(F.sum("passed").alias("passed"), F.sum("failed").alias("failed"))
    return counted.select("dataset", "rule", action.alias("action"), "passed", "failed")
