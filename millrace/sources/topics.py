"""Message topics: reader options, stream and batch readers, record writer columns."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ENVELOPE = (
    "key binary, value binary, topic string, partition int, offset long, "
    "timestamp timestamp, timestampType int"
)


@dataclass(frozen=True)
class TopicSource:
    """Where messages come from.

    ``fmt="kafka"`` reads brokers (the connector has to be on the class path).  Any file
    format whose rows carry the ``ENVELOPE`` columns works in its place, with ``path``.
    """

    fmt: str = "kafka"
    servers: str | None = None
    path: str | None = None
    starting: str = "latest"
    security: dict = field(default_factory=dict)
    session_timeout_ms: int = 45_000
    request_timeout_ms: int = 60_000
    per_batch: int | None = None  # messages (files where they stand for topics) of one micro-batch at most

    def options(self, topics: Sequence[str]) -> dict[str, str]:
        if self.fmt != "kafka":
            return {"maxFilesPerTrigger": str(self.per_batch)} if self.per_batch else {}
        return {
            **({"maxOffsetsPerTrigger": str(self.per_batch)} if self.per_batch else {}),
            "kafka.bootstrap.servers": self.servers or "",
            "subscribe": ",".join(topics),
            "startingOffsets": self.starting,
            "failOnDataLoss": "false",
            "kafka.session.timeout.ms": str(self.session_timeout_ms),
            "kafka.request.timeout.ms": str(self.request_timeout_ms),
            **self.security,
        }


def sasl_options(username: str, password: str, login_module: str, protocol: str = "SASL_SSL") -> dict[str, str]:
    return {
        "kafka.security.protocol": protocol,
        "kafka.sasl.mechanism": "PLAIN",
        "kafka.sasl.jaas.config": f'{login_module} required username="{username}" password="{password}";',
    }


def read_topics(spark: SparkSession, source: TopicSource, topics: Sequence[str], stream: bool = True) -> DataFrame:
    """Messages of one or several topics in one DataFrame (several = multiplexed)."""
    reader = spark.readStream if stream else spark.read
    options = source.options(topics)
    if source.fmt == "kafka" and not stream:
        options["startingOffsets"] = "earliest"
    reader = reader.format(source.fmt).options(**options)
    if source.fmt == "kafka":
        return reader.load()
    return reader.schema(ENVELOPE).load(source.path).filter(F.col("topic").isin(*topics))


def record_messages(df: DataFrame, routes: dict[str, str], kind: str = "cdr_type", key: str = "user_id") -> DataFrame:
    """Rows as ``key, value, topic`` ready for ``write.format("kafka")``.

    The topic follows from the record type; rows of an unknown type have none and are
    left out, rows without a key get the key ``unknown``.
    """
    topic = None
    for name, target in routes.items():
        test = F.col(kind) == name
        topic = F.when(test, target) if topic is None else topic.when(test, target)
    return (
        df.select(
            F.coalesce(F.col(key).cast("string"), F.lit("unknown")).alias("key"),
            F.to_json(F.struct(*df.columns)).alias("value"),
            topic.alias("topic"),
        )
        .filter(F.col("topic").isNotNull())
    )
