"""Session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import warnings

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # The JVM never compiles methods above 8000 bytes.  Wide projections would exceed that
    # as one generated method; with this limit Spark runs them as split expressions instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}
RUNTIME = ("spark.sql.session.timeZone", "spark.sql.codegen.hugeMethodLimit")


def build_session(app: str = "millrace", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_runtime(spark: SparkSession) -> None:
    """The settings results and speed rely on, for a session that was built elsewhere."""
    for key in RUNTIME:
        spark.conf.set(key, DEFAULTS[key])


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by the cluster in ``spark.checkpoint.dir``.

    Where it is missing a cluster gets an error; a local session (tests, a laptop) gets a
    folder of its own, with a warning.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    chosen = tempfile.mkdtemp(prefix="millrace-")
    warnings.warn(f"spark.checkpoint.dir is not set; written tables go to {chosen}", stacklevel=2)
    spark.conf.set("spark.checkpoint.dir", chosen)
    return chosen
