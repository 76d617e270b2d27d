"""Session settings."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Shuffle partitions a cluster begins with; adaptive execution merges those that turn out small.
FIRST_PARTITIONS = "4000"


def build_session(app: str = "cohortrates", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, skew-join splitting and UTC dates.

    Joins carry no hints: adaptive execution broadcasts a side by its bytes and splits hot keys.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {} if master else {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": FIRST_PARTITIONS}
    settings |= {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # call-site capture costs more than building the plans does
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
