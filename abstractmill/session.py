"""Session settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    # Re-plan joins, coalesce small shuffle partitions and split skewed ones at run time.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Without call sites for every column; collecting them dominates short queries.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Dates and archive folders must not depend on where a job runs.
    "spark.sql.session.timeZone": "UTC",
    # Rows of long text: keep the batches sent to Python workers small.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


def get_session(app_name: str = "abstractmill", **overrides: str) -> SparkSession:
    """Return the active session or build one.

    Settings are passed as a mapping, for instance
    ``get_session(**{"spark.sql.shuffle.partitions": "4000"})``. The master is left to
    ``spark-submit``.
    """
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**DEFAULTS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
