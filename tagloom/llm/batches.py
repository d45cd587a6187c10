"""Bounded Arrow batches for functions over whole texts."""

from __future__ import annotations

from pyspark.sql import SparkSession

ROWS, BYTES = 1000, 8 << 20

_ROWS, _BYTES = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batches to ROWS rows and BYTES bytes; smaller ones stay.

    Spark's default of 10,000 rows is meant for numbers. With whole texts it makes every Python
    process, and the buffers that feed it, hold tens of megabytes several times over.
    """
    for key, most in ((_ROWS, ROWS), (_BYTES, BYTES)):
        now = spark.conf.get(key, None)
        size = int(now) if now is not None and now.lstrip("-").isdigit() else 0
        if not 0 < size <= most:
            spark.conf.set(key, str(most))
