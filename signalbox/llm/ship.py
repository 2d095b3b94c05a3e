"""Prepares a session for the operators with Python tasks."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..session import ship_package

#: Bytes of a batch that a Python task takes at once: texts may be very long.
BATCH_BYTES = "8m"


def ship(spark: SparkSession) -> None:
    """Hands the package to the executors and bounds the batches in bytes."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
