"""Captured documents, rendered once per data folder into the run folder.

In production the documents are files that a fetch has left; here Spark
renders them from the driver tables (``sources.documents``). Queries over the
same data folder read the same files.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import compiled, path_exists, remove, rename, run_root
from ..sources import documents as D
from ..sources.binding import raw_service_rows
from ..sources.tables import Tables
from .store import inputs_digest

RENDERERS = {
    "order_services": D.order_services,
    "incident_messages": D.incident_messages,
    "operator_pages": D.operator_pages,
    "raw_services": raw_service_rows,
}
#: Rendered from another capture.
FROM_ORDERS = {"service_documents": D.service_documents, "station_searches": D.station_search_documents}


def capture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The documents ``name`` of a data folder; written when first asked for."""
    path = f"{run_root(spark)}/capture-{inputs_digest(spark, sf_dir)}/{name}"
    if not path_exists(spark, path):
        t = Tables(spark, sf_dir)
        rows = FROM_ORDERS[name](t, capture(spark, sf_dir, "order_services")) if name in FROM_ORDERS else RENDERERS[name](t)
        attempt = f"{path}-{uuid.uuid4().hex}"
        with compiled(spark):  # the renderers' projections are long
            rows.write.option("compression", "zstd").parquet(attempt)
        if not rename(spark, attempt, path):
            remove(spark, attempt)  # another rendering of the same inputs came first
    return spark.read.parquet(path)


def capture_all(spark: SparkSession, sf_dir: str) -> None:
    for name in [*RENDERERS, *FROM_ORDERS]:
        capture(spark, sf_dir, name)
