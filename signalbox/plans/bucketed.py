"""V01 without fact shuffles: the three facts as bucketed, sorted catalog tables.

Each fact is stored in ``buckets`` buckets by ``service_details_id``, sorted in
them, so the whole-table wide view joins facts bucket by bucket: no Exchange
between a fact's scan and the join. Writing shuffles a fact once, by its id;
every later reader saves that shuffle. A load appends one file a bucket.

The session catalog names tables over a folder. Another session registers them
over the same folder with ``open_bucketed``.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import SparkSession

from .services import FACTS, ServiceTables

KEY = "service_details_id"


class BucketedTables(ServiceTables):
    """The star schema with its facts as bucketed tables (without ``run_month``)."""


def _database(spark: SparkSession, root: str) -> str:
    name = "bucketed_" + hashlib.sha1(root.encode()).hexdigest()[:12]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    return name


def append_bucketed(spark: SparkSession, t: ServiceTables, root: str, buckets: int) -> None:
    """Appends the facts of ``t`` to the bucketed tables under ``root``."""
    db = _database(spark, root)
    for name in FACTS:
        rows = getattr(t, name).drop("run_month")
        (rows.repartition(buckets, KEY).sortWithinPartitions(KEY).write.format("parquet").mode("append")
         .bucketBy(buckets, KEY).sortBy(KEY).option("path", f"{root}/{name}").saveAsTable(f"{db}.{name}"))


def open_bucketed(spark: SparkSession, t: ServiceTables, root: str, buckets: int) -> BucketedTables:
    """The tables under ``root`` with the dimensions of ``t``; registers them in
    a session that does not know them yet."""
    db = _database(spark, root)
    facts = {}
    for name in FACTS:
        if not spark.catalog.tableExists(f"{db}.{name}"):
            schema = spark.read.parquet(f"{root}/{name}").schema
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            spark.sql(f"CREATE TABLE {db}.{name} ({columns}) USING parquet CLUSTERED BY ({KEY}) SORTED BY ({KEY}) "
                      f"INTO {buckets} BUCKETS LOCATION '{root}/{name}'")
        facts[name] = spark.table(f"{db}.{name}")
    return BucketedTables(cancel_code=t.cancel_code, company=t.company, station=t.station, service_type=t.service_type, **facts)
