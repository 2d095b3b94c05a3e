"""File and relational sinks (K01-K04) and the JDBC source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", **options) -> None:
    """CSV with a header row, no index column; the folder is created."""
    df.write.mode(mode).option("header", True).options(**options).csv(path)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append",
               properties: dict | None = None, batch_size: int = 10_000) -> None:
    """Bulk insert into a relational table (one batched insert stream
    per partition; coalesce first to bound open connections)."""
    w = df.write.format("jdbc").option("url", url).option("dbtable", table) \
        .option("batchsize", batch_size).mode(mode)
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()


def read_jdbc(spark: SparkSession, url: str, query: str, partition_column: str, lower: int, upper: int,
              num_partitions: int, properties: dict | None = None) -> DataFrame:
    """A query against the warehouse, as parallel range reads on a numeric
    column. The caller sets the ranges: one task would read the whole table."""
    r = (spark.read.format("jdbc").option("url", url).option("dbtable", f"({query}) q")
         .option("partitionColumn", partition_column).option("lowerBound", lower)
         .option("upperBound", upper).option("numPartitions", num_partitions))
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    return r.load()


def write_dated(df: DataFrame, path: str, date_value, partition: str = "report_date") -> None:
    """Write under ``<partition>=<date>``; a rerun replaces that day only
    (dynamic partition overwrite)."""
    from pyspark.sql import functions as F
    (df.withColumn(partition, F.lit(date_value).cast("date")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path))
