"""Daily report (R08): all report datasets of one day, written under the
report date and returned in long form (dataset, group key, metric, value)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import TOP_K
from ..operators import analytics as A
from ..sinks.files import write_dated
from .services import ServiceTables
from .wide_view import wide_services, yesterday

REPORT_COLUMNS = ["company_name", "origin_station_name", "service_uid", "arrival_lateness",
                  "cancel_code", "cancellation_id"]


BY_COMPANY, BY_STATION, OVERALL = 1, 2, 3  # grouping ids of (company, station)


def group_figures(day_view: DataFrame) -> DataFrame:
    """All sums by company, by station and over all, in one aggregate
    with grouping sets over one scan; a row of nulls stands in for an empty day,
    so the overall row is always there. Ranks are taken over the few groups."""
    spark = day_view.sparkSession
    columns = REPORT_COLUMNS
    rows = day_view.select(*columns, F.lit(1).alias("_real"))
    none = spark.range(1).select(*[F.lit(None).cast(day_view.schema[c].dataType).alias(c) for c in columns], F.lit(0).alias("_real"))
    company, station = F.col(A.COMPANY), F.col(A.STATION)
    g = rows.unionByName(none).groupingSets([[company], [station], []], company, station).agg(
        F.grouping_id().cast("int").alias("gid"), F.sum("_real").alias("services"), F.count("service_uid").alias("uids"),
        F.count("arrival_lateness").alias("delays"), F.sum("arrival_lateness").alias("lateness"),
        F.avg("arrival_lateness").alias("mean"), F.count("cancel_code").alias("codes"), F.count("cancellation_id").alias("cancelled"))
    g = g.withColumn("key", F.coalesce(company, station).cast("string"))
    g = g.where((F.col("gid") == OVERALL) | F.col("key").isNotNull())

    def rank(metric: str) -> Column:
        return F.row_number().over(Window.partitionBy("gid").orderBy(F.col(metric).desc_nulls_last(), F.col("key").asc_nulls_last()))
    return g.withColumns({"mean_rank": rank("mean"), "cancelled_rank": rank("cancelled")})


def report_datasets(day_view: DataFrame) -> DataFrame:
    """Every table and chart dataset of the report, in long form."""
    def row(dataset: str, metric: str, value: Column, gid: int, keep: Column | None = None) -> Column:
        wanted = F.col("gid") == gid if keep is None else (F.col("gid") == gid) & keep
        return F.when(wanted, F.struct(F.lit(dataset).alias("dataset"), F.lit(metric).alias("metric"), value.cast("double").alias("value")))
    top, some = F.col("mean_rank") <= TOP_K, F.col("cancelled") > 0
    mean, codes, cancelled = F.col("mean"), F.col("codes"), F.col("cancelled")
    rows = [
        row("services_per_station", "total_services", F.col("services"), BY_STATION),
        row("avg_delay_company_top", "avg_arrival_lateness", mean, BY_COMPANY, top),
        row("total_delay_company", "total_arrival_lateness", F.coalesce("lateness", F.lit(0)), BY_COMPANY),
        row("cancel_count_company", "cancel_code_count", codes, BY_COMPANY),
        row("mean_delay_station", "avg_arrival_lateness", mean, BY_STATION),
        row("cancel_count_station", "cancel_code_count", codes, BY_STATION),
        row("cancellations_station_top", "cancellation_count", cancelled, BY_STATION, some & (F.col("cancelled_rank") <= TOP_K)),
        row("cancellations_company", "cancellation_count", cancelled, BY_COMPANY, some),
        row("avg_delay_station_top", "avg_arrival_lateness", mean, BY_STATION, top),
        row("key_statistics", "total_services", F.col("uids"), OVERALL),
        row("key_statistics", "total_delays", F.col("delays"), OVERALL),
        row("key_statistics", "total_cancellations", cancelled, OVERALL),
        row("key_statistics", "avg_delay", mean, OVERALL),
    ]
    long = group_figures(day_view).select("key", F.explode(F.array_compact(F.array(*rows))).alias("r"))
    return long.select("r.dataset", F.col("key").alias("group_key"), "r.metric", "r.value")


def daily_report(t: ServiceTables, as_of, out_path: str | None = None) -> DataFrame:
    """R08 + K04: all datasets from one pass over the day view; with ``out_path``
    they are written under ``report_date=<day>``."""
    day = yesterday(as_of)
    view = wide_services(t, REPORT_COLUMNS, as_of=as_of)
    if out_path is None:
        return report_datasets(view)
    data = report_datasets(view)
    write_dated(data, out_path, day)
    return data.sparkSession.read.parquet(out_path).where(F.col("report_date") == F.lit(day)) \
        .select("dataset", "group_key", "metric", "value")
