"""Dashboard figures and chart datasets over the wide view.

Group keys that are null are dropped, as a pandas ``groupby`` does. Top-k is
``orderBy(...).limit(k)`` with the key as tie-break, which Spark plans as a
per-partition top-k plus a merge (TakeOrderedAndProject), never a full sort.
Rounding to 2 decimals is ``round(x * 100) / 100`` (half away from zero on
the scaled double), the same in Spark and in SQL engines.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import NO_REASON, NOT_REACHED, REACHED, TOP_K

STATION = "origin_station_name"
COMPANY = "company_name"


def round2(c: Column) -> Column:
    return F.round(c * 100) / 100


def pct(part: Column, whole: Column) -> Column:
    """part / whole * 100 as a double, null when whole is 0."""
    return part.cast("double") / F.nullif(whole, F.lit(0)).cast("double") * 100


def top_k(df: DataFrame, metric: str, key: str | Sequence[str], k: int | None = TOP_K) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    ordered = df.orderBy(F.col(metric).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in keys])
    return ordered.limit(k) if k else ordered


def filter_selected(view: DataFrame, column: str, selection=None) -> DataFrame:
    """Rows whose ``column`` is one of the selected values, a list or a
    one-column DataFrame; all of them count. An empty list keeps every row."""
    if selection is None:
        return view
    if isinstance(selection, DataFrame):
        sel = selection.select(F.col(selection.columns[0]).alias(column)).distinct()
        return view.join(sel, column, "left_semi")
    values = list(selection)
    return view.where(F.col(column).isin(values)) if values else view


def kpi_totals(view: DataFrame) -> DataFrame:
    """Services, delays (lateness > 0) and cancellations with percentages."""
    agg = view.agg(
        F.count(F.lit(1)).alias("total_services"),
        F.count_if(F.col("arrival_lateness") > 0).alias("total_delays"),
        F.count("cancellation_id").alias("total_cancellations"))
    return agg.select(
        "total_services", "total_delays",
        round2(pct(F.col("total_delays"), F.col("total_services"))).alias("delay_pct"),
        "total_cancellations",
        round2(pct(F.col("total_cancellations"), F.col("total_services"))).alias("cancellation_pct"))


def most_delayed_station(view: DataFrame) -> DataFrame:
    """Station of the row with the largest lateness (first service id on ties)."""
    rows = view.where(F.col("arrival_lateness").isNotNull())
    return (rows.orderBy(F.col("arrival_lateness").desc(), F.col("service_details_id").asc())
            .select(F.col(STATION).alias("most_delayed_station"),
                    F.col("arrival_lateness").alias("max_arrival_lateness"))
            .limit(1))


def busiest_station(view: DataFrame) -> DataFrame:
    """A03 (literal): the most frequent origin station over all services."""
    counts = (view.where(F.col(STATION).isNotNull()).groupBy(STATION)
              .agg(F.count(F.lit(1)).alias("service_count")))
    return top_k(counts, "service_count", STATION, 1)


def most_cancelled_station(view: DataFrame) -> DataFrame:
    """A03 (intent): the origin station with the most cancellations."""
    counts = (view.where(F.col(STATION).isNotNull() & F.col("cancellation_id").isNotNull())
              .groupBy(STATION).agg(F.count(F.lit(1)).alias("cancellation_count")))
    return top_k(counts, "cancellation_count", STATION, 1)


def avg_delay(view: DataFrame) -> DataFrame:
    """Mean of non-null lateness, 2 decimals."""
    return view.agg(round2(F.avg("arrival_lateness")).alias("avg_delay_minutes"))


def avg_delay_by(view: DataFrame, key: str, k: int | None = TOP_K) -> DataFrame:
    means = (view.where(F.col(key).isNotNull()).groupBy(key)
             .agg(F.avg("arrival_lateness").alias("avg_arrival_lateness")))
    return top_k(means, "avg_arrival_lateness", key, k)


def avg_delay_by_station(view: DataFrame, k: int | None = TOP_K, selection=None) -> DataFrame:
    """Mean lateness per origin station, top k."""
    return avg_delay_by(filter_selected(view, STATION, selection), STATION, k)


def cancellations_by(view: DataFrame, key: str, k: int | None = TOP_K) -> DataFrame:
    counts = (view.where(F.col(key).isNotNull() & F.col("cancellation_id").isNotNull())
              .groupBy(key).agg(F.count(F.lit(1)).alias("cancellation_count")))
    return top_k(counts, "cancellation_count", key, k)


def cancellations_by_station(view: DataFrame, k: int | None = TOP_K, selection=None) -> DataFrame:
    """Cancelled services per origin station, top k."""
    return cancellations_by(filter_selected(view, STATION, selection), STATION, k)


def bus_replacements(view: DataFrame, k: int | None = TOP_K, selection=None) -> DataFrame:
    """Bus services per origin station, top k."""
    v = filter_selected(view, STATION, selection)
    counts = (v.where(F.col(STATION).isNotNull() & (F.col("service_type_name") == "bus"))
              .groupBy(STATION).agg(F.count(F.lit(1)).alias("bus_replacement_count")))
    return top_k(counts, "bus_replacement_count", STATION, k)


def bus_replacements_total(view: DataFrame, k: int | None = TOP_K, selection=None) -> DataFrame:
    """Total of the kept top-k rows (the donut's centre figure)."""
    return bus_replacements(view, k, selection).agg(
        F.coalesce(F.sum("bus_replacement_count"), F.lit(0)).alias("total_bus_replacements"))


def destination_status(view: DataFrame, selection=None) -> DataFrame:
    """A09: 'Reached' when no reached station is recorded, else 'Not Reached'."""
    v = filter_selected(view, STATION, selection)
    status = F.when(F.col("reached_station_id").isNull(), F.lit(REACHED)).otherwise(F.lit(NOT_REACHED))
    return (v.where(F.col(STATION).isNotNull())
            .groupBy(STATION, status.alias("destination_status"))
            .agg(F.count(F.lit(1)).alias("count")))


def lateness_vs_schedule(view: DataFrame, selection=None) -> DataFrame:
    """A10: row-level scatter data."""
    v = filter_selected(view, STATION, selection)
    return v.select(
        "service_details_id", "scheduled_arrival", "arrival_lateness",
        F.date_format("scheduled_arrival", "yyyy-MM-dd HH:mm:ss").alias("scheduled_arrival_formatted"),
        F.concat(F.col(STATION), F.lit(" to "), F.col("destination_station_name")).alias("station_tooltip"))


def _code_reasons(view: DataFrame, fill: bool) -> DataFrame:
    reason = F.coalesce(F.col("cancel_reason"), F.lit(NO_REASON)) if fill else F.col("cancel_reason")
    return view.select("cancel_code", reason.alias("cancel_reason")).where(
        F.col("cancel_code").isNotNull()).distinct()


def cancel_code_frequency(view: DataFrame, k: int | None = TOP_K) -> DataFrame:
    """Frequency per code with its reason (missing reason filled), top k."""
    counts = (view.where(F.col("cancel_code").isNotNull()).groupBy("cancel_code")
              .agg(F.count(F.lit(1)).alias("frequency")))
    merged = counts.join(_code_reasons(view, True), "cancel_code", "left")
    return top_k(merged, "frequency", ["cancel_code", "cancel_reason"], k).select(
        "cancel_code", "frequency", "cancel_reason")


def avg_delay_by_company(view: DataFrame, k: int | None = TOP_K, selection=None) -> DataFrame:
    """Mean lateness per company, top k."""
    return avg_delay_by(filter_selected(view, COMPANY, selection), COMPANY, k)


def cancellations_by_company(view: DataFrame, k: int | None = TOP_K, selection=None) -> DataFrame:
    """Count of non-null cancel codes per company (zero groups kept), top k."""
    v = filter_selected(view, COMPANY, selection)
    counts = (v.where(F.col(COMPANY).isNotNull()).groupBy(COMPANY)
              .agg(F.count("cancel_code").alias("cancellation_count")))
    return top_k(counts, "cancellation_count", COMPANY, k)


def cancellations_by_company_reason(view: DataFrame) -> DataFrame:
    """Cancellations per (company, code) with the code's reason."""
    counts = (view.where(F.col(COMPANY).isNotNull() & F.col("cancel_code").isNotNull())
              .groupBy(COMPANY, "cancel_code").agg(F.count(F.lit(1)).alias("frequency")))
    return counts.join(_code_reasons(view, False), "cancel_code", "left").select(
        COMPANY, "cancel_code", "frequency", "cancel_reason")


def reached_pct_by_company(view: DataFrame) -> DataFrame:
    """Share of services whose reached station equals the planned
    destination, per company. One pass: the reached count is a filtered count,
    null when a company has none (as the outer merge leaves it)."""
    reached = F.col("destination_station_id") == F.col("reached_station_id")
    agg = (view.where(F.col(COMPANY).isNotNull()).groupBy(COMPANY)
           .agg(F.count_if(reached).alias("_r"), F.count(F.lit(1)).alias("total_services")))
    out = agg.select(COMPANY, F.when(F.col("_r") > 0, F.col("_r")).alias("reached_destination_count"),
                     "total_services")
    out = out.withColumn("percentage_reached_destination",
                         pct(F.col("reached_destination_count"), F.col("total_services")))
    return top_k(out, "percentage_reached_destination", COMPANY, None)


def reached_pct_by_company_merge(view: DataFrame) -> DataFrame:
    """A15 as written: two aggregates and a full outer merge (checks the one-pass form)."""
    reached = (view.where(F.col(COMPANY).isNotNull()
                          & (F.col("destination_station_id") == F.col("reached_station_id")))
               .groupBy(COMPANY).agg(F.count(F.lit(1)).alias("reached_destination_count")))
    totals = view.where(F.col(COMPANY).isNotNull()).groupBy(COMPANY).agg(
        F.count(F.lit(1)).alias("total_services"))
    out = reached.join(totals, COMPANY, "full").withColumn(
        "percentage_reached_destination",
        pct(F.col("reached_destination_count"), F.col("total_services")))
    return top_k(out, "percentage_reached_destination", COMPANY, None)


def distinct_values(view: DataFrame, column: str) -> DataFrame:
    """The options of a filter."""
    return view.select(column).distinct()
