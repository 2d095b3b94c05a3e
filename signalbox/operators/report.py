"""Daily report datasets (R01-R07); R08 bundles them in plans.report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .analytics import COMPANY, STATION, avg_delay_by, cancellations_by


def _grouped(view: DataFrame, key: str) -> "DataFrame":
    return view.where(F.col(key).isNotNull()).groupBy(key)


def services_per_station(view: DataFrame) -> DataFrame:
    """R01."""
    return _grouped(view, STATION).agg(F.count(F.lit(1)).alias("total_services"))


def total_delay_by_company(view: DataFrame) -> DataFrame:
    """Sum of lateness, 0 when all are null."""
    return _grouped(view, COMPANY).agg(
        F.coalesce(F.sum("arrival_lateness"), F.lit(0)).cast("long").alias("total_arrival_lateness"))


def cancel_codes_by_company(view: DataFrame) -> DataFrame:
    """Non-null cancel codes per company, zero groups kept."""
    return _grouped(view, COMPANY).agg(F.count("cancel_code").alias("cancel_code_count"))


def mean_delay_by_station(view: DataFrame) -> DataFrame:
    """Mean lateness per station, no limit."""
    return avg_delay_by(view, STATION, None)


def cancel_codes_by_station(view: DataFrame) -> DataFrame:
    """R05."""
    return _grouped(view, STATION).agg(F.count("cancel_code").alias("cancel_code_count"))


def cancellations_per_company(view: DataFrame) -> DataFrame:
    """Cancelled services per company, no limit."""
    return cancellations_by(view, COMPANY, None)


def key_statistics(view: DataFrame) -> DataFrame:
    """Services, non-null lateness ("delays"), cancellations, mean lateness."""
    return view.agg(
        F.count("service_uid").alias("total_services"),
        F.count("arrival_lateness").alias("total_delays"),
        F.count("cancellation_id").alias("total_cancellations"),
        F.avg("arrival_lateness").alias("avg_delay"))
