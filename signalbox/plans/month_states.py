"""A01-A16 from mergeable month states.

Per run month two stored tables hold partial aggregates of the facts: by origin
station, and by company and cancel code (counts, sums, and the row with the
largest lateness). The dashboard's figures are merges of these few rows instead
of passes over the facts. ``refresh`` rewrites the months that a load touched,
from that month's partitions of the facts; other months stay as they are, and
late rows of an old month are seen because its partition is read again whole.

Keys are ids; names are looked up when figures are read, and rows of equal names
are merged then, as the wide view has it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import NO_REASON, NOT_REACHED, REACHED, TOP_K
from ..operators import analytics as A
from ..session import materialize, path_exists
from .services import ServiceTables, open_star_schema

STATION_STATE, CODE_STATE = "state_station", "state_company_code"


def _month_rows(t: ServiceTables, months: list) -> DataFrame:
    """The facts of some months, one row a service."""
    inside = F.col("run_month").isin(months)
    key = ["service_details_id", "run_month"]
    sd, dd, cn = (df.where(inside) for df in (t.service_details, t.delay_details, t.cancellation))
    return (sd.select(*key, "company_id", "service_type_id", "origin_station_id", "destination_station_id")
            .join(dd.select(*key, "arrival_lateness"), key, "left")
            .join(cn.select(*key, "cancellation_id", "reached_station_id", "cancel_code_id"), key, "left"))


def station_state(rows: DataFrame, bus_id: Column) -> DataFrame:
    late = F.col("arrival_lateness")
    worst = F.when(late.isNotNull(), F.struct(late.cast("long").alias("lateness"), (-F.col("service_details_id")).alias("first")))
    # The largest struct would sort every row; by lateness first, all rows are hashed and few are left to sort.
    cells = rows.groupBy("run_month", "origin_station_id", "arrival_lateness").agg(
        F.count(F.lit(1)).alias("services"), F.count("cancellation_id").alias("cancelled"),
        F.count_if(F.col("service_type_id") == bus_id).alias("buses"),
        F.count("reached_station_id").alias("not_reached"), F.min("service_details_id").alias("service_details_id"))
    n = F.col("services")
    return cells.groupBy("run_month", "origin_station_id").agg(
        F.sum("services").alias("services"), F.coalesce(F.sum(F.when(late > 0, n)), F.lit(0)).alias("late"),
        F.sum(late * n).alias("lateness"), F.coalesce(F.sum(F.when(late.isNotNull(), n)), F.lit(0)).alias("measured"),
        F.sum("cancelled").alias("cancelled"), F.sum("buses").alias("buses"),
        F.sum("not_reached").alias("not_reached"), F.max(worst).alias("worst"))


def code_state(rows: DataFrame) -> DataFrame:
    late = F.col("arrival_lateness")
    return rows.groupBy("run_month", "company_id", "cancel_code_id").agg(
        F.count(F.lit(1)).alias("services"), F.sum(late).alias("lateness"), F.count(late).alias("measured"),
        F.count_if(F.col("destination_station_id") == F.col("reached_station_id")).alias("reached"))


def refresh(spark: SparkSession, root: str, months: DataFrame) -> int:
    """Rewrites the states of the run months in the one-column table ``months``
    (as many as the calendar has); the number of months."""
    t = open_star_schema(spark, root)
    touched = [r[0] for r in months.where(F.col("run_month").isNotNull()).distinct().collect()]
    rows = materialize(_month_rows(t, touched), "month-rows")  # both states read the joined facts
    bus = t.service_type.where(F.col("service_type_name") == "bus").agg(F.min("service_type_id")).scalar()
    for name, state in ((STATION_STATE, station_state(rows, bus)), (CODE_STATE, code_state(rows))):
        (state.repartition("run_month").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("run_month").parquet(f"{root}/{name}"))
    return len(touched)


class States:
    """The dashboard's figures from the states under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        t = open_star_schema(spark, root)
        if not path_exists(spark, f"{root}/{STATION_STATE}"):
            refresh(spark, root, t.service_details.select("run_month"))
        station = t.station.select(F.col("station_id").alias("origin_station_id"), F.col("station_name").alias(A.STATION))
        self.by_station = spark.read.parquet(f"{root}/{STATION_STATE}").join(station, "origin_station_id", "left")
        code = t.cancel_code.select("cancel_code_id", F.col("code").alias("cancel_code"), F.col("reason").alias("cancel_reason"))
        self.by_code = (spark.read.parquet(f"{root}/{CODE_STATE}").join(t.company.select("company_id", A.COMPANY), "company_id", "left")
                        .join(code, "cancel_code_id", "left"))
        self.root = root

    def _stations(self) -> DataFrame:
        return self.by_station.where(F.col(A.STATION).isNotNull()).groupBy(A.STATION)

    def _companies(self) -> DataFrame:
        return self.by_code.where(F.col(A.COMPANY).isNotNull()).groupBy(A.COMPANY)

    @staticmethod
    def _mean() -> Column:
        return F.sum("lateness").cast("double") / F.nullif(F.sum("measured"), F.lit(0))

    def kpi_totals(self) -> DataFrame:
        n, late, cancelled = (F.coalesce(F.sum(c), F.lit(0)) for c in ("services", "late", "cancelled"))
        agg = self.by_station.agg(n.alias("total_services"), late.alias("total_delays"), cancelled.alias("total_cancellations"))
        return agg.select(
            "total_services", "total_delays", A.round2(A.pct(F.col("total_delays"), F.col("total_services"))).alias("delay_pct"),
            "total_cancellations", A.round2(A.pct(F.col("total_cancellations"), F.col("total_services"))).alias("cancellation_pct"))

    def most_delayed_station(self) -> DataFrame:
        worst = self.by_station.where(F.col("worst").isNotNull()).agg(F.max(F.struct("worst", F.col(A.STATION).alias("station"))).alias("w"))
        return worst.where(F.col("w").isNotNull()).select(
            F.col("w.station").alias("most_delayed_station"), F.col("w.worst.lateness").cast("int").alias("max_arrival_lateness"))

    def busiest_station(self) -> DataFrame:
        return A.top_k(self._stations().agg(F.sum("services").alias("service_count")), "service_count", A.STATION, 1)

    def most_cancelled_station(self) -> DataFrame:
        return self.cancellations_station_top(1)

    def avg_delay(self) -> DataFrame:
        return self.by_station.agg(A.round2(self._mean()).alias("avg_delay_minutes"))

    def avg_delay_station_top(self, k: int | None = TOP_K) -> DataFrame:
        return A.top_k(self._stations().agg(self._mean().alias("avg_arrival_lateness")), "avg_arrival_lateness", A.STATION, k)

    def cancellations_station_top(self, k: int | None = TOP_K) -> DataFrame:
        counts = self._stations().agg(F.sum("cancelled").alias("cancellation_count")).where("cancellation_count > 0")
        return A.top_k(counts, "cancellation_count", A.STATION, k)

    def bus_replacements(self, k: int | None = TOP_K) -> DataFrame:
        counts = self._stations().agg(F.sum("buses").alias("bus_replacement_count")).where("bus_replacement_count > 0")
        return A.top_k(counts, "bus_replacement_count", A.STATION, k)

    def bus_replacements_total(self) -> DataFrame:
        return self.bus_replacements().agg(F.coalesce(F.sum("bus_replacement_count"), F.lit(0)).alias("total_bus_replacements"))

    def destination_status(self) -> DataFrame:
        both = self._stations().agg(F.sum("services").alias("n"), F.sum("not_reached").alias("no"))
        rows = F.explode(F.array(F.struct(F.lit(REACHED).alias("destination_status"), (F.col("n") - F.col("no")).alias("count")),
                                 F.struct(F.lit(NOT_REACHED).alias("destination_status"), F.col("no").alias("count"))))
        return both.select(A.STATION, rows.alias("r")).select(A.STATION, "r.*").where("count > 0")

    def cancel_code_frequency(self, k: int | None = TOP_K) -> DataFrame:
        counts = self.by_code.where(F.col("cancel_code").isNotNull()).groupBy("cancel_code", "cancel_reason").agg(
            F.sum("services").alias("frequency"))
        return A.top_k(counts.withColumn("cancel_reason", F.coalesce("cancel_reason", F.lit(NO_REASON))), "frequency",
                       ["cancel_code", "cancel_reason"], k).select("cancel_code", "frequency", "cancel_reason")

    def avg_delay_company_top(self, k: int | None = TOP_K) -> DataFrame:
        return A.top_k(self._companies().agg(self._mean().alias("avg_arrival_lateness")), "avg_arrival_lateness", A.COMPANY, k)

    def cancellations_company_top(self, k: int | None = TOP_K) -> DataFrame:
        coded = F.sum(F.when(F.col("cancel_code").isNotNull(), F.col("services")).otherwise(0))
        return A.top_k(self._companies().agg(coded.alias("cancellation_count")), "cancellation_count", A.COMPANY, k)

    def cancellations_company_reason(self) -> DataFrame:
        coded = self.by_code.where(F.col(A.COMPANY).isNotNull() & F.col("cancel_code").isNotNull())
        return coded.groupBy(A.COMPANY, "cancel_code", "cancel_reason").agg(F.sum("services").alias("frequency")).select(
            A.COMPANY, "cancel_code", "frequency", "cancel_reason")

    def reached_pct_company(self) -> DataFrame:
        agg = self._companies().agg(F.sum("reached").alias("_r"), F.sum("services").alias("total_services"))
        out = agg.select(A.COMPANY, F.when(F.col("_r") > 0, F.col("_r")).alias("reached_destination_count"), "total_services")
        out = out.withColumn("percentage_reached_destination", A.pct(F.col("reached_destination_count"), F.col("total_services")))
        return A.top_k(out, "percentage_reached_destination", A.COMPANY, None)

    def distinct_stations(self) -> DataFrame:
        return self.by_station.select(A.STATION).distinct()

    def distinct_companies(self) -> DataFrame:
        return self.by_code.select(A.COMPANY).distinct()


#: Figures that have a query of the same name over the wide view.
FIGURES = ["kpi_totals", "most_delayed_station", "busiest_station", "most_cancelled_station", "avg_delay", "avg_delay_station_top",
           "cancellations_station_top", "bus_replacements", "bus_replacements_total", "destination_status",
           "cancel_code_frequency", "avg_delay_company_top", "cancellations_company_top", "cancellations_company_reason",
           "reached_pct_company", "distinct_stations", "distinct_companies"]
