"""The wide service view (V01) and its one-day slice."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .services import ServiceTables

WIDE_COLUMNS = [
    "cancel_code_id", "cancel_code", "cancel_reason", "cancel_abbreviation",
    "company_id", "company_name", "origin_station_id", "origin_station_name",
    "destination_station_id", "destination_station_name", "service_type_id",
    "service_type_name", "service_details_id", "service_uid", "run_date",
    "delay_details_id", "arrival_lateness", "scheduled_arrival", "cancellation_id",
    "cancelled_station_id", "reached_station_id",
]

# Columns each joined table contributes, keyed by table.
_NEEDS = {
    "company": {"company_name"},
    "service_type": {"service_type_name"},
    "origin": {"origin_station_name"},
    "destination": {"destination_station_name"},
    "delay_details": {"delay_details_id", "arrival_lateness", "scheduled_arrival"},
    "cancellation": {"cancellation_id", "cancelled_station_id", "reached_station_id",
                     "cancel_code_id", "cancel_code", "cancel_reason", "cancel_abbreviation"},
    "cancel_code": {"cancel_code", "cancel_reason", "cancel_abbreviation"},
}


def yesterday(as_of) -> _dt.date:
    if isinstance(as_of, str):
        as_of = _dt.date.fromisoformat(as_of)
    if isinstance(as_of, _dt.datetime):
        as_of = as_of.date()
    return as_of - _dt.timedelta(days=1)


def wide_services(t: ServiceTables, columns: Sequence[str] | None = None,
                  as_of=None) -> DataFrame:
    """Fact joined left to its dimensions and to the delay and cancellation facts.

    ``columns`` limits the output and skips joins nobody reads (Catalyst keeps
    a left join under a plain aggregate because it cannot prove key
    uniqueness). ``as_of`` keeps the run day before it (V02); on stored
    tables partitioned by ``run_month`` every fact scan is pruned to that
    month. Bucketed facts (``plans.bucketed``) are joined bucket by bucket.
    """
    cols = list(columns or WIDE_COLUMNS)
    want = set(cols)
    sd = t.service_details
    dd = t.delay_details
    cn = t.cancellation
    partitioned = all("run_month" in df.columns for df in (sd, dd, cn))
    if as_of is not None:
        day = yesterday(as_of)
        sd = sd.where(F.to_date("run_date") == F.lit(day))
        if partitioned:
            month = day.replace(day=1)
            sd = sd.where(F.col("run_month") == F.lit(month))
            dd = dd.where(F.col("run_month") == F.lit(month))
            cn = cn.where(F.col("run_month") == F.lit(month))
    fact_key = ["service_details_id", "run_month"] if partitioned else ["service_details_id"]
    v = sd.select(*dict.fromkeys(["service_details_id", "service_uid", "run_date", "company_id",
                                  "service_type_id", "origin_station_id",
                                  "destination_station_id", *fact_key[1:]]))
    # facts first, on their unique id; names are looked up in what is left
    if want & _NEEDS["delay_details"]:
        v = v.join(dd.select(*fact_key, "delay_details_id", "arrival_lateness",
                             "scheduled_arrival"), fact_key, "left")
    if want & _NEEDS["cancellation"]:
        v = v.join(cn.select(*fact_key, "cancellation_id", "cancelled_station_id",
                             "reached_station_id", "cancel_code_id"), fact_key, "left")
    if want & _NEEDS["company"]:
        v = v.join(t.company.select("company_id", "company_name"), "company_id", "left")
    if want & _NEEDS["service_type"]:
        v = v.join(t.service_type.select("service_type_id", "service_type_name"),
                   "service_type_id", "left")
    if want & _NEEDS["origin"]:
        v = v.join(t.station.select(F.col("station_id").alias("origin_station_id"),
                                    F.col("station_name").alias("origin_station_name")),
                   "origin_station_id", "left")
    if want & _NEEDS["destination"]:
        v = v.join(t.station.select(F.col("station_id").alias("destination_station_id"),
                                    F.col("station_name").alias("destination_station_name")),
                   "destination_station_id", "left")
    if want & _NEEDS["cancel_code"]:
        v = v.join(t.cancel_code.select("cancel_code_id", F.col("code").alias("cancel_code"),
                                        F.col("reason").alias("cancel_reason"),
                                        F.col("abbreviation").alias("cancel_abbreviation")),
                   "cancel_code_id", "left")
    return v.select(*cols)


def wide_services_day(t: ServiceTables, as_of) -> DataFrame:
    """The wide view of the run day before ``as_of``."""
    return wide_services(t, as_of=as_of)
