"""Nested extraction of service documents.

Array rules run row by row with higher-order functions (``filter``, ``get``,
``element_at``): no explode of calling points, no UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import CANCELLED_DISPLAY, TERMINAL_DISPLAY
from ..session import materialize
from .keys import first_per_key

FLAT_COLUMNS = [
    "service_uid", "company_name", "service_type", "origin_crs", "origin_stn_name",
    "origin_run_time", "origin_run_date", "planned_final_destination", "planned_final_crs",
    "destination_reached_crs", "destination_reached_name", "scheduled_arrival_time",
    "scheduled_arrival_date", "arrival_lateness", "cancellation_station_crs",
    "cancellation_station_name", "cancel_code",
]


def first_location(locations: Column) -> Column:
    """The origin call, ``locations[0]``."""
    return F.get(locations, 0)


def last_location(locations: Column) -> Column:
    """The planned final call, ``locations[-1]``."""
    return F.when(F.size(locations) > 0, F.element_at(locations, -1))


def terminal_location(locations: Column) -> Column:
    """First call shown as TERMINATES or DESTINATION (null if none)."""
    return F.get(F.filter(locations, lambda l: l["displayAs"].isin(TERMINAL_DISPLAY)), 0)


def lateness_default(terminal: Column) -> Column:
    """Terminal lateness, 0 when the terminal has none, null without terminal."""
    return F.when(terminal.isNotNull(),
                  F.coalesce(terminal["realtimeGbttArrivalLateness"], F.lit(0)))


def cancelled_call(locations: Column) -> Column:
    """First CANCELLED_CALL as (crs, description, code), all-or-nothing."""
    c = F.get(F.filter(locations, lambda l: l["displayAs"] == CANCELLED_DISPLAY), 0)
    complete = c["crs"].isNotNull() & c["description"].isNotNull() & c["cancelReasonCode"].isNotNull()
    return F.when(complete, F.struct(c["crs"].alias("crs"), c["description"].alias("description"),
                                     c["cancelReasonCode"].alias("code")))


def destination_reached(terminal: Column, origin_crs: Column, journey: Column) -> Column:
    """(crs, name) reached. Without terminal: the origin call's code and
    the journey's origin name; with one: the terminal's code and the
    journey's planned destination name."""
    origin_name = F.get(journey["locationDetail"]["origin"], 0)["description"]
    dest_name = F.get(journey["locationDetail"]["destination"], 0)["description"]
    return F.when(terminal.isNull(), F.struct(origin_crs.alias("crs"), origin_name.alias("name"))) \
            .otherwise(F.struct(terminal["crs"].alias("crs"), dest_name.alias("name")))


def service_facts(services: DataFrame, doc: str = "doc") -> DataFrame:
    """Per service document: key, company, type and the X02-X05 results."""
    d = F.col(doc)
    locs = d["locations"]
    term = terminal_location(locs)
    return services.select(
        d["serviceUid"].alias("service_uid"), d["runDate"].alias("run_date"),
        d["atocName"].alias("company_name"), d["serviceType"].alias("service_type"),
        F.coalesce(F.size(locs), F.lit(-1)).alias("n_locations"),
        first_location(locs)["crs"].alias("origin_crs"),
        last_location(locs)["description"].alias("planned_final_destination"),
        last_location(locs)["crs"].alias("planned_final_crs"),
        term.alias("terminal"),
        lateness_default(term).alias("arrival_lateness"),
        cancelled_call(locs).alias("cancelled"))


def relevant_fields(journeys: DataFrame, services: DataFrame,
                    journey: str = "journey", doc: str = "doc") -> tuple[DataFrame, DataFrame]:
    """X01 + X07: pair each journey with its service document (by uid and run
    date) and project the 17 flat fields; journeys whose pairing fails a
    required field go to quarantine with a reason.

    Of repeated captures of one service the first by its facts, in the order of
    their columns, counts, whatever order they come in; the rest are dropped
    before the join, so k repeats do not fan out k x k. The facts are written
    once (a few values of each document): documents are parsed a single time.
    """
    facts = materialize(service_facts(services, doc), "service-facts")
    facts = first_per_key(facts, ["service_uid", "run_date"], [])
    j = F.col(journey)
    jr = journeys.select(j.alias("journey"), *[c for c in journeys.columns if c != journey])
    jr = jr.withColumn("_uid", F.col("journey.serviceUid")).withColumn("_rd", F.col("journey.runDate"))
    paired = jr.join(facts, (jr["_uid"] == facts["service_uid"]) & (jr["_rd"] == facts["run_date"]),
                     "left")
    detail = F.col("journey.locationDetail")
    reason = (F.when(F.col("service_uid").isNull(), F.lit("no service document"))
              .when(F.col("n_locations") <= 0, F.lit("no locations"))
              .when(F.coalesce(F.size(detail["origin"]), F.lit(-1)) <= 0, F.lit("journey without origin"))
              .when(F.coalesce(F.size(detail["destination"]), F.lit(-1)) <= 0,
                    F.lit("journey without destination")))
    paired = paired.withColumn("_reason", reason)
    good = paired.where(F.col("_reason").isNull())
    reached = destination_reached(F.col("terminal"), F.col("origin_crs"), F.col("journey"))
    origin = F.get(detail["origin"], 0)
    dest = F.get(detail["destination"], 0)
    flat = good.select(
        "service_uid", "company_name", "service_type", "origin_crs",
        origin["description"].alias("origin_stn_name"),
        origin["workingTime"].alias("origin_run_time"),
        F.col("journey.runDate").alias("origin_run_date"),
        "planned_final_destination", "planned_final_crs",
        reached["crs"].alias("destination_reached_crs"),
        reached["name"].alias("destination_reached_name"),
        dest["workingTime"].alias("scheduled_arrival_time"),
        F.col("journey.runDate").alias("scheduled_arrival_date"),
        "arrival_lateness",
        F.col("cancelled.crs").alias("cancellation_station_crs"),
        F.col("cancelled.description").alias("cancellation_station_name"),
        F.col("cancelled.code").alias("cancel_code"))
    quarantine = paired.where(F.col("_reason").isNotNull()).select(
        F.col("_uid").alias("service_uid"), F.col("_rd").alias("run_date"),
        *[c for c in journeys.columns if c != journey], F.col("_reason").alias("reason"))
    return flat, quarantine
