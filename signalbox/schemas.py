"""Explicit schemas of the captured documents (no inference anywhere)."""

from pyspark.sql.types import (ArrayType, BooleanType, IntegerType, StringType, StructField,
                               StructType)


def _s(*names: str) -> list[StructField]:
    return [StructField(n, StringType()) for n in names]


# Takes the text of a document that is not valid JSON.
CORRUPT = "_corrupt_record"

TIME_PAIR = StructType(_s("tiploc", "description", "workingTime", "publicTime"))

JOURNEY = StructType([
    StructField("locationDetail", StructType([
        StructField("realtimeActivated", BooleanType()),
        *_s("tiploc", "crs", "description", "gbttBookedArrival", "gbttBookedDeparture"),
        StructField("origin", ArrayType(TIME_PAIR)),
        StructField("destination", ArrayType(TIME_PAIR)),
        StructField("isCall", BooleanType()),
        StructField("isPublicCall", BooleanType()),
        StructField("realtimeArrival", StringType()),
        StructField("realtimeArrivalActual", BooleanType()),
        StructField("realtimeDeparture", StringType()),
        StructField("realtimeDepartureActual", BooleanType()),
        StructField("displayAs", StringType()),
    ])),
    *_s("serviceUid", "runDate", "trainIdentity", "runningIdentity", "atocCode", "atocName",
        "serviceType"),
    StructField("isPassenger", BooleanType()),
])

# Station search result: the journeys through one station on one day, or a
# fetch error (``error`` + ``Station``).
STATION_SEARCH = StructType([
    StructField("location", StructType(_s("name", "crs", "tiploc"))),
    StructField("services", ArrayType(JOURNEY)),
    *_s("error", "Station", CORRUPT),
])

LOCATION = StructType([
    StructField("realtimeActivated", BooleanType()),
    *_s("tiploc", "crs", "description", "gbttBookedArrival", "gbttBookedDeparture"),
    StructField("origin", ArrayType(TIME_PAIR)),
    StructField("destination", ArrayType(TIME_PAIR)),
    StructField("isCall", BooleanType()),
    StructField("isPublicCall", BooleanType()),
    *_s("realtimeArrival", "realtimeDeparture", "platform", "line", "displayAs"),
    StructField("realtimeGbttArrivalLateness", IntegerType()),
    *_s("cancelReasonCode", "cancelReasonShortText"),
    StructField("associations", ArrayType(StructType(_s("type", "associatedUid",
                                                        "associatedRunDate")))),
])

# Service detail: ordered calling points, or a fetch error (``error`` + ``Service``).
SERVICE = StructType([
    *_s("serviceUid", "runDate", "serviceType"),
    StructField("isPassenger", BooleanType()),
    *_s("trainIdentity", "powerType", "trainClass", "atocCode", "atocName"),
    StructField("performanceMonitored", BooleanType()),
    StructField("origin", ArrayType(TIME_PAIR)),
    StructField("destination", ArrayType(TIME_PAIR)),
    StructField("locations", ArrayType(LOCATION)),
    *_s("error", "Service", CORRUPT),
])

# Flat row of the extract (17 text fields; lateness as int).
FLAT_SERVICE = StructType([
    *_s("service_uid", "company_name", "service_type", "origin_crs", "origin_stn_name",
        "origin_run_time", "origin_run_date", "planned_final_destination", "planned_final_crs",
        "destination_reached_crs", "destination_reached_name", "scheduled_arrival_time",
        "scheduled_arrival_date"),
    StructField("arrival_lateness", IntegerType()),
    *_s("cancellation_station_crs", "cancellation_station_name", "cancel_code"),
])
