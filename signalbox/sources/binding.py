"""Binding of the driver's TPC-H-like tables to the flat service row.

One row per line item: the line item is a train service, its supplier the
operating company, the customer's nation the origin station and the
supplier's nation the planned destination. The key (service_uid,
origin_run_datetime) repeats on purpose, as a service seen through several
stations does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import Tables

# Columns that order repeated rows of one service deterministically.
TIE_BREAK = ["l_partkey", "l_suppkey", "l_extendedprice", "l_discount", "l_tax",
             "l_quantity"]
# Full dedupe order of the flat service row (FIXTURES §3).
SERVICE_ORDER = TIE_BREAK + ["scheduled_arrival_datetime", "arrival_lateness",
                             "cancel_code"]

FLAT_COLUMNS = [
    "service_uid", "company_name", "service_type", "origin_crs", "origin_stn_name",
    "origin_run_datetime", "planned_final_destination", "planned_final_crs",
    "destination_reached_crs", "destination_reached_name",
    "scheduled_arrival_datetime", "arrival_lateness", "cancellation_station_crs",
    "cancellation_station_name", "cancel_code",
]


def crs_code(nation_key: Column) -> Column:
    """Three-character station code of a nation key: N00 .. N24."""
    return F.concat(F.lit("N"), F.lpad(nation_key.cast("string"), 2, "0"))


def service_rows(t: Tables) -> DataFrame:
    """Flat service rows (15 fields + tie-break columns) from the driver tables.

    Join order keeps the large line item side to one shuffle per key:
    orders is joined to its customer first, suppliers to their nation; the
    25-row nation table is a fixed-size broadcast.
    """
    # Names of nations come last: until then their keys go through the shuffles.
    nation = t.nation.select("n_nationkey", "n_name")
    cn = F.broadcast(nation.select(F.col("n_nationkey").alias("c_nationkey"),
                                   F.col("n_name").alias("cn_name")))
    sn = F.broadcast(nation.select(F.col("n_nationkey").alias("s_nationkey"),
                                   F.col("n_name").alias("sn_name")))
    orders = (t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
              .join(t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"),
                    "o_custkey")
              .drop("o_custkey"))
    suppliers = (t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_name",
                                   "s_nationkey"))
    parts = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                           "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                           "l_returnflag", "l_linestatus", "l_shipdate")
    j = (li.join(orders.withColumnRenamed("o_orderkey", "l_orderkey"), "l_orderkey")
         .join(parts, "l_partkey")
         .join(suppliers, "l_suppkey")
         .join(cn, "c_nationkey").join(sn, "s_nationkey"))
    c_crs = crs_code(F.col("c_nationkey"))
    s_crs = crs_code(F.col("s_nationkey"))
    returned = F.col("l_returnflag") == "R"
    turned_back = returned & (F.col("l_linestatus") == "F")
    return j.select(
        F.concat(F.lit("S"), F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("service_uid"),
        F.col("s_name").alias("company_name"),
        F.when((F.col("l_linestatus") == "F") & (F.col("l_quantity") >= 40), "bus")
         .otherwise("train").alias("service_type"),
        c_crs.alias("origin_crs"),
        F.col("cn_name").alias("origin_stn_name"),
        F.col("o_orderdate").alias("origin_run_datetime"),
        F.col("sn_name").alias("planned_final_destination"),
        s_crs.alias("planned_final_crs"),
        F.when(turned_back, c_crs).otherwise(s_crs).alias("destination_reached_crs"),
        F.when(turned_back, F.col("cn_name")).otherwise(F.col("sn_name"))
         .alias("destination_reached_name"),
        F.col("l_shipdate").alias("scheduled_arrival_datetime"),
        F.when(F.col("l_returnflag") == "A", F.col("l_quantity").cast("int"))
         .when(F.col("l_returnflag") == "N", F.lit(0)).alias("arrival_lateness"),
        F.when(returned, s_crs).alias("cancellation_station_crs"),
        F.when(returned, F.col("sn_name")).alias("cancellation_station_name"),
        F.when(returned, F.col("p_brand")).alias("cancel_code"),
        *TIE_BREAK,
        "l_linenumber",
    )


def cancel_code_rows(t: Tables) -> DataFrame:
    """Cancel-code reference table from part brands: code, reason, abbreviation.

    ``Brand#2`` has no reason, as a code missing its description upstream.
    """
    brands = t.part.select(F.col("p_brand").alias("code")).where(F.col("code").isNotNull()).distinct()
    return brands.select(
        "code",
        F.when(F.col("code") != "Brand#2", F.concat(F.lit("reason "), F.col("code")))
         .alias("reason"),
        F.regexp_extract("code", r"(\d+)", 1).alias("abbreviation"),
    )


# --- raw (pre-transform) rows: text dates and times, untidy codes -----------

def hhmmss_number(seconds: Column) -> Column:
    h = F.floor(seconds / 3600).cast("long")
    m = F.floor((seconds % 3600) / 60).cast("long")
    s = (seconds % 60).cast("long")
    return h * 10000 + m * 100 + s


def _time_text(seconds: Column, line: Column) -> Column:
    n = hhmmss_number(seconds).cast("string")
    return (F.when(F.col("l_discount") == 0.1, F.lit("9999"))
            .when(line == 3, F.concat(n, F.lit(".0")))
            .when(line % 2 == 0, F.lpad(n, 6, "0"))
            .otherwise(n))


def raw_service_rows(t: Tables) -> DataFrame:
    """The 17-field extract row as text, derived from ``service_rows``: dates
    as ``yyyy-MM-dd``, times as ``HHMMSS`` with and without leading zeros (and
    an invalid one), codes padded, lower-cased or of the wrong length, and
    lateness as text with 'cancelled at origin' for missing values."""
    svc = service_rows(t)
    line = F.col("l_linenumber")
    run_s = (F.col("l_quantity").cast("long") * 1733 + line * 611) % 86400
    arr_s = (F.col("l_partkey") * 37 + F.col("l_suppkey") * 101 + line) % 86400
    late = F.col("arrival_lateness").cast("string")
    return svc.select(
        "service_uid", "company_name", "service_type",
        F.lower(F.concat(F.lit(" "), F.col("origin_crs"),
                         F.when(line == 1, F.lit("X")).otherwise(F.lit("")))).alias("origin_crs"),
        "origin_stn_name",
        _time_text(run_s, line).alias("origin_run_time"),
        F.when(F.col("l_discount") == 0.0, F.lit("not-a-date"))
         .otherwise(F.date_format("origin_run_datetime", "yyyy-MM-dd")).alias("origin_run_date"),
        "planned_final_destination",
        F.when(line == 4, F.concat(F.lit("\t"), F.col("planned_final_crs"), F.lit(" ")))
         .otherwise(F.col("planned_final_crs")).alias("planned_final_crs"),
        F.lower("destination_reached_crs").alias("destination_reached_crs"),
        "destination_reached_name",
        _time_text(arr_s, line).alias("scheduled_arrival_time"),
        F.date_format("scheduled_arrival_datetime", "yyyy-MM-dd").alias("scheduled_arrival_date"),
        F.when(F.col("arrival_lateness").isNull(), F.lit("cancelled at origin"))
         .when(line == 2, F.concat(late, F.lit(".0"))).otherwise(late).alias("arrival_lateness"),
        F.when(line == 5, F.concat(F.col("cancellation_station_crs"), F.lit("Q")))
         .otherwise(F.col("cancellation_station_crs")).alias("cancellation_station_crs"),
        "cancellation_station_name",
        F.when(F.col("cancel_code").isNotNull() & (line == 6), F.lit("tabbycat"))
         .otherwise(F.concat(F.lit(" "), F.lower("cancel_code"), F.lit(" "))).alias("cancel_code"),
        *TIE_BREAK,
    )


def valid_code_list(t: Tables) -> DataFrame:
    """Reference list of valid cancel codes (column ``Code``): upper-case brand
    codes, without those ending in 5, so some codes in the data are unknown."""
    return (t.part.select(F.upper("p_brand").alias("Code"))
            .where(F.col("Code").isNotNull() & ~F.col("Code").endswith("5")).distinct())


def valid_code_rows(t: Tables) -> DataFrame:
    """The valid code list as cancel-code reference rows (code, reason, abbreviation)."""
    return valid_code_list(t).select(
        F.col("Code").alias("code"), F.concat(F.lit("reason "), F.col("Code")).alias("reason"),
        F.regexp_extract("Code", r"(\d+)", 1).alias("abbreviation"))
