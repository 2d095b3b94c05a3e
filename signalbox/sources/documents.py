"""Captured-document stand-ins rendered from the driver tables.

Every document is built by Spark from the tables, so its volume grows with
them; the operators then parse the text as they would parse captured files.

Service detail document: one per order (``O<orderkey>``); its calling points
are the order's line items (at most a few dozen) in line order. A returned
item is a CANCELLED_CALL (with a reason code unless the part is large), an
open item not returned TERMINATES, the rest are CALLs; lateness is the
quantity, absent when divisible by 3. Some captures are fetch errors and
some lack calling points. By order key, some are captured twice, the second
time with other values (its text sorts after the first), and some captures are
cut off in the middle.

Station search document: one per calling point, listing the service that
calls there (a service is seen through each of its stations); some are fetch
errors for the station, some are cut off.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .binding import hhmmss_number
from .tables import Tables

LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_discount",
              "l_tax", "l_quantity"]
FETCH_ERROR = "Timeout: The request could not be completed."


def hhmmss(seconds: Column) -> Column:
    """Seconds of day -> ``HHMMSS`` text with leading zeros."""
    return F.lpad(hhmmss_number(seconds).cast("string"), 6, "0")


def _location() -> Column:
    rf, ls = F.col("l_returnflag"), F.col("l_linestatus")
    display = (F.when(rf == "R", F.lit("CANCELLED_CALL"))
               .when((rf == "N") & (ls == "O"), F.lit("TERMINATES"))
               .otherwise(F.lit("CALL")))
    sk = F.col("l_suppkey").cast("string")
    return F.struct(
        F.concat(F.lit("T"), sk).alias("tiploc"),
        F.concat(F.lit("C"), sk).alias("crs"),
        F.concat(F.lit("Stop "), sk).alias("description"),
        display.alias("displayAs"),
        F.when(F.col("l_quantity") % 3 != 0, F.col("l_quantity").cast("int"))
         .alias("realtimeGbttArrivalLateness"),
        F.when((rf == "R") & (F.col("p_size") <= 45), F.col("p_brand")).alias("cancelReasonCode"))


def order_services(t: Tables) -> DataFrame:
    """One row per order: key fields, ordered calling points, capture flags."""
    li = t.lineitem.select("l_orderkey", *LINE_ORDER, "l_returnflag", "l_linestatus").join(
        t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_size"), "l_partkey")
    entry = F.struct(F.struct(*LINE_ORDER).alias("k"), _location().alias("loc"))
    # Plain columns go to their order first: lists begun map-side would be sorted there and
    # carry the texts of each calling point through the shuffle.
    calls = (li.repartition("l_orderkey").groupBy("l_orderkey")
             .agg(F.sort_array(F.collect_list(entry)).alias("_e"))  # no entry is null; array_sort would interpret a comparison
             .select(F.col("l_orderkey").alias("o_orderkey"),
                     F.transform("_e", lambda e: e["loc"]).alias("locations")))
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus",
                             "o_orderpriority").join(
        t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment"), "o_custkey")
    o = orders.join(calls, "o_orderkey")
    start = (F.col("o_orderkey") * 97) % 86400
    return o.select(
        F.concat(F.lit("O"), F.col("o_orderkey").cast("string")).alias("uid"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("run_date"),
        F.col("c_mktsegment").alias("atoc_name"),
        F.when(F.col("o_orderstatus") == "F", F.lit("bus")).otherwise(F.lit("train")).alias("service_type"),
        hhmmss(start).alias("origin_time"),
        hhmmss((start + 7200) % 86400).alias("destination_time"),
        "locations", F.col("o_orderkey").alias("order_key"),
        ((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT")).alias("fetch_error"),
        ((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "5-LOW")).alias("no_locations"))


def _pair(loc: Column, time: Column) -> Column:
    return F.array(F.struct(loc["tiploc"].alias("tiploc"), loc["description"].alias("description"),
                            time.alias("workingTime"), F.substring(time, 1, 4).alias("publicTime")))


def service_documents(t: Tables, orders: DataFrame | None = None) -> DataFrame:
    """Service detail documents as JSON text (column ``value``); ``orders``
    is a precomputed ``order_services`` (shared with the station searches)."""
    o = orders if orders is not None else order_services(t)
    err = F.col("fetch_error")
    first = F.get(F.col("locations"), 0)
    last = F.element_at(F.col("locations"), -1)
    doc = F.struct(
        F.when(~err, F.col("uid")).alias("serviceUid"),
        F.when(~err, F.col("run_date")).alias("runDate"),
        F.when(~err, F.col("service_type")).alias("serviceType"),
        F.when(~err, F.col("atoc_name")).alias("atocName"),
        F.when(~err, _pair(first, F.col("origin_time"))).alias("origin"),
        F.when(~err, _pair(last, F.col("destination_time"))).alias("destination"),
        F.when(~err & ~F.col("no_locations"), F.col("locations")).alias("locations"),
        F.when(err, F.lit(FETCH_ERROR)).alias("error"),
        F.when(err, F.col("uid")).alias("Service"))
    text = o.select(F.col("order_key"), F.to_json(doc).alias("value"))
    again = F.replace("value", F.lit('"atocName":"'), F.lit('"atocName":"~'))
    copies = (F.when(F.col("order_key") % 11 == 3, F.array(again, "value"))
              .when(F.col("order_key") % 13 == 5, F.array("value", _cut("value"))).otherwise(F.array("value")))
    return text.select("order_key", F.explode(copies).alias("value")).select("value")


def _cut(text: str) -> Column:
    """A document whose transfer broke off half way."""
    return F.substr(text, F.lit(1), (F.length(text) / 2).cast("int"))


def station_search_documents(t: Tables, orders: DataFrame | None = None) -> DataFrame:
    """Station search documents as JSON text: one per calling point."""
    o = orders if orders is not None else order_services(t)
    first = F.get(F.col("locations"), 0)
    last = F.element_at(F.col("locations"), -1)
    stops = o.select("*", F.explode("locations").alias("stop"))
    journey = F.struct(
        F.struct(F.col("stop.tiploc").alias("tiploc"), F.col("stop.crs").alias("crs"),
                 F.col("stop.description").alias("description"),
                 _pair(first, F.col("origin_time")).alias("origin"),
                 _pair(last, F.col("destination_time")).alias("destination"),
                 F.col("stop.displayAs").alias("displayAs")).alias("locationDetail"),
        F.col("uid").alias("serviceUid"), F.col("run_date").alias("runDate"),
        F.col("atoc_name").alias("atocName"), F.col("service_type").alias("serviceType"))
    doc = F.struct(
        F.struct(F.col("stop.description").alias("name"), F.col("stop.crs").alias("crs"),
                 F.col("stop.tiploc").alias("tiploc")).alias("location"),
        F.array(journey).alias("services"))
    error = F.struct(F.lit(FETCH_ERROR).alias("error"), F.col("stop.crs").alias("Station"))
    copies = (F.when(F.col("order_key") % 17 == 2, F.array("value", F.to_json(error)))
              .when(F.col("order_key") % 17 == 6, F.array(_cut("value"), "value")).otherwise(F.array("value")))
    return stops.withColumn("value", F.to_json(doc)).select(F.explode(copies).alias("value"))


# --- incident messages -------------------------------------------------------

NS_DECL = ('xmlns:ns2="http://nationalrail.co.uk/xml/common" '
           'xmlns:ns3="http://nationalrail.co.uk/xml/incident"')


def xml_escape(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")),
                     F.lit(">"), F.lit("&gt;"))


def operator_code(suppkey: Column) -> Column:
    """Two-letter operator code of a supplier: AA, AB, ..."""
    first = (F.floor(suppkey / 26) % 26 + 65).cast("int")
    second = (suppkey % 26 + 65).cast("int")
    return F.concat(F.chr(first), F.chr(second))


def _el(name: str, value: Column, ns: str = "ns3") -> Column:
    return F.concat(F.lit(f"<{ns}:{name}>"), value, F.lit(f"</{ns}:{name}>"))


def incident_messages(t: Tables) -> DataFrame:
    """One incident message per order (column ``value``, plus ``version``).

    Operators: the order's distinct suppliers by key; routes: its distinct
    part names, sorted, joined by ' / ' inside an escaped paragraph. Some
    messages have no end time, no priority, no routes, no version, or are
    malformed. By order key, some repeat the validity period (the first
    counts), some have an operator container per operator, and some have what
    is affected one level deeper.
    """
    li = (t.lineitem.select("l_orderkey", "l_suppkey", "l_partkey")
          .join(t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_name", F.lit(True).alias("_s")), "l_suppkey", "left")
          .join(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_name", F.lit(True).alias("_p")), "l_partkey", "left"))
    # Line items go to their order once, as plain columns; an order needs a known supplier and a known part.
    sets = (li.repartition("l_orderkey").groupBy("l_orderkey")
            .agg(F.array_sort(F.collect_set(F.when(F.col("_s"), F.struct("l_suppkey", "s_name")))).alias("ops"),
                 F.array_sort(F.collect_set("p_name")).alias("routes"),
                 F.count("_s").alias("_s"), F.count("_p").alias("_p"))
            .where("_s > 0 AND _p > 0"))
    o = (t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate",
                         "o_orderstatus", "o_orderpriority")
         .join(sets, "l_orderkey"))
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    status, prio = F.col("o_orderstatus"), F.col("o_orderpriority")
    op_xml = F.array_join(F.transform("ops", lambda x: F.concat(
        F.lit("<ns3:AffectedOperator>"), _el("OperatorRef", operator_code(x["l_suppkey"])),
        _el("OperatorName", xml_escape(x["s_name"])), F.lit("</ns3:AffectedOperator>"))), "")
    route_text = F.concat(F.lit("<p>"), F.array_join("routes", " / "), F.lit("</p>"))
    no_end = prio == "5-LOW"
    no_priority = (status == "P") & (prio == "2-HIGH")
    no_routes = (status == "P") & (prio == "3-MEDIUM")
    malformed = (status == "P") & (prio == "4-NOT SPECIFIED")
    no_version = (status == "P") & (prio == "1-URGENT")
    shape = F.col("l_orderkey") % 7
    later = F.concat(_el("StartTime", F.lit("2031-01-01T00:00:00Z"), "ns2"), _el("EndTime", F.lit("2031-01-02T00:00:00Z"), "ns2"))
    boxes = F.when(shape == 4, F.replace(op_xml, F.lit("</ns3:AffectedOperator><ns3:AffectedOperator>"), F.lit(
        "</ns3:AffectedOperator></ns3:Operators><ns3:Operators><ns3:AffectedOperator>"))).otherwise(op_xml)
    affected = F.concat(_el("Operators", boxes), F.when(no_routes, F.lit("")).otherwise(
        _el("RoutesAffected", xml_escape(route_text))))
    body = F.concat(
        F.lit(f'<?xml version="1.0" encoding="UTF-8"?><ns3:PtIncident {NS_DECL}>'),
        _el("CreationTime", F.concat(day, F.lit("T08:30:00.123+01:00"))),
        _el("IncidentNumber", F.concat(F.lit("INC"), F.lpad(F.col("o_custkey").cast("string"), 6, "0"))),
        F.when(no_version, F.lit("")).otherwise(_el("Version", F.col("l_orderkey").cast("string"))),
        _el("Planned", F.when(status == "O", F.lit("true")).otherwise(F.lit("false"))),
        _el("ValidityPeriod", F.concat(
            _el("StartTime", F.concat(day, F.lit("T09:00:00Z")), "ns2"),
            F.when(no_end, F.lit("")).otherwise(
                _el("EndTime", F.concat(day, F.lit("T23:59:00.5+01:00")), "ns2")))),
        F.when((shape == 3) & ~no_end, _el("ValidityPeriod", later)).otherwise(F.lit("")),
        F.lit("<ns3:InfoLinks><ns3:InfoLink>"),
        _el("Uri", F.concat(F.lit("https://incidents.example/"), F.col("l_orderkey").cast("string"))),
        F.lit("</ns3:InfoLink></ns3:InfoLinks>"),
        _el("Summary", xml_escape(F.concat(F.lit("Disruption <"), prio, F.lit("> & delays")))),
        _el("Affects", F.when(shape == 5, _el("Scope", affected)).otherwise(affected)),
        F.when(no_priority, F.lit("")).otherwise(_el("IncidentPriority", F.substring(prio, 1, 1))),
        F.when(malformed, F.lit("")).otherwise(F.lit("</ns3:PtIncident>")))
    return o.select(F.col("l_orderkey").cast("string").alias("message_key"), body.alias("value"))


# --- operator pages (HTML) -------------------------------------------------------

OPERATORS_PER_PAGE = 50


def _satisfaction_text(acctbal: Column) -> Column:
    return F.when(acctbal < 0, F.lit("n/a")).otherwise(
        F.concat((F.floor(acctbal).cast("long") % 100).cast("string"), F.lit("%")))


def operator_pages(t: Tables) -> DataFrame:
    """Pages (page_id, url, html) listing operators in a 'dataframe wikitable'
    after a decoy 'infobox' table; 50 suppliers per page, some cells marked up.
    By page, tags are in capitals and quotes single, references numeric, or
    cells hold a table of their own."""
    s = t.supplier.select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    name = xml_escape(F.concat(F.col("s_name"), F.when(F.col("s_nationkey") == 3, F.lit(" & Sons"))
                               .otherwise(F.lit(""))))
    name_cell = (F.when(F.col("s_nationkey") == 3,
                        F.concat(F.lit('<a href="/wiki/op">'), name, F.lit("</a>")))
                 .when(F.col("s_nationkey") == 5, F.concat(F.lit("<b>"), name, F.lit("</b>")))
                 .otherwise(name))
    row = F.concat(F.lit("<tr>\n<td>"), name_cell, F.lit("</td>\n<td>"), operator_code(F.col("s_suppkey")),
                   F.lit("</td>\n<td>"), _satisfaction_text(F.col("s_acctbal")), F.lit("</td>\n</tr>"))
    pages = (s.select(F.floor(F.col("s_suppkey") / OPERATORS_PER_PAGE).cast("long").alias("page_id"),
                      F.struct("s_suppkey", row.alias("tr")).alias("r"))
             .groupBy("page_id").agg(F.array_sort(F.collect_list("r")).alias("rs")))
    body = F.array_join(F.transform("rs", lambda r: r["tr"]), "\n")
    html = F.concat(
        F.lit('<html><body><h1>Operators</h1><table class="infobox"><tr><th>Code</th></tr>'
              '<tr><td>decoy</td></tr></table>\n<table border="1" class="dataframe wikitable">\n'
              '<thead>\n<tr style="text-align: center;">\n<th>Operator</th>\n<th>Code</th>\n'
              '<th>Passenger satisfaction[1]</th>\n</tr>\n</thead>\n<tbody>\n'),
        body, F.lit("\n</tbody>\n</table></body></html>"))
    shouted, numeric, nested = html, F.replace(html, F.lit("&amp;"), F.lit("&#38;")), F.replace(
        html, F.lit("</b></td>"), F.lit("</b><table class='wikitable'><tr><td>note</td></tr></table></td>"))
    for low in ("<tr", "</tr", "<td", "</td", "<th", "</th", "<table", "</table"):
        shouted = F.replace(shouted, F.lit(low), F.lit(low.upper()))
    shouted = F.replace(shouted, F.lit('class="dataframe wikitable"'), F.lit("CLASS = 'dataframe wikitable'"))
    way = F.col("page_id") % 4
    html = F.when(way == 1, shouted).when(way == 2, numeric).when(way == 3, nested).otherwise(html)
    return pages.select("page_id", F.concat(F.lit("https://operators.example/page/"),
                                            F.col("page_id").cast("string")).alias("url"),
                        html.alias("html"))


def code_pages(codes: DataFrame) -> DataFrame:
    """Pages (page_id, html) that list cancel codes (column ``Code``) in a
    'wikitable', a few pages for all of them, as the published code list does."""
    row = F.concat(F.lit("<tr><td>"), xml_escape(F.col("Code")), F.lit("</td><td>cause of "), xml_escape(F.col("Code")),
                   F.lit("</td></tr>"))
    pages = codes.groupBy(F.pmod(F.xxhash64("Code"), F.lit(8)).alias("page_id")).agg(
        F.array_join(F.array_sort(F.collect_list(row)), "").alias("rows"))
    return pages.select("page_id", F.concat(F.lit('<table class="wikitable"><tr><th>Code</th><th>Cause</th></tr>'),
                                            F.col("rows"), F.lit("</table>")).alias("html"))
