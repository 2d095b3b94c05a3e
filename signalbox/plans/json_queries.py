"""Registered queries over the service and station-search documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import extract as X
from ..schemas import SERVICE, STATION_SEARCH
from ..sources import json_docs as J
from .captures import capture


def _services(spark, sf_dir):
    return J.parse_json(capture(spark, sf_dir, "service_documents"), SERVICE)


def _good_services(spark, sf_dir):
    good, _ = J.split_fetch_errors(_services(spark, sf_dir), "Service")
    return good


def _searches(spark, sf_dir):
    return J.parse_json(capture(spark, sf_dir, "station_searches"), STATION_SEARCH)


def _journeys(spark, sf_dir):
    return J.journeys(_searches(spark, sf_dir))


def _flat(spark, sf_dir):
    return X.relevant_fields(_journeys(spark, sf_dir), _good_services(spark, sf_dir))


def services_json(spark, sf_dir):
    d = F.col("doc")
    return _good_services(spark, sf_dir).select(
        d["serviceUid"].alias("service_uid"), d["runDate"].alias("run_date"),
        d["serviceType"].alias("service_type"), d["atocName"].alias("company_name"),
        F.when(d["locations"].isNotNull(), F.size(d["locations"])).alias("n_locations"))


def fetch_errors_split(spark, sf_dir):
    """Errors of both kinds of documents, fetched for a service or a station."""
    sides = {"Service": _services(spark, sf_dir), "Station": _searches(spark, sf_dir)}
    out = [J.split_fetch_errors(docs, key)[1].select(F.lit(key).alias("fetched"), "error", F.col(key).alias("fetch_key"))
           for key, docs in sides.items()]
    return out[0].unionByName(out[1])


def journeys_explode(spark, sf_dir):
    j = F.col("journey")
    return _journeys(spark, sf_dir).select(
        "station_crs", j["serviceUid"].alias("service_uid"), j["runDate"].alias("run_date"),
        F.get(j["locationDetail"]["origin"], 0)["description"].alias("origin_name"),
        F.get(j["locationDetail"]["destination"], 0)["description"].alias("destination_name"))


def _facts(spark, sf_dir):
    return X.service_facts(_good_services(spark, sf_dir))


def array_endpoints(spark, sf_dir):
    return _facts(spark, sf_dir).select("service_uid", "origin_crs", "planned_final_crs",
                                        "planned_final_destination")


def terminal_location(spark, sf_dir):
    return _facts(spark, sf_dir).select("service_uid", F.col("terminal.crs").alias("terminal_crs"),
                                        F.col("terminal.displayAs").alias("terminal_display"))


def lateness_default(spark, sf_dir):
    return _facts(spark, sf_dir).select("service_uid", "arrival_lateness")


def cancelled_call(spark, sf_dir):
    return _facts(spark, sf_dir).select(
        "service_uid", F.col("cancelled.crs").alias("cancellation_station_crs"),
        F.col("cancelled.description").alias("cancellation_station_name"),
        F.col("cancelled.code").alias("cancel_code"))


def destination_reached(spark, sf_dir):
    flat, _ = _flat(spark, sf_dir)
    return flat.select("service_uid", "destination_reached_crs", "destination_reached_name").distinct()


def service_flatten(spark, sf_dir):
    return _flat(spark, sf_dir)[0]


def extract_quarantine(spark, sf_dir):
    return _flat(spark, sf_dir)[1]


QUERIES = {
    "services_json": services_json,
    "fetch_errors_split": fetch_errors_split,
    "journeys_explode": journeys_explode,
    "array_endpoints": array_endpoints,
    "terminal_location": terminal_location,
    "lateness_default": lateness_default,
    "cancelled_call": cancelled_call,
    "destination_reached": destination_reached,
    "service_flatten": service_flatten,
    "extract_quarantine": extract_quarantine,
}

_HMS = "lpad(CAST(({s}) // 3600 * 10000 + ({s}) % 3600 // 60 * 100 + ({s}) % 60 AS VARCHAR), 6, '0')"
DOCS_CTE = f"""WITH
li AS (
  SELECT l.*, p_brand, p_size,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
                            l_extendedprice, l_discount, l_tax, l_quantity) AS pos
  FROM lineitem l JOIN part ON l_partkey = p_partkey
),
loc AS (
  SELECT l_orderkey, pos, 'T' || CAST(l_suppkey AS VARCHAR) AS tiploc, 'C' || CAST(l_suppkey AS VARCHAR) AS crs,
         'Stop ' || CAST(l_suppkey AS VARCHAR) AS description,
         CASE WHEN l_returnflag = 'R' THEN 'CANCELLED_CALL'
              WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'TERMINATES' ELSE 'CALL' END AS display,
         CASE WHEN l_quantity % 3 <> 0 THEN CAST(l_quantity AS INTEGER) END AS lateness,
         CASE WHEN l_returnflag = 'R' AND p_size <= 45 THEN p_brand END AS reason_code
  FROM li
),
ends AS (
  SELECT l_orderkey, max(pos) AS n,
         min(pos) FILTER (WHERE display IN ('TERMINATES', 'DESTINATION')) AS term_pos,
         min(pos) FILTER (WHERE display = 'CANCELLED_CALL') AS cancel_pos
  FROM loc GROUP BY l_orderkey
),
svcdoc AS (
  SELECT o_orderkey, 'O' || CAST(o_orderkey AS VARCHAR) AS uid, strftime(o_orderdate, '%Y-%m-%d') AS run_date,
         c_mktsegment AS atoc_name, CASE WHEN o_orderstatus = 'F' THEN 'bus' ELSE 'train' END AS service_type,
         {_HMS.format(s="(o_orderkey * 97) % 86400")} AS origin_time,
         {_HMS.format(s="((o_orderkey * 97) % 86400 + 7200) % 86400")} AS destination_time,
         (o_orderstatus = 'P' AND o_orderpriority = '1-URGENT') AS fetch_error,
         (o_orderstatus = 'F' AND o_orderpriority = '5-LOW') AS no_locations
  FROM orders JOIN customer ON o_custkey = c_custkey
  WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)
),
facts AS (
  SELECT s.*, e.n, f.crs AS origin_crs, f.description AS origin_desc, la.crs AS last_crs,
         la.description AS last_desc, t.crs AS term_crs, t.display AS term_display,
         t.lateness AS term_lateness, e.term_pos, c.crs AS c_crs, c.description AS c_desc,
         c.reason_code AS c_code
  FROM svcdoc s
  JOIN ends e ON e.l_orderkey = s.o_orderkey
  JOIN loc f ON f.l_orderkey = s.o_orderkey AND f.pos = 1
  JOIN loc la ON la.l_orderkey = s.o_orderkey AND la.pos = e.n
  LEFT JOIN loc t ON t.l_orderkey = s.o_orderkey AND t.pos = e.term_pos
  LEFT JOIN loc c ON c.l_orderkey = s.o_orderkey AND c.pos = e.cancel_pos
),
captured AS (  -- each good capture of a service; the second of two has another company
  SELECT *, atoc_name AS company FROM facts WHERE NOT fetch_error
  UNION ALL SELECT *, '~' || atoc_name FROM facts WHERE NOT fetch_error AND o_orderkey % 11 = 3
),
journeys AS (
  SELECT l.crs AS station_crs, f.* FROM loc l JOIN facts f ON f.o_orderkey = l.l_orderkey
),
flat AS (
  SELECT uid AS service_uid, atoc_name AS company_name, service_type, origin_crs,
         origin_desc AS origin_stn_name, origin_time AS origin_run_time, run_date AS origin_run_date,
         last_desc AS planned_final_destination, last_crs AS planned_final_crs,
         CASE WHEN term_pos IS NULL THEN origin_crs ELSE term_crs END AS destination_reached_crs,
         CASE WHEN term_pos IS NULL THEN origin_desc ELSE last_desc END AS destination_reached_name,
         destination_time AS scheduled_arrival_time, run_date AS scheduled_arrival_date,
         CASE WHEN term_pos IS NOT NULL THEN coalesce(term_lateness, 0) END AS arrival_lateness,
         CASE WHEN c_crs IS NOT NULL AND c_desc IS NOT NULL AND c_code IS NOT NULL THEN c_crs END
           AS cancellation_station_crs,
         CASE WHEN c_crs IS NOT NULL AND c_desc IS NOT NULL AND c_code IS NOT NULL THEN c_desc END
           AS cancellation_station_name,
         CASE WHEN c_crs IS NOT NULL AND c_desc IS NOT NULL AND c_code IS NOT NULL THEN c_code END
           AS cancel_code
  FROM journeys WHERE NOT fetch_error AND NOT no_locations
)"""


_CODED = "upper(trim(cancel_code)) IN (SELECT upper(p_brand) FROM part WHERE p_brand IS NOT NULL AND upper(p_brand) NOT LIKE '%5')"
#: Rows of each step of the batch; three-letter codes are required, and a
#: cancellation needs a known code and a station of three letters.
BATCH_RUN = f""",
clean AS (SELECT * FROM flat WHERE length(origin_crs) = 3 AND length(planned_final_crs) = 3 AND length(destination_reached_crs) = 3),
keyed AS (SELECT DISTINCT service_uid, origin_run_date, arrival_lateness, {_CODED} AS coded,
                 length(cancellation_station_crs) = 3 AS placed FROM clean),
tally AS (
  SELECT (SELECT count(*) FROM journeys) AS j, (SELECT count(*) FROM flat) AS f, (SELECT count(*) FROM clean) AS c,
         (SELECT count(*) FROM keyed) AS k, (SELECT count(*) FROM keyed WHERE arrival_lateness > 0) AS d,
         (SELECT count(*) FROM keyed WHERE coded) AS n, (SELECT count(*) FROM keyed WHERE coded AND placed) AS p)
SELECT 'extract' AS step, j AS rows_in, f AS rows_out, j - f AS set_aside, 0 AS repeated FROM tally
UNION ALL SELECT 'clean', f, c, f - c, 0 FROM tally
UNION ALL SELECT 'load service_details', c, k, 0, c - k FROM tally
UNION ALL SELECT 'load delay_details', d, d, 0, 0 FROM tally
UNION ALL SELECT 'load cancellation', n, p, n - p, 0 FROM tally"""


def _with_calls(expr: str) -> str:
    """Null where the document has no calling points."""
    return f"CASE WHEN NOT no_locations THEN {expr} END"


def _cancelled(expr: str) -> str:
    return _with_calls(f"CASE WHEN c_crs IS NOT NULL AND c_desc IS NOT NULL AND c_code IS NOT NULL THEN {expr} END")


ORACLE = {
    "services_json": """SELECT uid AS service_uid, run_date, service_type, company AS company_name,
        CASE WHEN no_locations THEN NULL ELSE n END AS n_locations FROM captured""",
    "fetch_errors_split": """SELECT 'Service' AS fetched, 'Timeout: The request could not be completed.' AS error,
        uid AS fetch_key FROM facts, unnest(range(CASE WHEN o_orderkey % 11 = 3 THEN 2 ELSE 1 END)) WHERE fetch_error
      UNION ALL SELECT 'Service', 'malformed document', NULL FROM facts WHERE o_orderkey % 11 <> 3 AND o_orderkey % 13 = 5
      UNION ALL SELECT 'Station', 'Timeout: The request could not be completed.', station_crs FROM journeys WHERE o_orderkey % 17 = 2
      UNION ALL SELECT 'Station', 'malformed document', NULL FROM journeys WHERE o_orderkey % 17 = 6""",
    "journeys_explode": """SELECT station_crs, uid AS service_uid, run_date, origin_desc AS origin_name,
        last_desc AS destination_name FROM journeys""",
    "array_endpoints": f"""SELECT uid AS service_uid, {_with_calls("origin_crs")} AS origin_crs,
        {_with_calls("last_crs")} AS planned_final_crs, {_with_calls("last_desc")} AS planned_final_destination FROM captured""",
    "terminal_location": f"""SELECT uid AS service_uid, {_with_calls("term_crs")} AS terminal_crs,
        {_with_calls("term_display")} AS terminal_display FROM captured""",
    "lateness_default": f"""SELECT uid AS service_uid,
        {_with_calls("CASE WHEN term_pos IS NOT NULL THEN coalesce(term_lateness, 0) END")} AS arrival_lateness FROM captured""",
    "cancelled_call": f"""SELECT uid AS service_uid, {_cancelled("c_crs")} AS cancellation_station_crs,
        {_cancelled("c_desc")} AS cancellation_station_name, {_cancelled("c_code")} AS cancel_code FROM captured""",
    "destination_reached": """SELECT DISTINCT service_uid, destination_reached_crs, destination_reached_name FROM flat""",
    "service_flatten": "SELECT * FROM flat",
    "extract_quarantine": """SELECT uid AS service_uid, run_date, station_crs,
        CASE WHEN fetch_error THEN 'no service document' ELSE 'no locations' END AS reason
        FROM journeys WHERE fetch_error OR no_locations""",
}


def oracle_sql() -> dict[str, str]:
    return {k: DOCS_CTE + "\n" + v for k, v in ORACLE.items()}
