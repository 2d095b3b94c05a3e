"""Registered queries for sources and sinks.

The JDBC source and sink (S07, K03) are in ``sinks.files`` but have no
registered query: exercising them needs a database, and none may be started
here (an embedded one would be seen by this process only).
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..constants import STATIONS
from ..operators import analytics as A
from ..schemas import FLAT_SERVICE
from ..session import materialize, run_root
from ..sinks.files import write_csv
from ..sources.binding import FLAT_COLUMNS, TIE_BREAK, service_rows
from ..sources.json_docs import read_service_csv
from ..sources.tables import Tables
from . import json_queries as JQ
from . import oracle as O
from .report import daily_report as _daily_report
from .services import star_schema_from_tables
from .store import services_store
from .wide_view import wide_services

SVC_COLUMNS = FLAT_COLUMNS + TIE_BREAK + ["l_linenumber"]


def _scratch(spark, name: str) -> str:
    return f"{run_root(spark)}/{name}-{uuid.uuid4().hex}"


def csv_roundtrip(spark, sf_dir):
    """K01 + S04: flat service rows written as CSV with a header and read back
    with the writer's explicit schema."""
    svc = service_rows(Tables(spark, sf_dir)).select(*SVC_COLUMNS)
    path = _scratch(spark, "svc-csv")
    write_csv(svc, path)
    return read_service_csv(spark, path, svc.schema)


def service_csv_scan(spark, sf_dir):
    """The extract's 17-field rows as CSV, read with the flat schema; a
    missing file reads as an empty frame (unioned in to show it)."""
    path = _scratch(spark, "extract-csv")
    write_csv(JQ.service_flatten(spark, sf_dir), path)
    found = read_service_csv(spark, path, FLAT_SERVICE)
    missing = read_service_csv(spark, path + "-missing", FLAT_SERVICE)
    return found.unionByName(missing)


def schema_switch(spark, sf_dir):
    """One table name in the ``service_data`` and ``incident_data``
    namespaces (stations; operators as stations of their code); an unqualified
    name resolves in the current database. The two are dropped in the end."""
    tag = uuid.uuid4().hex[:8]
    base = _scratch(spark, "catalog")
    prev = spark.catalog.currentDatabase()
    t = Tables(spark, sf_dir)
    content = {"service_data": star_schema_from_tables(t).station,
               "incident_data": t.supplier.select(F.col("s_suppkey").alias("station_id"), F.lit(None).cast("string").alias("crs"),
                                                  F.col("s_name").alias("station_name"))}
    out = []
    try:
        for db, rows in content.items():
            spark.sql(f"CREATE DATABASE {db}_{tag} LOCATION '{base}/{db}'")
            rows.write.saveAsTable(f"{db}_{tag}.station")
        for db in content:
            spark.catalog.setCurrentDatabase(f"{db}_{tag}")
            out.append(materialize(spark.table("station").withColumn("database_name", F.lit(db)), f"switch-{db}"))
    finally:
        spark.catalog.setCurrentDatabase(prev)
        for db in content:
            spark.sql(f"DROP DATABASE IF EXISTS {db}_{tag} CASCADE")
    return out[0].unionByName(out[1])


SCOPE_STATIONS = [f"C{i}" for i in range(1, len(STATIONS) + 1)]


def station_scope(spark, sf_dir):
    """Journeys of the stations in scope, as a broadcast semi join with
    the station list (ten codes: a fixed, proven size)."""
    stations = spark.createDataFrame([(c,) for c in SCOPE_STATIONS], "station_crs string")
    j = JQ.journeys_explode(spark, sf_dir)
    return j.join(F.broadcast(stations), "station_crs", "left_semi")


def daily_report(spark, sf_dir):
    """R08 + K04: report datasets of the day before ``as_of``, written under
    the report date and read back."""
    return _daily_report(services_store(spark, sf_dir), O.AS_OF, _scratch(spark, "report"))


def reached_pct_company_merge(spark, sf_dir):
    """A15 in its two-aggregate, full-outer-merge form (checks the one-pass form)."""
    v = wide_services(services_store(spark, sf_dir),
                      ["company_name", "destination_station_id", "reached_station_id"])
    return A.reached_pct_by_company_merge(v)


QUERIES = {
    "csv_roundtrip": csv_roundtrip,
    "service_csv_scan": service_csv_scan,
    "schema_switch": schema_switch,
    "station_scope": station_scope,
    "daily_report": daily_report,
    "reached_pct_company_merge": reached_pct_company_merge,
}


def _day_avg(key, limit="LIMIT 20"):
    return (f"SELECT {key} AS g, avg(arrival_lateness) AS v FROM day WHERE {key} IS NOT NULL GROUP BY 1 "
            f"ORDER BY v DESC NULLS LAST, g ASC {limit}")


def _lng(dataset, metric, sub):
    return (f"SELECT '{dataset}' AS dataset, CAST(g AS VARCHAR) AS group_key, '{metric}' AS metric, "
            f"CAST(v AS DOUBLE) AS value FROM ({sub})")


DAILY_REPORT = O.DAY_WIDE + "\n" + "\nUNION ALL ".join([
    _lng("services_per_station", "total_services",
         "SELECT origin_station_name AS g, count(*) AS v FROM day WHERE origin_station_name IS NOT NULL GROUP BY 1"),
    _lng("avg_delay_company_top", "avg_arrival_lateness", _day_avg("company_name")),
    _lng("total_delay_company", "total_arrival_lateness",
         "SELECT company_name AS g, coalesce(sum(arrival_lateness), 0) AS v FROM day WHERE company_name IS NOT NULL GROUP BY 1"),
    _lng("cancel_count_company", "cancel_code_count",
         "SELECT company_name AS g, count(cancel_code) AS v FROM day WHERE company_name IS NOT NULL GROUP BY 1"),
    _lng("mean_delay_station", "avg_arrival_lateness", _day_avg("origin_station_name", "")),
    _lng("cancel_count_station", "cancel_code_count",
         "SELECT origin_station_name AS g, count(cancel_code) AS v FROM day WHERE origin_station_name IS NOT NULL GROUP BY 1"),
    _lng("cancellations_station_top", "cancellation_count",
         "SELECT origin_station_name AS g, count(*) AS v FROM day WHERE origin_station_name IS NOT NULL "
         "AND cancellation_id IS NOT NULL GROUP BY 1 ORDER BY v DESC, g ASC LIMIT 20"),
    _lng("cancellations_company", "cancellation_count",
         "SELECT company_name AS g, count(*) AS v FROM day WHERE company_name IS NOT NULL "
         "AND cancellation_id IS NOT NULL GROUP BY 1"),
    _lng("avg_delay_station_top", "avg_arrival_lateness", _day_avg("origin_station_name")),
    "SELECT 'key_statistics', NULL, 'total_services', CAST(count(service_uid) AS DOUBLE) FROM day",
    "SELECT 'key_statistics', NULL, 'total_delays', CAST(count(arrival_lateness) AS DOUBLE) FROM day",
    "SELECT 'key_statistics', NULL, 'total_cancellations', CAST(count(cancellation_id) AS DOUBLE) FROM day",
    "SELECT 'key_statistics', NULL, 'avg_delay', CAST(avg(arrival_lateness) AS DOUBLE) FROM day",
])

_SVC_COLS = ", ".join(SVC_COLUMNS)
ORACLE = {
    "csv_roundtrip": O.services(f"SELECT {_SVC_COLS} FROM svc"),
    "service_csv_scan": JQ.DOCS_CTE + "\nSELECT * FROM flat",
    "schema_switch": O.services("""SELECT *, 'service_data' AS database_name FROM station
UNION ALL SELECT s_suppkey, NULL, s_name, 'incident_data' FROM supplier"""),
    "station_scope": JQ.DOCS_CTE + f"""
SELECT station_crs, uid AS service_uid, run_date, origin_desc AS origin_name, last_desc AS destination_name
FROM journeys WHERE station_crs IN ({O._in_list(SCOPE_STATIONS)})""",
    "daily_report": DAILY_REPORT,
    "reached_pct_company_merge": O.services(O.ANALYTICS["reached_pct_company"]),
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
