"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Star-schema loads (W) run as lazy plans from the driver tables; dashboard
and report queries (A, R, V) read the stored warehouse of the data folder
(``plans.store``), built once per session by the W10 load.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import analytics as A
from ..operators import report as R
from ..operators import warehouse as W
from ..operators.keys import assign_ids
from ..functions import cleaning as C
from ..functions import timestamps as TS
from ..operators import normalize as N
from ..sources.binding import service_rows, valid_code_list, valid_code_rows
from ..operators.part_filters import PartedTable
from ..session import materialize, path_exists, run_root, work_path
from ..sources.documents import code_pages
from ..sources.html import extract_html_table, table_columns
from ..sources.tables import Tables
from . import incident_queries, io_queries, json_queries, oracle, stream_queries
from .batch import batch_run
from .bucketed import append_bucketed, open_bucketed
from .captures import capture
from .month_states import FIGURES, States
from .services import TABLES, star_schema, star_schema_from_tables
from .store import inputs_digest, services_store
from .wide_view import wide_services

Query = Callable[[SparkSession, str], DataFrame]


def _star(table: str) -> Query:
    def q(spark, sf_dir):
        return getattr(star_schema_from_tables(Tables(spark, sf_dir)), table)
    return q


def _load_counts(spark, sf_dir):
    t = star_schema_from_tables(Tables(spark, sf_dir))
    parts = [getattr(t, name).agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count") for name in TABLES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _insert_if_absent(spark, sf_dir):
    """Load the services before a cut-off, then the whole batch on top: the
    result is the stored rows plus only the new keys, numbered after them."""
    t = Tables(spark, sf_dir)
    svc = materialize(service_rows(t), "insert-batch")  # read by every load below
    company = W.load_companies(svc)
    station, _ = W.load_stations(svc)
    stype = W.service_type_seed(spark)
    old = svc.where(F.col("origin_run_datetime") < F.lit(oracle.INSERT_IF_ABSENT_CUTOFF).cast("timestamp_ntz"))
    existing, _ = W.load_service_details(old, company, stype, station)
    new, _ = W.load_service_details(svc, company, stype, station, existing)
    return existing.unionByName(new)


def _assign_ids(spark, sf_dir):
    """W01 on the largest key set: every distinct (service_uid, run date) of
    the batch numbered in key order, distributed."""
    keys = service_rows(Tables(spark, sf_dir)).select(
        "service_uid", F.col("origin_run_datetime").alias("run_date")).distinct()
    return assign_ids(keys, ["service_uid", "run_date"], "service_key_id")


def _wide(columns=None, as_of=None):
    def make(spark, sf_dir):
        return wide_services(services_store(spark, sf_dir), columns, as_of)
    return make


def _on_view(fn, columns, **kw) -> Query:
    def q(spark, sf_dir):
        return fn(wide_services(services_store(spark, sf_dir), columns), **kw)
    return q


ST, CO, LT = "origin_station_name", "company_name", "arrival_lateness"
KEYS = ["service_uid", "l_partkey", "l_suppkey"]


def _raw(spark, sf_dir):
    """The extract's raw rows (as the extract step leaves them)."""
    return capture(spark, sf_dir, "raw_services")


def _published_codes(t: Tables):
    """The valid codes, read from the pages that list them (a small, written table)."""
    found = table_columns(extract_html_table(code_pages(valid_code_list(t)), "wikitable"), ["Code"])
    return materialize(found.select("Code").where(F.col("Code").isNotNull()).distinct(), "valid-codes")


def _transformed(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return N.transform_services(_raw(spark, sf_dir), _published_codes(t))


def _make_timestamp(spark, sf_dir):
    r = _raw(spark, sf_dir)
    return r.select(*KEYS, "origin_run_date", "origin_run_time",
                    TS.date_time_to_timestamp("origin_run_date", "origin_run_time")
                    .alias("origin_run_datetime"))


def _hhmmss_epoch(spark, sf_dir):
    r = _raw(spark, sf_dir)
    return r.select(*KEYS, "scheduled_arrival_time",
                    TS.hhmmss_epoch("scheduled_arrival_time", "1998-01-07").alias("arrival_epoch"))


def _integers(spark, sf_dir):
    r = _raw(spark, sf_dir)
    return r.select(*KEYS, F.col("arrival_lateness").alias("lateness_text"),
                    C.integers_or_null("arrival_lateness").alias("arrival_lateness"))


def _crs_null(spark, sf_dir):
    r = _raw(spark, sf_dir).select(*KEYS, F.col("cancellation_station_crs").alias("crs_text"),
                                   "cancellation_station_crs")
    return N.check_three_chars(r, "cancellation_station_crs", False)


def _crs_drop(spark, sf_dir):
    return N.check_three_chars(_raw(spark, sf_dir).select(*KEYS, "origin_crs"), "origin_crs", True)


def _valid_cancel_code(spark, sf_dir):
    t = Tables(spark, sf_dir)
    r = _raw(spark, sf_dir).select(*KEYS, F.col("cancel_code").alias("code_text"), "cancel_code")
    return N.valid_codes(r, "cancel_code", _published_codes(t))


TRANSFORMED = ["service_uid", "company_name", "service_type", "origin_crs", "origin_stn_name",
               "planned_final_destination", "planned_final_crs", "destination_reached_crs",
               "destination_reached_name", "arrival_lateness", "cancellation_station_crs",
               "cancellation_station_name", "cancel_code", "scheduled_arrival_datetime",
               "origin_run_datetime", "l_partkey", "l_suppkey"]


def _service_transform(spark, sf_dir):
    return _transformed(spark, sf_dir).select(*TRANSFORMED)


def _load_rejects(spark, sf_dir):
    """Cancellations of the cleaned batch that fail a required lookup."""
    t = Tables(spark, sf_dir)
    svc = N.transform_services(_raw(spark, sf_dir), _published_codes(t))
    star = star_schema(spark, svc, valid_code_rows(t))
    # the batch as written: cleaned once, not for each pass over it
    _, rejects = W.load_cancellations(star.svc, star.service_details, star.station, star.cancel_code, repeated=star.repeated)
    return rejects.select("service_uid", "origin_run_datetime", "reject_reason")


def _from_states(name: str) -> Query:
    """A figure of the dashboard from the stored month states."""
    def q(spark, sf_dir):
        services_store(spark, sf_dir)
        return getattr(States(spark, f"{run_root(spark)}/store-{inputs_digest(spark, sf_dir)}"), name)()
    return q


BUCKETS = 8


def _wide_bucketed(spark, sf_dir):
    """V01 over bucketed facts."""
    t = services_store(spark, sf_dir)
    root = f"{run_root(spark)}/bucketed-{inputs_digest(spark, sf_dir)}"
    if not path_exists(spark, root):
        append_bucketed(spark, t, root, BUCKETS)
    return wide_services(open_bucketed(spark, t, root, BUCKETS))


PART_CUTS = ["1993-01-01", "1994-01-01", "1995-01-01", "1996-01-01", "1997-01-01"]


def _insert_if_absent_parts(spark, sf_dir):
    """W02 with part filters: the services of a year at a time as stored parts,
    then the whole batch on top; only parts that may hold a key are read. The
    result numbers all keys, the stored ones first."""
    t = Tables(spark, sf_dir)
    run = F.col("origin_run_datetime")
    keys = materialize(service_rows(t).select("service_uid", run.alias("run_date")).distinct(), "part-keys")
    table = PartedTable(spark, work_path(spark, "parted"), "service_keys", ["service_uid", "run_date"], max(1, keys.count() // 4))
    cut = lambda day: F.col("run_date") < F.lit(day).cast("timestamp_ntz")
    for low, high in zip([None, *PART_CUTS], PART_CUTS):
        table.append(keys.where(cut(high) if low is None else cut(high) & ~cut(low)))
    stored = table.read(table.parts())
    new = table.absent(keys)
    return stored.select("*", F.lit(True).alias("stored")).unionByName(new.select("*", F.lit(False).alias("stored")))


def _batch_run(spark, sf_dir):
    """Every step of the batch, from captured documents to the star schema."""
    t = Tables(spark, sf_dir)
    return batch_run(spark, json_queries._journeys(spark, sf_dir), json_queries._good_services(spark, sf_dir), _published_codes(t),
                     valid_code_rows(t), work_path(spark, "batch"))[0]


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {
        "dim_cancel_code": _star("cancel_code"),
        "dim_company": _star("company"),
        "dim_station": _star("station"),
        "fact_service_details": _star("service_details"),
        "fact_delay_details": _star("delay_details"),
        "fact_cancellation": _star("cancellation"),
        "load_counts": _load_counts,
        "insert_if_absent": _insert_if_absent,
        "assign_ids": _assign_ids,
        "wide_services": _wide(),
        "wide_services_day": _wide(as_of=oracle.AS_OF),
        "kpi_totals": _on_view(A.kpi_totals, [LT, "cancellation_id"]),
        "most_delayed_station": _on_view(A.most_delayed_station, [ST, LT, "service_details_id"]),
        "busiest_station": _on_view(A.busiest_station, [ST]),
        "most_cancelled_station": _on_view(A.most_cancelled_station, [ST, "cancellation_id"]),
        "avg_delay": _on_view(A.avg_delay, [LT]),
        "filter_selected": lambda s, d: A.filter_selected(
            wide_services(services_store(s, d), ["service_details_id", ST, LT]), ST,
            oracle.SELECTED_STATIONS),
        "avg_delay_station_top": _on_view(A.avg_delay_by_station, [ST, LT]),
        "cancellations_station_top": _on_view(A.cancellations_by_station, [ST, "cancellation_id"]),
        "bus_replacements": _on_view(A.bus_replacements, [ST, "service_type_name"]),
        "bus_replacements_total": _on_view(A.bus_replacements_total, [ST, "service_type_name"]),
        "destination_status": _on_view(A.destination_status, [ST, "reached_station_id"]),
        "lateness_scatter": _on_view(A.lateness_vs_schedule,
                                     ["service_details_id", "scheduled_arrival", LT, ST,
                                      "destination_station_name"]),
        "cancel_code_frequency": _on_view(A.cancel_code_frequency, ["cancel_code", "cancel_reason"]),
        "avg_delay_company_top": _on_view(A.avg_delay_by_company, [CO, LT]),
        "cancellations_company_top": _on_view(A.cancellations_by_company, [CO, "cancel_code"]),
        "cancellations_company_reason": _on_view(A.cancellations_by_company_reason,
                                                 [CO, "cancel_code", "cancel_reason"]),
        "reached_pct_company": _on_view(A.reached_pct_by_company,
                                        [CO, "destination_station_id", "reached_station_id"]),
        "distinct_stations": _on_view(A.distinct_values, [ST], column=ST),
        "distinct_companies": _on_view(A.distinct_values, [CO], column=CO),
        "services_per_station": _on_view(R.services_per_station, [ST]),
        "total_delay_company": _on_view(R.total_delay_by_company, [CO, LT]),
        "cancel_count_company": _on_view(R.cancel_codes_by_company, [CO, "cancel_code"]),
        "mean_delay_station": _on_view(R.mean_delay_by_station, [ST, LT]),
        "cancel_count_station": _on_view(R.cancel_codes_by_station, [ST, "cancel_code"]),
        "cancellations_company": _on_view(R.cancellations_per_company, [CO, "cancellation_id"]),
        "key_statistics": _on_view(R.key_statistics, ["service_uid", LT, "cancellation_id"]),
        "make_timestamp": _make_timestamp,
        "hhmmss_epoch": _hhmmss_epoch,
        "integers_or_null": _integers,
        "crs_null": _crs_null,
        "crs_drop": _crs_drop,
        "valid_cancel_code": _valid_cancel_code,
        "service_transform": _service_transform,
        "load_rejects": _load_rejects,
        "wide_services_bucketed": _wide_bucketed,
        "insert_if_absent_parts": _insert_if_absent_parts,
        "batch_run": _batch_run,
        **{f"{name}_from_states": _from_states(name) for name in FIGURES},
    }
    q.update(json_queries.QUERIES)
    q.update(incident_queries.QUERIES)
    q.update(stream_queries.QUERIES)
    q.update(io_queries.QUERIES)
    return q


def oracle_sql() -> dict[str, str]:
    out = oracle.oracle_sql()
    out.update({f"{name}_from_states": out[name] for name in FIGURES})
    out["wide_services_bucketed"] = out["wide_services"]
    out["insert_if_absent_parts"] = oracle.services(f"""SELECT DISTINCT service_uid, origin_run_datetime AS run_date,
        origin_run_datetime < TIMESTAMP '{PART_CUTS[-1]}' AS stored FROM svc""")
    out["batch_run"] = json_queries.DOCS_CTE + json_queries.BATCH_RUN
    out.update(json_queries.oracle_sql())
    out.update(incident_queries.oracle_sql())
    out.update(stream_queries.oracle_sql())
    out.update(io_queries.oracle_sql())
    return out
