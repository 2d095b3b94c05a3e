"""Registered queries against their DuckDB oracle on the smallest tables,
plus load idempotence (the driver runs the full list at sf0.01)."""

import pytest

import __spark_entry__ as E
from signalbox.plans import registry
from tools.oracle_check import duck, rows_of

from .conftest import SMALL

CHECKED = ["dim_station", "fact_cancellation", "wide_services", "kpi_totals", "avg_delay_station_top",
           "cancel_code_frequency", "reached_pct_company", "insert_if_absent", "service_transform",
           "load_rejects", "service_flatten", "extract_quarantine", "incident_flatten",
           "link_incident_operator", "alert_text", "html_table_extract", "daily_report",
           "stream_restart", "csv_roundtrip"]


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SMALL)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert rows_of(df.columns, srows) == rows_of(dcols, res.fetchall())


def test_every_query_has_an_oracle():
    assert set(registry.queries()) == set(registry.oracle_sql())


def test_entry_runs(spark):
    assert E.entry(spark).count() > 0


def test_load_all_twice_appends_nothing(spark, tmp_path):
    from signalbox.plans.services import load_all
    from signalbox.sources.binding import cancel_code_rows, service_rows
    from signalbox.sources.tables import Tables
    t = Tables(spark, SMALL)
    root = f"{tmp_path}/wh"
    first = load_all(spark, service_rows(t), cancel_code_rows(t), root)
    assert first["service_details"] > 0
    again = load_all(spark, service_rows(t), cancel_code_rows(t), root)
    assert set(again.values()) == {0}


def test_load_on_top_of_older_months(spark, tmp_path):
    """A stored warehouse holding the services before a cut-off, then the whole
    batch: only the new keys are appended (the anti join reads the pruned
    months), ids continue after the stored ones, and totals equal one load."""
    from pyspark.sql import functions as F

    from signalbox.plans.services import load_all
    from signalbox.sources.binding import cancel_code_rows, service_rows
    from signalbox.sources.tables import Tables
    t = Tables(spark, SMALL)
    root = f"{tmp_path}/wh"
    svc = service_rows(t)
    cut = F.lit("1997-01-01").cast("timestamp_ntz")
    first = load_all(spark, svc.where(F.col("origin_run_datetime") < cut), cancel_code_rows(t), root)
    second = load_all(spark, svc, cancel_code_rows(t), root)
    fresh = load_all(spark, svc, cancel_code_rows(t), f"{tmp_path}/fresh")
    for name in ("service_details", "delay_details", "cancellation"):
        assert first[name] + second[name] == fresh[name]
    sd = spark.read.parquet(f"{root}/service_details")
    assert sd.select("service_details_id").distinct().count() == fresh["service_details"]
    assert sd.agg(F.max("service_details_id")).first()[0] == fresh["service_details"]
    old_max = sd.where(F.col("run_date") < cut).agg(F.max("service_details_id")).first()[0]
    assert old_max == first["service_details"]
