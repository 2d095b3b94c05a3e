"""Month states, bucketed facts, part filters, the report's one pass, counts of a load."""

import os
import re

import pytest
from pyspark.sql import functions as F

from signalbox.operators import analytics as A
from signalbox.operators import report as R
from signalbox.operators.part_filters import PartedTable
from signalbox.plans import store
from signalbox.plans.bucketed import append_bucketed, open_bucketed
from signalbox.plans.month_states import CODE_STATE, STATION_STATE, States, refresh
from signalbox.plans.report import REPORT_COLUMNS, report_datasets
from signalbox.plans.services import load_all, open_star_schema
from signalbox.plans.wide_view import wide_services
from signalbox.session import release_run
from signalbox.sources.binding import cancel_code_rows, service_rows
from signalbox.sources.tables import Tables

from .conftest import SMALL


@pytest.fixture(scope="module")
def batch(spark):
    t = Tables(spark, SMALL)
    svc, codes = service_rows(t).where(F.col("l_partkey") % 4 == 0), cancel_code_rows(t)
    return svc, codes


def figures(spark, root):
    s = States(spark, root)
    return {n: sorted(map(str, getattr(s, n)().collect())) for n in ("kpi_totals", "avg_delay", "destination_status",
                                                                      "cancellations_company_reason", "most_delayed_station")}


def from_view(t):
    v = wide_services(t)
    return {"kpi_totals": A.kpi_totals(v), "avg_delay": A.avg_delay(v), "destination_status": A.destination_status(v),
            "cancellations_company_reason": A.cancellations_by_company_reason(v), "most_delayed_station": A.most_delayed_station(v)}


def months_written(root, name):
    return {m: max(os.path.getmtime(f"{root}/{name}/{m}/{f}") for f in os.listdir(f"{root}/{name}/{m}"))
            for m in os.listdir(f"{root}/{name}") if m.startswith("run_month=")}


def test_a_one_day_load_rewrites_one_month_and_late_rows_count(spark, tmp_path, batch):
    svc, codes = batch
    root, day = f"{tmp_path}/wh", F.to_date("origin_run_datetime")
    late_day = svc.select(day.alias("d")).orderBy("d").first().d      # rows of the first month come last
    load_all(spark, svc.where(day != F.lit(late_day)), codes, root, f"{tmp_path}/rej", states=True)
    before = {n: months_written(root, n) for n in (STATION_STATE, CODE_STATE)}
    load_all(spark, svc.where(day == F.lit(late_day)), codes, root, f"{tmp_path}/rej", states=True)
    for n, old in before.items():
        new = months_written(root, n)
        assert {m for m in new if new[m] != old.get(m)} == {f"run_month={late_day.replace(day=1)}"}
    after = figures(spark, root)
    t = open_star_schema(spark, root)
    want = {n: sorted(map(str, df.collect())) for n, df in from_view(t).items()}
    assert after == want
    refresh(spark, root, t.service_details.select("run_month"))       # a full recomputation
    assert figures(spark, root) == want


def test_bucketed_facts_join_without_exchange(spark, tmp_path, batch):
    svc, codes = batch
    root = f"{tmp_path}/wh"
    load_all(spark, svc, codes, root, f"{tmp_path}/rej")
    t = open_star_schema(spark, root)
    append_bucketed(spark, t, f"{tmp_path}/bucketed", 4)
    b = open_bucketed(spark, t, f"{tmp_path}/bucketed", 4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = wide_services(b)._jdf.queryExecution().sparkPlan().toString()
        physical = wide_services(b, ["service_uid", "arrival_lateness", "cancellation_id"])._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in physical and physical.count("SortMergeJoin") == 2, physical
        whole = wide_services(b)._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(service_details_id" not in whole and "SortMergeJoin" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted(map(str, wide_services(b).collect())) == sorted(map(str, wide_services(t).collect()))
    spark.sql(f"DROP TABLE {re.search(r'bucketed_[0-9a-f]+', str(spark.sql('SHOW DATABASES').collect()))[0]}.cancellation")
    again = open_bucketed(spark, t, f"{tmp_path}/bucketed", 4)        # as another session finds it
    assert again.cancellation.count() == t.cancellation.count()


def test_report_scans_the_day_once_and_equals_the_single_datasets(spark, tmp_path, batch):
    svc, codes = batch
    load_all(spark, svc, codes, f"{tmp_path}/wh", f"{tmp_path}/rej")
    view = wide_services(open_star_schema(spark, f"{tmp_path}/wh"), REPORT_COLUMNS)
    view.write.parquet(f"{tmp_path}/day")
    day = spark.read.parquet(f"{tmp_path}/day")
    out = report_datasets(day)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[0].count("FileScan parquet") == 1
    got = {}
    for r in out.collect():
        got.setdefault(r.dataset, {})[(r.group_key, r.metric)] = r.value
    single = {"services_per_station": (R.services_per_station(day), A.STATION, "total_services"),
              "avg_delay_company_top": (A.avg_delay_by_company(day), A.COMPANY, "avg_arrival_lateness"),
              "total_delay_company": (R.total_delay_by_company(day), A.COMPANY, "total_arrival_lateness"),
              "cancel_count_company": (R.cancel_codes_by_company(day), A.COMPANY, "cancel_code_count"),
              "mean_delay_station": (R.mean_delay_by_station(day), A.STATION, "avg_arrival_lateness"),
              "cancel_count_station": (R.cancel_codes_by_station(day), A.STATION, "cancel_code_count"),
              "cancellations_station_top": (A.cancellations_by_station(day), A.STATION, "cancellation_count"),
              "cancellations_company": (R.cancellations_per_company(day), A.COMPANY, "cancellation_count"),
              "avg_delay_station_top": (A.avg_delay_by_station(day), A.STATION, "avg_arrival_lateness")}
    for name, (df, key, metric) in single.items():
        assert got[name] == {(r[key], metric): None if r[metric] is None else float(r[metric]) for r in df.collect()}, name
    none = {(r.dataset, r.metric): r.value for r in report_datasets(day.where("false")).collect()}
    assert none == {("key_statistics", "total_services"): 0.0, ("key_statistics", "total_delays"): 0.0,
                    ("key_statistics", "total_cancellations"): 0.0, ("key_statistics", "avg_delay"): None}


def keys(spark, low, high):
    return spark.range(low, high).select(F.concat(F.lit("V"), "id").alias("version"), F.col("id").alias("n"))


def test_new_keys_read_few_stored_rows(spark, tmp_path):
    table = PartedTable(spark, f"{tmp_path}", "versions", ["version"], 500)
    for p in range(20):
        table.append(keys(spark, 500 * p, 500 * (p + 1)))
    assert table.absent(keys(spark, 50_000, 50_300)).count() == 300
    assert len(table.read_parts) * 500 < 0.05 * 10_000
    some = keys(spark, 1200, 1210).unionByName(keys(spark, 90_000, 90_005))
    assert sorted(r.n for r in table.absent(some).collect()) == list(range(90_000, 90_005))
    assert 2 in table.read_parts and len(table.read_parts) <= 2
    merged = table.merge([0, 1, 2])
    assert sorted(r.n for r in table.absent(some).collect()) == list(range(90_000, 90_005)) and merged in table.read_parts
    assert table.read(table.parts()).count() == 10_000 and len(table.parts()) == 18


def test_a_false_positive_changes_nothing(spark, tmp_path):
    table = PartedTable(spark, f"{tmp_path}", "versions", ["version"], 1)     # far too few bits: every filter is full
    for p in range(3):
        table.append(keys(spark, 2000 * p, 2000 * (p + 1)))
    assert table.absent(keys(spark, 5990, 6010)).count() == 10
    assert table.read_parts == [0, 1, 2]
    assert PartedTable(spark, f"{tmp_path}", "none", ["version"], 9).absent(keys(spark, 0, 4)).count() == 4


def test_a_load_accounts_for_its_rows(spark, tmp_path, batch):
    svc, codes = batch
    rows = svc.withColumn("cancellation_station_crs", F.when(F.col("l_partkey") % 8 == 0, F.lit("XXX")).otherwise(F.col("cancellation_station_crs")))
    rows = rows.withColumn("cancellation_station_name", F.when(F.col("l_partkey") % 8 != 0, F.col("cancellation_station_name")))
    done = load_all(spark, rows, codes, f"{tmp_path}/wh", f"{tmp_path}/rej")
    for name, step in done.steps.items():
        stored = spark.read.parquet(f"{tmp_path}/wh/{name}").count()
        refused = spark.read.parquet(f"{tmp_path}/rej/{name}").count()
        assert (step["appended"], step["rejected"], step["stored_before"]) == (stored, refused, 0) and step["rows_in"] == stored + refused
        assert done[name] == stored
    assert done.steps["cancellation"]["rejected"] > 0
    again = load_all(spark, rows, codes, f"{tmp_path}/wh", f"{tmp_path}/rej")
    assert set(again.values()) == {0} and again.steps["service_details"]["stored_before"] == done["service_details"]


def test_a_released_run_loads_its_store_anew(spark):
    first = A.kpi_totals(wide_services(store.services_store(spark, SMALL), ["arrival_lateness", "cancellation_id"])).collect()
    release_run(spark)
    assert A.kpi_totals(wide_services(store.services_store(spark, SMALL), ["arrival_lateness", "cancellation_id"])).collect() == first


def test_the_places_of_many_keys_are_not_broadcast(spark, tmp_path):
    limit = "spark.sql.maxBroadcastTableSize"
    table = PartedTable(spark, f"{tmp_path}", "versions", ["version"], 1 << 20)
    table.append(keys(spark, 0, 1 << 17))
    before = spark.conf.get(limit)
    try:
        spark.conf.set(limit, "16m")  # the places would take more
        assert table.holding(keys(spark, 1 << 16, 3 << 16)) == [0]
        assert table.holding(keys(spark, 9 << 16, (9 << 16) + 9)) == []
    finally:
        spark.conf.set(limit, before)
