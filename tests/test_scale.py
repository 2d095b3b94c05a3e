"""Plans that keep their cost in proportion at size."""

from __future__ import annotations

import glob
import time

from pyspark.sql import functions as F

from signalbox.schemas import STATION_SEARCH
from signalbox.plans import batch, incident_queries, registry
from signalbox.session import SPLIT_MB, compiled, materialize, run_root
from signalbox.sources import documents as D
from signalbox.sources import json_docs as J
from signalbox.sources.xml_docs import parse_incidents


class Rows:
    """Stands in for ``Tables`` with rows of the test's own."""

    def __init__(self, spark, **tables):
        self.spark = spark
        for name, (rows, schema) in tables.items():
            setattr(self, name, spark.createDataFrame(rows, schema))


def _tables(spark):
    line = ("l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double, l_discount double, l_tax double,"
            " l_quantity double, l_returnflag string, l_linestatus string")
    return Rows(
        spark,
        lineitem=([(1, 2, 10, 5, 1.0, 0.0, 0.0, 4.0, "N", "O"), (1, 1, 11, 6, 1.0, 0.0, 0.0, 3.0, "R", "F"), (1, 1, 10, 6, 1.0, 0.0, 0.0, 5.0, "A", "F"),
                   (2, 1, 10, None, 1.0, 0.0, 0.0, 1.0, "N", "F"), (3, 1, 99, 5, 1.0, 0.0, 0.0, 1.0, "N", "F"),
                   (None, 1, 10, 5, 1.0, 0.0, 0.0, 1.0, "N", "F"), (4, 1, 99, 5, 1.0, 0.0, 0.0, 1.0, "N", "F"), (4, 2, 12, 77, 1.0, 0.0, 0.0, 1.0, "N", "F")], line),
        part=([(10, "b", "Brand#1", 1), (11, "a", "Brand#2", 50), (12, None, "Brand#3", 1)], "p_partkey long, p_name string, p_brand string, p_size int"),
        supplier=([(5, "S5"), (6, None), (5, "S5")], "s_suppkey long, s_name string"),
        customer=([(7, "M")], "c_custkey long, c_mktsegment string"),
        orders=([(k, 7, "1996-01-01", "O", "1-URGENT") for k in (1, 2, 3, 4)],
                "o_orderkey long, o_custkey long, o_orderdate string, o_orderstatus string, o_orderpriority string"))


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_documents_are_parsed_once(spark):
    docs = spark.createDataFrame([('{"location": {"crs": "C1"}, "services": [{"serviceUid": "u"}]}',), ('{"error": "x", "Station": "C2"}',), ("{bro",)], "value string")
    parsed = J.parse_json(docs, STATION_SEARCH)
    journeys = J.journeys(parsed).select("station_crs", F.col("journey.serviceUid").alias("uid"))
    assert _plan(journeys).count("from_json") == 1
    assert [tuple(r) for r in journeys.collect()] == [("C1", "u")]
    _, errors = J.split_fetch_errors(parsed, "Station")
    assert sorted((r.error, r.Station, r.document) for r in errors.collect() if r.Station) == [("x", "C2", None)]
    assert [(r.error, r.document) for r in errors.collect() if not r.Station] == [("malformed document", "{bro")]


def _before_shuffle(plan: str) -> str:
    """The part of a plan below the shuffle by order."""
    return plan[plan.index("REPARTITION_BY_COL"):]


def test_line_items_go_to_their_order_as_plain_columns(spark):
    t = _tables(spark)
    services = D.order_services(t)
    assert "collect_list" not in _before_shuffle(_plan(services))
    got = {r.uid: [(s.crs, s.displayAs, s.cancelReasonCode) for s in r.locations] for r in services.collect()}
    assert got == {"O1": [("C6", "CALL", None), ("C6", "CANCELLED_CALL", None), ("C5", "TERMINATES", None)],
                   "O2": [(None, "CALL", None)], "O4": [("C77", "CALL", None)]}


def test_an_incident_message_needs_a_known_supplier_and_a_known_part(spark):
    messages = D.incident_messages(_tables(spark))
    plan = _plan(messages)
    assert plan.count("REPARTITION_BY_COL") == 1 and "collect_set" not in _before_shuffle(plan)
    got = {r.message_key: r.value for r in messages.collect()}
    assert sorted(got) == ["1", "4"]  # order 2 has no supplier, order 3 no part
    assert "&lt;p&gt;a / b&lt;/p&gt;" in got["1"] and got["4"].count("<ns3:AffectedOperator>") == 1
    assert "&lt;p&gt;&lt;/p&gt;" in got["4"]  # a part without a name


def test_own_jobs_read_small_splits(spark):
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    try:
        for given, inside in (("128m", f"{SPLIT_MB}m"), ("1m", "1m")):
            spark.conf.set(name, given)
            with compiled(spark):
                assert spark.conf.get(name) == inside
            assert spark.conf.get(name) == given
    finally:
        spark.conf.set(name, before)


def test_calling_points_are_sorted_without_an_interpreted_comparison(spark):
    plan = D.order_services(_tables(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert "sort_array(" in plan and "array_sort(" not in plan


def test_shuffle_files_of_own_jobs_go(spark):
    folders = list(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())
    shuffles = lambda: {f for d in folders for f in glob.glob(f"{d}/*/shuffle_*.data")}
    before = shuffles()
    rows = spark.range(20_000).withColumn("k", F.col("id") % 7919).groupBy("k").agg(F.max("id").alias("most"))
    stored = materialize(rows, "shuffled")
    until = time.time() + 20
    while shuffles() - before and time.time() < until:  # they are deleted beside the next steps
        time.sleep(0.2)
    assert not shuffles() - before
    assert stored.count() == rows.count() == 7919 and rows.where("most > 19999").isEmpty()


def test_csv_of_the_batch_is_compressed_in_bounded_files(spark, monkeypatch):
    monkeypatch.setattr(batch, "CSV_ROWS", 1000, raising=False)
    files = lambda: set(glob.glob(f"{run_root(spark).removeprefix('file:')}/batch-*/csv/part-*"))
    before = files()
    steps = {r.step: r for r in registry._batch_run(spark, "/root/testdata/sf0.001").collect()}
    new = sorted(files() - before)
    rows = [spark.read.option("header", True).csv(f).count() for f in new]
    assert all(f.endswith(".csv.gz") for f in new) and max(rows) == 1000
    assert sum(rows) == steps["extract"].rows_out == steps["clean"].rows_in


def test_texts_that_nobody_reads_do_not_come_back_from_the_parser(spark):
    plan = _plan(incident_queries._flat(spark, "/root/testdata/sf0.001"))
    assert "raw#" not in next(line for line in plan.splitlines() if "MapInArrow" in line).split("]")[0].split("[")[1]
    rows = spark.createDataFrame([("1", "<broken"), ("2", "<a/>"), ("3", None)], "message_key string, value string")
    with_text, without = parse_incidents(rows), parse_incidents(rows, keep_text=False)
    assert without.columns == ["message_key", "msg"]
    assert sorted(without.collect()) == sorted(with_text.drop("raw").collect())
    assert {r.message_key: (r.msg.Operators, r.msg._corrupt_record) for r in without.collect()} == {
        "1": (None, "<broken"), "2": ([], None), "3": (None, "")}
