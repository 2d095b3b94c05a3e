"""Keyed version state, dead letters, archived files, packed epochs."""

import os
import time

import pytest
from pyspark.sql import functions as F

from signalbox.session import children, remove, rename, run_root, scratch
from signalbox.sources.xml_docs import pack_message, parse_incidents, read_message, unpack_messages
from signalbox.streaming.incidents import (IncidentBatchWriter, open_letters, read_outbox, redrive,
                                           run_incident_stream)
from signalbox.streaming.packing import pack, read_table

from .test_incidents import message
from .test_streaming import batch_of, operators, writer_of  # noqa: F401 - a fixture


def deliver(tmp_path, name, *messages):
    (tmp_path / "landing").mkdir(exist_ok=True)
    (tmp_path / "landing" / name).write_text("\n".join(messages))


def run(spark, tmp_path, ops, **kw):
    return run_incident_stream(spark, f"{tmp_path}/landing", f"{tmp_path}/tables", ops, f"{tmp_path}/checkpoint", **kw)


def versions(spark, tmp_path):
    return sorted(r.incident_version for r in read_table(spark, f"{tmp_path}/tables", "incident").collect())


def test_state_knows_versions_after_a_restart(spark, tmp_path, operators):  # noqa: F811
    deliver(tmp_path, "a.txt", message("V1"), message("V3", priority=None), "<broken")
    run(spark, tmp_path, operators)
    # what was stored is hidden: only the state can know V1
    os.rename(f"{tmp_path}/tables/incident", f"{tmp_path}/tables/hidden")
    deliver(tmp_path, "b.txt", message("V1"), message("V2"), message("V3"))
    run(spark, tmp_path, operators)
    assert versions(spark, tmp_path) == ["V2", "V3"]     # V3 was no incident before
    assert sorted(r.incident_id for r in read_table(spark, f"{tmp_path}/tables", "incident").collect()) == [2, 3]
    assert {r.version for r in read_outbox(spark, f"{tmp_path}/tables/outbox").collect()} == {"V1", "V2", "V3"}


def test_an_epoch_reads_no_incident_of_its_own_run(spark, tmp_path, operators, monkeypatch):  # noqa: F811
    """The plan of a later epoch has no file of an earlier epoch's incidents."""
    deliver(tmp_path, "a.txt", *[message(f"A{i}") for i in range(30)])
    run(spark, tmp_path, operators)
    writer = IncidentBatchWriter(f"{tmp_path}/tables", operators, f"{tmp_path}/checkpoint", suppressed=True)
    writer._run_id(spark)
    writer._epoch = 7
    assert writer._stored(spark, "incident").inputFiles() == [] or writer._stored(spark, "incident").count() == 0
    plan = writer._stored(spark, "incident")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(loaded_run" in plan or "LocalTableScan <empty>" in plan


def test_working_folders_of_an_epoch_are_gone(spark, tmp_path, operators):  # noqa: F811
    before = set(children(spark, run_root(spark)))
    writer_of(tmp_path, operators)(batch_of(spark, message("V1"), message("V1"), "<broken"), 0)
    assert set(children(spark, run_root(spark))) == before


def test_redrive_stores_and_alerts_once(spark, tmp_path, operators):  # noqa: F811
    root = f"{tmp_path}/tables"
    bad = message("V5").replace("</ns3:PtIncident>", "")
    deliver(tmp_path, "a.txt", message("V1"), bad, "<hopeless", message("V6", routes=None))
    run(spark, tmp_path, operators)
    letters = {r.value: (r.reason, r.attempt) for r in open_letters(spark, root).collect()}
    assert letters[bad] == ("malformed", 1) and len(letters) == 3
    closed = lambda v: F.when(v.endswith("</ns3:Affects><ns3:IncidentPriority>2</ns3:IncidentPriority>"), F.concat(
        v, F.lit("</ns3:PtIncident>"))).otherwise(v)
    assert redrive(spark, root, operators, closed)
    assert versions(spark, tmp_path) == ["V1", "V5"]
    left = {r.value: r.attempt for r in open_letters(spark, root).collect()}
    assert left == {"<hopeless": 2, message("V6", routes=None): 2}
    # the same pass again, as if it had broken off before it was settled
    remove(spark, f"{root}/redrive/settled/pass=0")
    assert redrive(spark, root, operators, closed)
    assert {r.value: r.attempt for r in open_letters(spark, root).collect()} == left
    assert versions(spark, tmp_path) == ["V1", "V5"]
    assert sorted(r.version for r in read_outbox(spark, f"{root}/outbox").collect()) == ["V1", "V5"]
    # the stream goes on: new ids after all, and V5 is known though another run stored it
    deliver(tmp_path, "b.txt", message("V5"), message("V9"))
    run(spark, tmp_path, operators)
    rows = read_table(spark, root, "incident").collect()
    assert sorted(r.incident_version for r in rows) == ["V1", "V5", "V9"] and len({r.incident_id for r in rows}) == 3


def test_landing_folder_is_emptied_into_the_archive(spark, tmp_path, operators):  # noqa: F811
    for i in range(3):
        deliver(tmp_path, f"{i}.txt", message(f"V{i}"))
    run(spark, tmp_path, operators, archive=f"{tmp_path}/archive", max_files_per_trigger=1)
    kept = [f for _, _, names in os.walk(f"{tmp_path}/archive") for f in names if f.endswith(".txt")]
    deadline = time.time() + 20
    while os.listdir(f"{tmp_path}/landing") and time.time() < deadline:   # the source's own cleaner is a thread
        time.sleep(0.5)
    kept = [f for _, _, names in os.walk(f"{tmp_path}/archive") for f in names if f.endswith(".txt")]
    assert [n for n in os.listdir(f"{tmp_path}/landing") if not n.startswith(".")] == [] and sorted(kept) == ["0.txt", "1.txt", "2.txt"]
    run(spark, tmp_path, operators, archive=f"{tmp_path}/archive")        # nothing is read twice
    deliver(tmp_path, "3.txt", message("V3"))
    run(spark, tmp_path, operators, archive=f"{tmp_path}/archive", max_bytes_per_trigger=1 << 20)
    assert versions(spark, tmp_path) == ["V0", "V1", "V2", "V3"]


def parts(folder):
    return [f for _, _, names in os.walk(folder) for f in names if f.startswith("part-")]


def test_packed_epochs_read_as_before(spark, tmp_path, operators):  # noqa: F811
    root = f"{tmp_path}/tables"
    rows = [(i, f"V{i}", f"2023-{1 + i % 2:02d}-05 10:00:00", "r1", i // 2) for i in range(24)]
    table = spark.createDataFrame(rows, "incident_id long, incident_version string, t string, loaded_run string, loaded_epoch long")
    table = table.withColumn("creation_time", F.col("t").cast("timestamp_ntz")).drop("t")
    snapshot = lambda: sorted(map(str, read_table(spark, root, "incident").select(
        "incident_id", "incident_version", "creation_time", "loaded_run", "loaded_epoch").collect()))
    for epoch in range(12):
        (table.where(F.col("loaded_epoch") == epoch).repartition(2).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("loaded_run", "loaded_epoch").parquet(f"{root}/incident"))
        if epoch % 3 == 2:
            before = snapshot()
            reader = read_table(spark, root, "incident")           # planned before the rewrite
            assert pack(spark, root, "incident", month_of="creation_time") > 0
            assert snapshot() == before and reader.count() == len(before)
    assert pack(spark, root, "incident", month_of="creation_time") == 0
    assert len(snapshot()) == 24
    assert len(parts(f"{root}/incident")) <= 2 * 2 and len(parts(f"{root}/_packed/incident")) <= 2 * 4 + 4
    assert {c for c in children(spark, f"{root}/_packed/incident") if c.startswith("generation=")} != set()


def test_scratch_folders_and_rename(spark, tmp_path):
    with scratch(spark, "x") as folder:
        spark.range(3).write.parquet(f"{folder}/t")
    assert not os.path.exists(folder.removeprefix("file:"))
    (tmp_path / "a").mkdir()
    (tmp_path / "b").mkdir()
    assert not rename(spark, f"{tmp_path}/a", f"{tmp_path}/b") and (tmp_path / "a").exists()
    assert rename(spark, f"{tmp_path}/a", f"{tmp_path}/c") and not (tmp_path / "a").exists()


NS3, NS2 = "http://nationalrail.co.uk/xml/incident", "http://nationalrail.co.uk/xml/common"


@pytest.mark.parametrize("text, version, start", [
    # an earlier descendant wins, wherever it is
    ("<i:Other><i:Version>A</i:Version></i:Other><i:Version>B</i:Version>", "A", None),
    # an element of the same name in another namespace does not count
    ("<o:Version xmlns:o='urn:o'>X</o:Version><i:Version>B</i:Version>", "B", None),
    ("<i:StartTime>no</i:StartTime><c:StartTime>yes</c:StartTime>", None, "yes"),
    # the first counts even when it is empty; text ends at the first child
    ("<i:Version/><i:Version>B</i:Version>", None, None),
    ("<i:Version>A<i:b>x</i:b>y</i:Version>", "A", None),
    ("<i:Version><![CDATA[<A>]]>&amp;</i:Version>", "<A>&", None),
])
def test_first_descendant_by_order_and_namespace(text, version, start):
    values, _ = read_message(f"<i:PtIncident xmlns:i='{NS3}' xmlns:c='{NS2}'>{text}</i:PtIncident>")
    assert (values[2], values[4]) == (version, start)


def test_operators_of_a_message():
    op = "<i:AffectedOperator>{}</i:AffectedOperator>".format
    body = op("<i:OperatorRef>A</i:OperatorRef><i:OperatorName>a</i:OperatorName>") + "<i:x>" + op("<i:OperatorName>b</i:OperatorName>") + "</i:x>" + op("")
    assert read_message(f"<i:P xmlns:i='{NS3}'>{body}</i:P>")[1] == [["A", "a"], [None, "b"], [None, None]]
    for bad in (None, "", "<a>", "<a></b>", "<x:a/>", "text"):
        assert read_message(bad) is None


def test_state_is_kept_by_bucket(spark, tmp_path, operators, monkeypatch):  # noqa: F811
    """A call and a state row a bucket, not a version: a stream of many versions ended by time before."""
    from signalbox.streaming import versions as V
    monkeypatch.setattr(V, "BUCKETS", 3)
    early = message("V5").replace("Line closed", "First").replace("2023-09-10T10:15", "2023-09-10T09:15")
    deliver(tmp_path, "a.txt", *[message(f"V{i}") for i in range(20)], early, "<broken", "<broken")
    run(spark, tmp_path, operators)
    state = spark.read.format("statestore").load(f"{tmp_path}/checkpoint")
    assert state.count() == 3
    late = message("V5").replace("Line closed", "Late").replace("2023-09-10T10:15", "2023-09-10T08:15")
    deliver(tmp_path, "b.txt", late, *[message(f"V{i}") for i in range(10, 30)], "<broken")
    run(spark, tmp_path, operators)
    rows = read_table(spark, f"{tmp_path}/tables", "incident").collect()
    assert sorted(r.incident_version for r in rows) == sorted(f"V{i}" for i in range(30))
    assert [r.summary for r in rows if r.incident_version == "V5"] == ["First"]
    assert spark.read.parquet(f"{tmp_path}/tables/quarantine").count() == 3


def test_packed_messages_unpack_as_they_were_parsed(spark):
    body = ("<i:PtIncident xmlns:i='%s' xmlns:c='%s'><i:Version>a\"\\&#9;&#233;</i:Version><i:Summary/>"
            "<i:AffectedOperator><i:OperatorRef>A</i:OperatorRef></i:AffectedOperator><i:AffectedOperator/></i:PtIncident>" % (NS3, NS2))
    rows = parse_incidents(spark.createDataFrame([("1", body), ("2", "<broken"), ("3", ""), ("4", None)], "message_key string, value string"))
    packed = rows.select("message_key", pack_message().alias("parsed"))
    assert sorted(unpack_messages(packed).collect()) == sorted(rows.select("message_key", "msg").collect())


def test_a_message_of_the_stream_is_parsed_once(spark, tmp_path, operators, monkeypatch):  # noqa: F811
    from signalbox.streaming import incidents as S

    def again(*_):
        raise AssertionError("parsed again")
    monkeypatch.setattr(S, "parse_incidents", again)
    (tmp_path / "landing").mkdir()
    (tmp_path / "landing" / "a.txt").write_text("<broken\n")
    S.run_incident_stream(spark, f"{tmp_path}/landing", f"{tmp_path}/tables", operators, f"{tmp_path}/ck", state_partitions=2)
    assert [(r.reason, r.value) for r in spark.read.parquet(f"{tmp_path}/tables/quarantine").collect()] == [("malformed", "<broken")]


def test_only_quarantined_messages_carry_their_text_to_the_state(spark):
    from signalbox.streaming.versions import _keyed
    sent = {"good": message("V1"), "no routes": message("V2", routes=None), "no priority": message("V3", priority=None), "broken": "<broken"}
    rows = {r.message_key: r for r in _keyed(spark.createDataFrame(list(sent.items()), "message_key string, value string")).collect()}
    assert {k: r.value for k, r in rows.items()} == {"good": None, "no priority": None, "no routes": sent["no routes"], "broken": "<broken"}
    assert [k for k, r in rows.items() if r.digest is not None] == ["good"]


def test_landed_files_are_compressed_and_bounded(spark, tmp_path, monkeypatch):
    from signalbox.plans import stream_queries as Q
    small = "/root/testdata/sf0.001"
    monkeypatch.setattr(Q, "FILE_MESSAGES", 400, raising=False)
    Q._deliver(spark, small, f"{tmp_path}/landing")
    files = parts(f"{tmp_path}/landing")
    assert all(f.endswith(".gz") for f in files) and all(spark.read.text(f"{tmp_path}/landing/{f}").count() <= 400 for f in files)
    landed = spark.read.text(f"{tmp_path}/landing")
    sent = Q.capture(spark, small, "incident_messages").select("value")
    assert landed.count() == sent.count() and landed.exceptAll(sent).isEmpty()
