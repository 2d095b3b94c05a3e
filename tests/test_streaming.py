"""Replay safety and alerts of the incident stream."""

import json

import pytest

from signalbox.streaming.incidents import IncidentBatchWriter, read_outbox, run_incident_stream

from .test_incidents import message


@pytest.fixture
def operators(spark, tmp_path):
    ops = spark.createDataFrame([(1, "GW", "Great Western", 80.0)],
                                "operator_id long, operator_code string, operator_name string, "
                                "customer_satisfaction double")
    ops.write.parquet(f"{tmp_path}/operator")
    return f"{tmp_path}/operator"


def writer_of(tmp_path, operators, run="r1"):
    (tmp_path / run).mkdir()
    (tmp_path / run / "metadata").write_text(json.dumps({"id": run}))
    return IncidentBatchWriter(f"{tmp_path}/tables", operators, f"{tmp_path}/{run}")


def batch_of(spark, *messages):
    return spark.createDataFrame([(str(i), m) for i, m in enumerate(messages)], "message_key string, value string")


def test_replayed_epoch_changes_nothing(spark, tmp_path, operators):
    writer = writer_of(tmp_path, operators)
    batch = batch_of(spark, message("V1"), message("V2", routes=None), "<broken")

    def snapshot():
        read = lambda n: spark.read.parquet(f"{tmp_path}/tables/{n}")
        return {n: sorted(map(str, read(n).collect()))
                for n in ["incident", "route_affected", "incident_route_link",
                          "incident_operator_link", "outbox", "quarantine"]}

    writer(batch, 0)
    first = snapshot()
    writer(batch, 0)          # the same epoch replayed after a failure
    assert snapshot() == first
    writer(batch, 1)          # redelivered in a later epoch: stored once, no new alert
    later = snapshot()
    assert later["incident"] == first["incident"] and later["outbox"] == first["outbox"]
    assert len(first["outbox"]) == 1 and len(first["quarantine"]) == 2
    assert len(first["incident_route_link"]) == 2 and len(first["incident_operator_link"]) == 1


def test_one_alert_for_a_version_that_comes_twice_in_a_batch(spark, tmp_path, operators):
    early = message("V1").replace("Line closed", "First").replace("2023-09-10T10:15", "2023-09-10T09:15")
    writer_of(tmp_path, operators)(batch_of(spark, message("V1"), early, message("V1")), 0)
    stored = spark.read.parquet(f"{tmp_path}/tables/incident").collect()
    alerts = read_outbox(spark, f"{tmp_path}/tables/outbox").collect()
    assert [r["summary"] for r in stored] == ["First"] and len(alerts) == 1 and "Summary: First" in alerts[0]["message"]


def test_a_new_checkpoint_keeps_the_epochs_before(spark, tmp_path, operators):
    writer_of(tmp_path, operators, "r1")(batch_of(spark, message("V1"), "<broken"), 0)
    writer_of(tmp_path, operators, "r2")(batch_of(spark, message("V9"), "<broken too"), 0)
    assert {r["version"] for r in read_outbox(spark, f"{tmp_path}/tables/outbox").collect()} == {"V1", "V9"}
    assert spark.read.parquet(f"{tmp_path}/tables/quarantine").count() == 2


def test_every_message_is_stored_rejected_or_quarantined(spark, tmp_path, operators):
    nameless = message("V7").replace("<ns3:Version>V7</ns3:Version>", "")
    sent = [message("V1"), message("V2", routes=None), message("V3", priority=None), nameless, "<broken", message("V1")]
    (tmp_path / "landing").mkdir()
    (tmp_path / "landing" / "a.txt").write_text("\n".join(sent))
    for _ in range(2):  # the second start resumes and finds nothing new
        run_incident_stream(spark, f"{tmp_path}/landing", f"{tmp_path}/tables", operators, f"{tmp_path}/checkpoint")
    stored = spark.read.parquet(f"{tmp_path}/tables/incident").count()
    rejects = spark.read.parquet(f"{tmp_path}/tables/rejects").where("table_name = 'incident'").collect()
    quarantine = spark.read.parquet(f"{tmp_path}/tables/quarantine").count()
    assert (stored, sorted(r["reject_reason"] for r in rejects), quarantine) == \
        (1, ["missing: incident_version", "missing: priority_id"], 2)
    assert read_outbox(spark, f"{tmp_path}/tables/outbox").count() == 1


def test_dedupe_redelivers_every_message_in_a_later_epoch(spark, monkeypatch):
    from signalbox.plans import stream_queries as SQ
    steps = []
    monkeypatch.setattr(SQ, "_base", lambda spark: "base")
    monkeypatch.setattr(SQ, "_operators", lambda *a: "operators")
    monkeypatch.setattr(SQ, "_deliver", lambda spark, sf_dir, landing, where=None: steps.append("all" if where is None else "part"))
    monkeypatch.setattr(SQ, "run_incident_stream", lambda *a: steps.append("run"))
    with pytest.raises(Exception):
        SQ.stream_dedupe(spark, "none").count()   # nothing is written
    assert steps == ["all", "all", "run", "all", "run"]
