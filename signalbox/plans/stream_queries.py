"""Registered streaming queries (T01-T05): messages rendered from the tables
land as files, an available-now stream processes them, results are read
back from the written tables and compared with the batch answer."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..session import compiled, run_root
from ..sources.xml_docs import parse_incidents
from ..streaming.incidents import incident_stream, read_outbox, run_incident_stream
from . import incident_queries as IQ
from .captures import capture

RESTART_CUTOFF = "1998-01-01"
#: Messages of a landed file: compressed text is read whole by one task.
FILE_MESSAGES = 100_000


def _base(spark) -> str:
    return f"{run_root(spark)}/stream-{uuid.uuid4().hex}"


def _deliver(spark, sf_dir, landing: str, where=None) -> None:
    """Write the messages (optionally a slice) as new compressed files in the landing folder."""
    msgs = capture(spark, sf_dir, "incident_messages")
    if where is not None:
        msgs = msgs.where(where)
    with compiled(spark):
        msgs.select("value").write.mode("append").options(compression="gzip", maxRecordsPerFile=FILE_MESSAGES).text(landing)


def _operators(spark, sf_dir, base: str) -> str:
    path = f"{base}/operator"
    IQ._operators(spark, sf_dir).write.parquet(path)
    return path


def _run(spark, sf_dir, deliveries=1, restart=False, again=False) -> str:
    base = _base(spark)
    landing, root, ck = f"{base}/landing", f"{base}/tables", f"{base}/checkpoint"
    ops = _operators(spark, sf_dir, base)
    day = F.to_date(F.regexp_extract("value", r"<ns3:CreationTime>(\d{4}-\d{2}-\d{2})", 1))
    if restart:
        _deliver(spark, sf_dir, landing, day < F.lit(RESTART_CUTOFF))
        run_incident_stream(spark, landing, root, ops, ck)
        _deliver(spark, sf_dir, landing, ~(day < F.lit(RESTART_CUTOFF)))
        run_incident_stream(spark, landing, root, ops, ck)
        return root
    for _ in range(deliveries):
        _deliver(spark, sf_dir, landing)
    run_incident_stream(spark, landing, root, ops, ck)
    if again:
        _deliver(spark, sf_dir, landing)
        run_incident_stream(spark, landing, root, ops, ck)
    return root


INCIDENT_NO_IDS = ["incident_num", "incident_version", "link", "summary", "is_planned",
                   "creation_time", "start_time", "end_time"]


def stream_ingest(spark, sf_dir):
    """Every landed message read once by the stream."""
    base = _base(spark)
    _deliver(spark, sf_dir, f"{base}/landing")
    parsed = parse_incidents(incident_stream(spark, f"{base}/landing"))
    out = parsed.select(F.col("msg._corrupt_record").isNotNull().alias("is_malformed"),
                        F.col("msg.Version").alias("parsed_version"))
    (out.writeStream.format("parquet").option("path", f"{base}/out")
     .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True)
     .start().awaitTermination())
    return spark.read.parquet(f"{base}/out")


def stream_incidents(spark, sf_dir):
    """Incidents stored by the stream."""
    return spark.read.parquet(f"{_run(spark, sf_dir)}/incident").select(*INCIDENT_NO_IDS)


def stream_dedupe(spark, sf_dir):
    """Every message delivered twice, both in one micro-batch,
    and once more in a later epoch; each version is stored once."""
    return spark.read.parquet(f"{_run(spark, sf_dir, deliveries=2, again=True)}/incident").select(*INCIDENT_NO_IDS)


def stream_quarantine(spark, sf_dir):
    """Poison messages per reason."""
    q = spark.read.parquet(f"{_run(spark, sf_dir)}/quarantine")
    return q.groupBy("reason").agg(F.count(F.lit(1)).alias("messages"))


def stream_restart(spark, sf_dir):
    """Stop after the first delivery, resume from the checkpoint after
    the second; the result equals one batch."""
    return spark.read.parquet(f"{_run(spark, sf_dir, restart=True)}/incident").select(*INCIDENT_NO_IDS)


def stream_alerts(spark, sf_dir):
    """Outbox written by the stream, duplicate deliveries included: one alert
    per (stored version, allow-listed operator). A message whose incident is
    rejected (no priority) is not alerted, as its processing stops there."""
    root = _run(spark, sf_dir, deliveries=2)
    return read_outbox(spark, f"{root}/outbox")


QUERIES = {
    "stream_ingest": stream_ingest,
    "stream_incidents": stream_incidents,
    "stream_dedupe": stream_dedupe,
    "stream_quarantine": stream_quarantine,
    "stream_restart": stream_restart,
    "stream_alerts": stream_alerts,
}

_NO_IDS = ", ".join(INCIDENT_NO_IDS)
ORACLE = {
    "stream_ingest": "SELECT malformed AS is_malformed, CASE WHEN NOT malformed THEN given END AS parsed_version FROM ords",
    "stream_incidents": f"SELECT {_NO_IDS} FROM incident",
    "stream_dedupe": f"SELECT {_NO_IDS} FROM incident",
    "stream_quarantine": """SELECT CASE WHEN malformed THEN 'malformed' ELSE 'no routes' END AS reason,
        count(*) AS messages FROM det WHERE malformed OR no_routes GROUP BY 1""",
    "stream_restart": f"SELECT {_NO_IDS} FROM incident",
    "stream_alerts": """SELECT operator_code, version, message FROM alerts
        WHERE version IN (SELECT incident_version FROM incident)""",
}


def oracle_sql() -> dict[str, str]:
    return {k: IQ.INCIDENT_CTE + "\n" + v for k, v in ORACLE.items()}
