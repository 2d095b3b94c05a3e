"""Incident messages: parse, flatten, load, alert."""

import datetime as dt

from pyspark.sql import functions as F

from signalbox.operators import incidents as I
from signalbox.sources.xml_docs import parse_incidents

NS = ('xmlns:ns2="http://nationalrail.co.uk/xml/common" '
      'xmlns:ns3="http://nationalrail.co.uk/xml/incident"')


def message(version, routes="&lt;p&gt;A to B / C to D&lt;/p&gt;", end=True, priority="2",
            planned="false"):
    ops = "".join(f"<ns3:AffectedOperator><ns3:OperatorRef>{c}</ns3:OperatorRef>"
                  f"<ns3:OperatorName>{n}</ns3:OperatorName></ns3:AffectedOperator>"
                  for c, n in [("GW", "Great Western"), ("ZZ", "Unknown Op")])
    return (f'<?xml version="1.0"?><ns3:PtIncident {NS}>'
            f"<ns3:CreationTime>2023-09-10T10:15:30.123+01:00</ns3:CreationTime>"
            f"<ns3:IncidentNumber>INC1</ns3:IncidentNumber><ns3:Version>{version}</ns3:Version>"
            f"<ns3:Planned>{planned}</ns3:Planned><ns3:ValidityPeriod>"
            f"<ns2:StartTime>2023-09-10T10:00:00+01:00</ns2:StartTime>"
            + ("<ns2:EndTime>2023-09-10T18:00:00+01:00</ns2:EndTime>" if end else "")
            + "</ns3:ValidityPeriod><ns3:InfoLinks><ns3:InfoLink><ns3:Uri>http://x</ns3:Uri>"
            "</ns3:InfoLink></ns3:InfoLinks><ns3:Summary>Line closed</ns3:Summary>"
            f"<ns3:Affects><ns3:Operators>{ops}</ns3:Operators>"
            + (f"<ns3:RoutesAffected>{routes}</ns3:RoutesAffected>" if routes else "")
            + "</ns3:Affects>"
            + (f"<ns3:IncidentPriority>{priority}</ns3:IncidentPriority>" if priority else "")
            + "</ns3:PtIncident>")


def details(spark, msgs):
    df = spark.createDataFrame([(str(i), m) for i, m in enumerate(msgs)], "message_key string, value string")
    return I.incident_details(parse_incidents(df))


def test_flatten_two_by_two(spark):
    good, bad = I.split_messages(details(spark, [message("V1")]))
    flat = I.flatten_incidents(good).collect()
    assert len(flat) == 4 and bad.count() == 0
    r = flat[0]
    assert r["planned"] is False
    assert r["creation_time"] == dt.datetime(2023, 9, 10, 10, 15, 30)
    assert r["start_time"] == dt.datetime(2023, 9, 10, 10, 0, 0)
    assert {x["route_affected"] for x in flat} == {"A to B", "C to D"}


def test_quarantine_and_rejects(spark):
    d = details(spark, [message("V1"), message("V2", routes=None), "<broken", message("V3", priority=None),
                        message("V1")])
    good, bad = I.split_messages(d)
    assert sorted(r["quarantine_reason"] for r in bad.collect()) == ["malformed", "no routes"]
    flat = I.flatten_incidents(good)
    priority = I.load_priorities(flat)
    incident, rejects = I.load_incidents(flat, priority)
    assert [r["incident_version"] for r in incident.collect()] == ["V1"]
    assert [(r["incident_version"], r["reject_reason"]) for r in rejects.collect()] == \
        [("V3", "missing: priority_id")]


def test_a_message_without_a_version_is_rejected(spark):
    nameless = message("V1").replace("<ns3:Version>V1</ns3:Version>", "")
    good, bad = I.split_messages(details(spark, [message("V2"), nameless, nameless]))
    flat = I.flatten_incidents(good)
    incident, rejects = I.load_incidents(flat, I.load_priorities(flat))
    assert bad.count() == 0 and [r["incident_version"] for r in incident.collect()] == ["V2"]
    assert [(r["incident_version"], r["reject_reason"]) for r in rejects.collect()] == [(None, "missing: incident_version")]


def test_operators_are_loaded_or_rejected(spark):
    info = spark.createDataFrame([("A", "AA", 1.0), ("A", "AB", 2.0), (None, "AC", 3.0), ("B", None, 4.0), ("C", "CC", None)],
                                 "operator_name string, operator_code string, customer_satisfaction double")
    rows, rejects = I.load_operators(info)
    assert [(r["operator_id"], r["operator_name"], r["operator_code"]) for r in rows.orderBy("operator_id").collect()] == \
        [(1, "A", "AA"), (2, "C", "CC")]
    assert sorted(r["reject_reason"] for r in rejects.collect()) == ["missing: operator_code", "missing: operator_name"]


def test_first_descendant_wherever_it_is(spark):
    m = message("V1")
    period = "<ns3:ValidityPeriod><ns2:StartTime>2024-01-01T00:00:00Z</ns2:StartTime></ns3:ValidityPeriod>"
    box = "</ns3:AffectedOperator></ns3:Operators><ns3:Operators><ns3:AffectedOperator>"
    shapes = [m.replace("</ns3:ValidityPeriod>", "</ns3:ValidityPeriod>" + period),
              m.replace("</ns3:AffectedOperator><ns3:AffectedOperator>", box),
              m.replace("<ns3:Affects>", "<ns3:Affects><ns3:Scope>").replace("</ns3:Affects>", "</ns3:Scope></ns3:Affects>"),
              m.replace("<ns3:Summary>", "<ns3:More><ns3:Summary>").replace("</ns3:Summary>", "</ns3:Summary></ns3:More><ns3:Version>V9</ns3:Version>")]
    first, *rest = [r.asDict() for r in details(spark, [m, *shapes]).drop("message_key").collect()]
    assert first["start_time"] == dt.datetime(2023, 9, 10, 10, 0) and len(first["operators_affected"]) == 2
    for other in rest:
        assert other == first


def test_both_ways_of_the_whole_load_add_up(spark):
    d = details(spark, [message("V1"), message("V1"), message("V3", priority=None), message("V5")])
    good, _ = I.split_messages(d)
    ops = spark.createDataFrame([(1, "GW", "Great Western", 80.0)],
                                "operator_id long, operator_code string, operator_name string, customer_satisfaction double")
    rejected = {}
    t = I.load_all_incidents(I.flatten_incidents(good), ops, lambda name: None, lambda name, rows: rows,
                             lambda name, rows: rejected.setdefault(name, rows))
    assert {r["incident_version"] for r in t.incident.collect()} == {"V1", "V5"}
    assert {r["incident_version"] for r in rejected["incident"].collect()} == {"V3"}
    assert t.incident_route_link.count() == 4 and t.incident_operator_link.count() == 2
    assert {r["affected_operator_ref"] for r in rejected["incident_operator_link"].collect()} >= {"ZZ"}


def test_alert_text(spark):
    good, _ = I.split_messages(details(spark, [message("V1"), message("V4", end=False)]))
    alerts = {r["version"]: r["message"] for r in I.alerts(good).collect()}
    assert set(alerts) == {"V1", "V4"}  # ZZ is not on the allow-list
    assert "Great Western incident" in alerts["V1"]
    assert "\n• A to B\n• C to D" in alerts["V1"]
    assert alerts["V1"].endswith("Duration: 2023-09-10 10:00:00 to 2023-09-10 18:00:00")
    assert alerts["V4"].endswith("Start time: 2023-09-10 10:00:00 End time: Unknown")


def test_links_are_distinct(spark):
    good, _ = I.split_messages(details(spark, [message("V1"), message("V1")]))
    flat = I.flatten_incidents(good)
    incident, _ = I.load_incidents(flat, I.load_priorities(flat))
    route = I.load_routes(flat)
    links, _ = I.link_routes(flat, incident, route)
    assert links.count() == 2
    ops = spark.createDataFrame([(1, "GW", "Great Western", 80.0)],
                                "operator_id long, operator_code string, operator_name string, "
                                "customer_satisfaction double")
    olinks, rej = I.link_operators(flat, incident, ops)
    assert olinks.count() == 1 and rej.where(F.col("operator_id").isNull()).count() > 0
