"""Nested extraction on hand-written journey / service documents."""

import json

import pytest

from signalbox.operators.extract import relevant_fields
from signalbox.schemas import SERVICE, STATION_SEARCH
from signalbox.sources.json_docs import journeys, parse_json, read_json_docs, split_fetch_errors

DAY = "2021-03-14"
TIMEOUT = "Timeout: The request could not be completed."


def ends(place, at):
    return [{"tiploc": place[:4].upper(), "description": place, "workingTime": at, "publicTime": at[:4]}]


def journey(uid, origin="Harbour", dest="Hilltop"):
    return {"locationDetail": {"crs": "MID", "description": "Midway", "displayAs": "CALL",
                               "origin": ends(origin, "060500"), "destination": ends(dest, "074000")},
            "serviceUid": uid, "runDate": DAY, "atocName": "Coastline", "serviceType": "train"}


def service(uid, calls, company="Coastline"):
    return {"serviceUid": uid, "runDate": DAY, "serviceType": "train", "atocName": company, "locations": calls}


def call(crs, display, late=None, code=None):
    d = {"crs": crs, "description": f"Place {crs}", "displayAs": display}
    if late is not None:
        d["realtimeGbttArrivalLateness"] = late
    if code is not None:
        d["cancelReasonCode"] = code
    return d


def text(doc):
    return doc if isinstance(doc, str) else json.dumps(doc)


def run(spark, svc_docs, journey_docs):
    s = spark.createDataFrame([(text(d),) for d in svc_docs], "value string")
    j = spark.createDataFrame([(text({"location": {"crs": "MID"}, "services": [d]}),) for d in journey_docs], "value string")
    good, errors = split_fetch_errors(parse_json(s, SERVICE), "Service")
    flat, quarantine = relevant_fields(journeys(parse_json(j, STATION_SEARCH)), good)
    return ({r["service_uid"]: r.asDict() for r in flat.collect()},
            {r["service_uid"]: r["reason"] for r in quarantine.collect()},
            [tuple(r) for r in errors.collect()])


def test_service_that_only_has_its_origin(spark):
    flat, _, _ = run(spark, [service("U1", [call("HBR", "ORIGIN")])], [journey("U1")])
    r = flat["U1"]
    assert r["arrival_lateness"] is None
    assert (r["destination_reached_crs"], r["destination_reached_name"]) == ("HBR", "Harbour")
    assert (r["planned_final_crs"], r["planned_final_destination"]) == ("HBR", "Place HBR")
    assert (r["cancellation_station_crs"], r["cancellation_station_name"], r["cancel_code"]) == (None,) * 3
    assert (r["origin_run_time"], r["scheduled_arrival_time"]) == ("060500", "074000")


def test_array_rules(spark):
    docs = [
        service("TWO", [call("HBR", "ORIGIN"), call("QUA", "TERMINATES", 4), call("HIL", "DESTINATION", 9)]),
        service("NOLATE", [call("HBR", "ORIGIN"), call("HIL", "DESTINATION")]),
        service("CXL", [call("HBR", "ORIGIN"), call("QUA", "CANCELLED_CALL"), call("HIL", "CANCELLED_CALL", code="K7")]),
        service("OK", [call("HBR", "ORIGIN"), call("QUA", "CANCELLED_CALL", code="K8")]),
        service("EMPTY", []),
        {"error": TIMEOUT, "Service": "LOST"},
    ]
    flat, quarantine, errors = run(spark, docs, [journey(u) for u in ["TWO", "NOLATE", "CXL", "OK", "EMPTY", "LOST"]])
    assert flat["TWO"]["arrival_lateness"] == 4 and flat["TWO"]["destination_reached_crs"] == "QUA"
    assert flat["TWO"]["destination_reached_name"] == "Hilltop"
    assert flat["NOLATE"]["arrival_lateness"] == 0
    assert flat["CXL"]["cancel_code"] is None and flat["CXL"]["cancellation_station_crs"] is None
    assert (flat["OK"]["cancellation_station_crs"], flat["OK"]["cancel_code"]) == ("QUA", "K8")
    assert quarantine == {"EMPTY": "no locations", "LOST": "no service document"}
    assert errors == [(TIMEOUT, "LOST", None)]


@pytest.mark.parametrize("order", [1, -1])
def test_differing_captures_give_one_answer_in_any_order(spark, order):
    captures = [service("U1", [call("HBR", "ORIGIN"), call("HIL", "DESTINATION", late)]) for late in (9, 4, 6)][::order]
    flat, _, _ = run(spark, captures, [journey("U1")])
    assert len(flat) == 1 and flat["U1"]["arrival_lateness"] == 4


def test_broken_documents_are_errors_and_the_rest_goes_on(spark):
    docs = [service("U1", [call("HBR", "ORIGIN")]), '{"serviceUid": "U2", "runDa', "not json", ""]
    flat, quarantine, errors = run(spark, docs, [journey("U1"), journey("U2")])
    assert set(flat) == {"U1"} and quarantine == {"U2": "no service document"}
    assert {e for e in errors if e[2]} == {("malformed document", None, d) for d in docs[1:3]}


def test_station_errors_and_broken_searches(spark):
    docs = [{"location": {"crs": "MID"}, "services": [journey("U1")]}, {"error": TIMEOUT, "Station": "HIL"}, '{"services": [']
    d = parse_json(spark.createDataFrame([(text(x),) for x in docs], "value string"), STATION_SEARCH)
    good, errors = split_fetch_errors(d, "Station")
    assert good.count() == 1 and journeys(d).count() == 1
    assert {tuple(r) for r in errors.collect()} == {(TIMEOUT, "HIL", None), ("malformed document", None, docs[2])}


def test_documents_over_several_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(service("U1", []), indent=2))
    (tmp_path / "b.json").write_text('{"serviceUid": \n "U2"')
    rows = read_json_docs(spark, str(tmp_path), SERVICE, multi_line=True)
    good, errors = split_fetch_errors(rows, "Service")
    assert [r.doc.serviceUid for r in good.collect()] == ["U1"] and errors.count() == 1
