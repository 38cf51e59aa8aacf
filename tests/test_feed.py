from __future__ import annotations

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from railcadence import schema as S
from railcadence.operators.reshape import pivot_calls
from railcadence.operators.trips import trip_summary, trips_of
from railcadence.sources import feed
from railcadence.sources.stops import read_station_master, read_stops

OBSERVED = "2026-04-15 07:55:00"


def call(stop, planned=None, real=None):
    c = {"StopPointRef": {"value": f"STIF:StopArea:SP:{stop}:"}}
    if planned:
        c["AimedDepartureTime"] = f"2026-04-15T{planned}"
    if real:
        c["ExpectedDepartureTime"] = f"2026-04-15T{real}"
    return c


def journey(name, destination=None, calls=()):
    j = {"EstimatedCalls": {"EstimatedCall": list(calls)}}
    j["VehicleJourneyName"] = [{"value": name}] if name else []
    if destination:
        j["DestinationName"] = [{"value": destination}]
    return j


def payload(*journeys, second=()):
    def delivery(js):
        return {"EstimatedJourneyVersionFrame": [{"EstimatedVehicleJourney": list(js)}]}

    return json.dumps({"Siri": {"ServiceDelivery": {"EstimatedTimetableDelivery": [delivery(journeys), delivery(second)]}}})


BASIC = payload(
    journey("KALI72", "Saint-Rémy-lès-Chevreuse", [
        call(100, "08:00:00+02:00", "08:04:00+02:00"), call(200, "08:10:00+02:00", "08:15:00+02:00")]),
    journey("BIPA84", "Mitry-Claye", [call(100, "08:20:00+02:00", "08:21:00+02:00")]),
)


def parse(spark, stops, *texts, **kw):
    df = spark.createDataFrame([(t,) for t in texts], "payload string")
    return feed.parse_siri(df, stops, observed_at=OBSERVED, **kw)


def paris(text):
    return dt.datetime.fromisoformat(text).astimezone(dt.timezone.utc)


def test_two_missions(spark, stops):
    out = parse(spark, stops, BASIC)
    assert out.dtypes == [(f.name, f.dataType.simpleString()) for f in S.PASSAGES.fields]
    got = {(r["kind"], r["mission"], r["stop_key"]): r for r in out.select("*", F.unix_timestamp("t").alias("s")).collect()}
    assert len(got) == 6
    first = got["planned", "KALI72", "gare_a"]
    assert first["s"] == int(paris("2026-04-15T08:00:00+02:00").timestamp())
    assert (first["mission_type"], first["direction"], first["destination"]) == ("KALI", "Sud", "Saint-Rémy-lès-Chevreuse")
    assert (first["origin"], first["n_served"], first["stop_id"], first["stop_seq"]) == ("gare_a", 2, 100, 0)
    assert got["real", "KALI72", "gare_b"]["s"] == int(paris("2026-04-15T08:15:00+02:00").timestamp())
    assert got["planned", "BIPA84", "gare_a"]["n_served"] == 1
    assert str(first["service_date"]) == "2026-04-15"


def test_one_time_field_only(spark, stops):
    out = parse(spark, stops, BASIC, time_field="AimedDepartureTime")
    assert {r["kind"] for r in out.collect()} == {"planned"}
    with pytest.raises(ValueError):
        parse(spark, stops, BASIC, time_field="ArrivalTime")


def test_unnamed_journeys_go_and_empty_ones_stay(spark, stops):
    out = parse(spark, stops, payload(
        journey(None, "x", [call(100, "08:00:00Z")]), journey("EMPT01"), journey("ELYS66", None, [call(100, None, "08:00:00Z")]),
    ))
    got = {(r["mission"], r["kind"]): r for r in out.collect()}
    assert set(got) == {("EMPT01", "planned"), ("EMPT01", "real"), ("ELYS66", "planned"), ("ELYS66", "real")}
    empty = got["ELYS66", "planned"]
    assert (empty["stop_key"], empty["t"], empty["origin"], empty["n_served"], empty["ends_at"]) == (None, None, None, 0, None)
    assert empty["destination"] == "" and empty["direction"] == "Nord"
    assert got["ELYS66", "real"]["n_served"] == 1


def test_last_call_of_a_repeated_stop_wins_and_unknown_stops_go(spark, stops):
    out = parse(spark, stops, payload(journey("KALI72", "x", [
        call(200, "08:30:00Z"), call(100, "08:00:00Z"), call(999, "07:00:00Z"), call(200, "08:10:00Z"),
        {"StopPointRef": {"value": "nonsense"}, "AimedDepartureTime": "2026-04-15T06:00:00Z"},
    ])), time_field="AimedDepartureTime")
    got = {r["stop_key"]: r for r in out.select("*", F.date_format("t", "HH:mm").alias("hm")).collect()}
    assert {k: r["hm"] for k, r in got.items()} == {"gare_a": "10:00", "gare_b": "10:10"}
    assert got["gare_a"]["n_served"] == 2 and got["gare_a"]["origin"] == "gare_a"


def test_origin_ties_go_to_the_first_stop(spark, stops):
    out = parse(spark, stops, payload(journey("KALI72", "x", [call(300, "08:00:00Z"), call(200, "08:00:00Z")])), time_field="AimedDepartureTime")
    assert {r["origin"] for r in out.collect()} == {"gare_b"}


def test_only_the_first_delivery_counts_and_missing_parts_give_no_rows(spark, stops):
    out = parse(spark, stops, payload(journey("AAAA01"), second=[journey("BBBB02")]), "{}", '{"Siri": {}}', "not json")
    assert {r["mission"] for r in out.collect()} == {"AAAA01"}


def test_bad_times_and_null_calls_do_not_fail(spark, stops):
    bad = {"Siri": {"ServiceDelivery": {"EstimatedTimetableDelivery": [{"EstimatedJourneyVersionFrame": [
        {"EstimatedVehicleJourney": [{"VehicleJourneyName": [{"value": "KALI72"}]}]}]}]}}}
    broken = payload(journey("BIPA84", "x", [call(100, "soon")]))
    out = parse(spark, stops, json.dumps(bad), broken, time_field="AimedDepartureTime")
    assert sorted((r["mission"], r["n_served"], r["t"]) for r in out.collect()) == [("BIPA84", 0, None), ("KALI72", 0, None)]


def test_trips_and_wide_frame(spark, stops, rows):
    out = parse(spark, stops, BASIC, time_field="AimedDepartureTime")
    assert rows(trips_of(out).select("mission", "origin", "n_served")) == [("BIPA84", "gare_a", 1), ("KALI72", "gare_a", 2)]
    assert rows(trip_summary(out, ["mission"]).select("mission", "origin", "n_served")) == [("BIPA84", "gare_a", 1), ("KALI72", "gare_a", 2)]
    wide = pivot_calls(out, ["mission"], "stop_key", ["gare_a", "gare_b", "gare_c"])
    assert wide.columns == ["mission", "gare_a", "gare_b", "gare_c"]
    got = {r["mission"]: r for r in wide.collect()}
    assert got["KALI72"]["gare_b"] is not None and got["BIPA84"]["gare_b"] is None and got["KALI72"]["gare_c"] is None


def test_repeated_and_unreadable_stop_ids(spark, stops):
    more = spark.createDataFrame(
        [(3, 200, "gare_n", "gare_n"), (4, None, "gare_x", "gare_x"), (5, None, "gare_y", "gare_y")], stops.schema
    )
    got = parse(spark, stops.union(more), BASIC).where("mission = 'KALI72' and kind = 'real'").collect()
    assert sorted((r["stop_key"], r["stop_seq"]) for r in got) == [("gare_a", 0), ("gare_n", 3)]


def test_parsing_does_not_shuffle(spark, stops):
    plan = parse(spark, stops, BASIC)._jdf.queryExecution().executedPlan().toString()
    # the only exchange gathers the stop list into one value
    assert plan.count("Exchange") == 1 and "Exchange SinglePartition" in plan


def test_payload_files(spark, stops, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(json.loads(BASIC), indent=2))
    os.utime(tmp_path / "a.json", (1776232500, 1776232500))
    out = feed.parse_siri(feed.read_payloads(spark, str(tmp_path)), stops)
    assert out.count() == 6
    assert {r[0] for r in out.select(F.unix_timestamp("observed_at")).collect()} == {1776232500}


def test_stop_list_keeps_the_file_order(spark, tmp_path):
    names = ["Robinson", "Saint-Rémy-lès-Chevreuse", "Aéroport CDG 1 (RER)", "Laplace", "Antony"]
    lines = ["geo_point_2d,id_ref_zda,nom_zda"] + [f'"48.{i}, 2.{i}",{900 - i},{n}' for i, n in enumerate(names)]
    path = tmp_path / "stops.csv"
    path.write_text("﻿" + "\n".join(lines) + "\n", encoding="utf-8")
    got = read_stops(spark, str(path)).orderBy("stop_seq").collect()
    assert [(r["stop_seq"], r["stop_id"], r["stop_name"]) for r in got] == [(i, 900 - i, n) for i, n in enumerate(names)]
    assert got[2]["stop_key"] == "aeroport_cdg_1" and (got[3]["lat"], got[3]["lon"]) == (48.3, 2.3)


def test_station_master(spark, tmp_path):
    path = tmp_path / "master.csv"
    path.write_text('geo;shape;name\n48.1, 2.1;"{""type"": ""Point""}";Gentilly\n', encoding="utf-8")
    assert [tuple(r) for r in read_station_master(spark, str(path)).collect()] == [("48.1, 2.1", '{"type": "Point"}', "Gentilly")]


def odd_payloads():
    """Journeys, calls and frames that aren't what they should be, one oddity a payload."""
    good = journey("KALI72", "x", [call(100, "08:00:00+02:00", "08:04:00+02:00")])
    twice = journey("BIPA84", None, [call(100, "08:20:00+02:00"), call(200, "08:30:00+02:00", "08:31:00+02:00")])
    odd_calls = [None, 5, 1.50, True, "text", "", [], {}, [good["EstimatedCalls"]], {"EstimatedCall": None},
                 {"EstimatedCall": "text"}, {"EstimatedCall": [3, *twice["EstimatedCalls"]["EstimatedCall"]]},
                 {"EstimatedCall": [None, {"StopPointRef": 7, "AimedDepartureTime": "2026-04-15T08:00:00Z"}]},
                 {"EstimatedCall": [{"StopPointRef": {"value": 'a:100:', "x": [1.0e400, "\u2028\ud83d"]}, "AimedDepartureTime": 2026}]},
                 {"EstimatedCall": [{"StopPointRef": {"value": 'é"\\:100:'}, "AimedDepartureTime": "2026-04-15T08:00:00Z"}]}]
    odd = [{**good, "EstimatedCalls": c} for c in odd_calls]
    odd += [None, 5, "text", "{}", [], [good], {}, journey("", "x"), {**good, "VehicleJourneyName": "text"}, {**good, "VehicleJourneyName": {"value": "x"}},
            {**good, "VehicleJourneyName": [None]}, {**good, "VehicleJourneyName": [{"value": "\ud83d\ude00\ud83d"}], "DestinationName": 3}]
    out = [payload(good, o, twice) for o in odd]
    for frames in (None, [], {}, [None], [{}], [{"EstimatedVehicleJourney": None}, {"EstimatedVehicleJourney": [good]}],
                   [5, {"EstimatedVehicleJourney": [good]}], [{"EstimatedVehicleJourney": [good]}, {"EstimatedVehicleJourney": [twice, good]}]):
        out.append(json.dumps({"Siri": {"ServiceDelivery": {"EstimatedTimetableDelivery": [{"EstimatedJourneyVersionFrame": frames}]}}}))
    whole = payload(good, twice)
    return out + [whole, whole[:-9], whole[:200], whole + "}", whole + whole, "", "null", "[]", f"[{whole}]", whole.replace("KALI", "KA\\tLI")]


def test_spread_journeys_are_the_same(spark, stops, rows):
    texts = odd_payloads()
    payloads = spark.createDataFrame(
        [(t, dt.datetime(2026, 4, 15) + dt.timedelta(hours=i)) for i, t in enumerate(texts)], "payload string, landed_at timestamp"
    )
    want = rows(feed.parse_siri(payloads, stops))
    assert rows(feed.parse_siri(payloads, stops, spread=True)) == want and len(want) > 2 * len(texts)
