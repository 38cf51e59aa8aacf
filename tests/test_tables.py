"""Tables, whole cycles and streams."""

from __future__ import annotations

import datetime as dt
import json
import os
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from railcadence import session
from railcadence.operators import drift, gaps, headway, regularity
from railcadence.plans import adapters, cycle as C
from railcadence.sinks import tables as T
from railcadence.sources import feed
from railcadence.streaming import feed as live, state

from test_feed import call, journey, payload


@pytest.fixture
def root(spark):
    return session.work_dir(spark, "test")


class FakeSession:
    """Only what the folder lookup reads."""

    def __init__(self, folder, master):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = type("Context", (), {"master": master, "applicationId": "app-1"})


def test_work_dir_follows_the_session():
    shared = FakeSession("hdfs://cluster/work/", "yarn")
    a, b = session.work_dir(shared, "x"), session.work_dir(shared, "x")
    assert a != b and a.startswith("hdfs://cluster/work/railcadence/x-")
    with pytest.raises(ValueError):
        session.work_dir(FakeSession(None, "yarn"), "x")
    local = FakeSession(None, "local[2]")
    assert os.path.isdir(session.shared_root(local)) and session.shared_root(local) == session.shared_root(local)


def test_a_repeated_cycle_replaces_its_rows(spark, root, rows):
    assert T.read_history(spark, root) is None
    df = spark.createDataFrame([("Nord", 1), ("Sud", 2)], "direction string, v int")
    T.append_history(df, root, 1)
    T.append_history(df, root, 2)
    T.append_history(df.limit(1), root, 2)
    got = T.read_history(spark, root)
    assert rows(got.select("direction", "v", "cycle")) == [("Nord", 1, 1), ("Nord", 1, 2), ("Sud", 2, 1)]


def test_a_rerun_with_fewer_days_leaves_no_stale_rows(spark, root, rows):
    df = spark.createDataFrame([("2026-04-17", 1), ("2026-04-18", 2)], "service_date string, v int")
    for cycle in (1, 11):
        T.append_history(df, root, cycle, ["service_date"])
    T.append_history(df.where("v = 2"), root, 1, ["service_date"])
    assert rows(T.read_history(spark, root).select("v", "cycle")) == [(1, 11), (2, 1), (2, 11)]
    T.append_history(df.where("v = 0"), root, 11, ["service_date"])
    assert rows(T.read_history(spark, root).select("v", "cycle")) == [(2, 1)]


def test_rebuild_may_read_what_it_replaces(spark, root, rows):
    assert T.read_current(spark, root) is None
    T.rebuild(spark.createDataFrame([(1,)], "v int"), root, 0)
    for version in (1, 2, 3):
        T.rebuild(T.read_current(spark, root).select((F.col("v") + 1).alias("v")), root, version)
    assert rows(T.read_current(spark, root)) == [(4,)]
    assert rows(T.read_current(spark, root, before=3)) == [(3,)]
    assert T.read_current(spark, root, before=2) is None  # older versions are gone
    # a version without its success mark does not count
    spark.createDataFrame([(9,)], "v int").write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{root}/v00000000000000000009")
    assert rows(T.read_current(spark, root)) == [(4,)]


def test_archive_keeps_the_summaries(spark, root):
    day1, day2 = "2026-04-17", "2026-04-18"
    data = spark.createDataFrame([(day1, "a, \"x\""), (day1, "b"), (day2, "c")], "service_date string, v string").withColumn(
        "service_date", F.col("service_date").cast("date"))
    tables = {n: f"{root}/{n}" for n in ("passages", "hist_moyenne_x", "missions_ref", "absent")}
    T.append_history(data, tables["passages"], 0, ["service_date"])
    T.append_history(data, tables["hist_moyenne_x"], 0, ["service_date"])
    data.drop("service_date").write.parquet(tables["missions_ref"])
    assert T.archive_and_retain(spark, tables, f"{root}/archive", day1) == {"passages": 2, "hist_moyenne_x": 2, "missions_ref": 3}
    assert [r["v"] for r in spark.read.parquet(tables["passages"]).collect()] == ["c"]
    assert spark.read.parquet(tables["hist_moyenne_x"]).count() == 3
    assert not T.exists(spark, tables["missions_ref"])
    back = spark.read.option("header", True).option("escape", '"').csv(f"{root}/archive/passages/service_date={day1}")
    assert sorted(r["v"] for r in back.collect()) == ['a, "x"', "b"]


# ---------------------------------------------------------------------------- a day
DAY = dt.datetime(2026, 4, 15, 8, 0)
KEY = {"gare_a": "a", "gare_b": "b", "gare_c": "c"}
NAMES = ["KALI", "KALI", "PERA", "EMMY", "ELOI", "KALI", "EMMY", "LORE"]


def snapshot(cycle):
    """The feed at one moment: trains every 7 minutes, late by a growing amount."""
    now = DAY + dt.timedelta(minutes=5 * cycle)
    out = []
    for i, name in enumerate(NAMES):
        calls = []
        for j, stop in enumerate((100, 200, 300)[: 3 - (i % 2)] if i != 3 else (300, 200)):
            planned = DAY + dt.timedelta(minutes=7 * i + 6 * j + 2)
            real = planned + dt.timedelta(seconds=(40 * i * cycle) % 400 + 30 * cycle)
            if real < now:
                continue
            c = {"StopPointRef": {"value": f"STIF:StopArea:SP:{stop}:"}, "AimedDepartureTime": planned.isoformat() + "+02:00"}
            if not (i == 6 and cycle == 1):
                c["ExpectedDepartureTime"] = real.isoformat() + "+02:00"
            calls.append(c)
        out.append(journey(f"{name}{i:02d}", "Terminus", calls))
        if i == 2:
            out.append(journey(f"RATP{name}{i:02d}", "Terminus", calls))
    return payload(*out)


def land(folder, cycle):
    path = folder / f"p{cycle}.json"
    path.write_text(snapshot(cycle))
    stamp = int((DAY + dt.timedelta(minutes=5 * cycle) - dt.timedelta(hours=2)).replace(tzinfo=dt.timezone.utc).timestamp())
    os.utime(path, (stamp, stamp))


HISTORIES = ("scores", "gap_stats", "drift_stats", "gap_history")


def test_payloads_of_one_file_are_parsed_by_several_tasks(spark, stops, tmp_path, root, monkeypatch):
    landed = [(snapshot(n % 3), DAY + dt.timedelta(minutes=n)) for n in range(12)]
    spark.createDataFrame(landed, "payload string, landed_at timestamp").coalesce(1).write.parquet(str(tmp_path / "landing"))
    seen = []
    monkeypatch.setattr(C, "load_passages", lambda p, *_: seen.append(p.select(F.spark_partition_id()).distinct().count()))
    monkeypatch.setattr(C, "run_cycles", lambda *_: None)
    source = spark.readStream.schema("payload string, landed_at timestamp").parquet(str(tmp_path / "landing"))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        live.run_feed(spark, source, stops, C.Tables(f"{root}/t"), f"{root}/checkpoint", KEY, {"availableNow": True}).awaitTermination()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert len(seen) == 1 and seen[0] > 1


def test_journeys_of_one_payload_are_parsed_by_several_tasks(spark, stops, tmp_path, root, monkeypatch):
    one = payload(*[journey(f"KALI{i}", "x", [call(100, "08:00:00+02:00", "08:04:00+02:00")]) for i in range(50)])
    spark.createDataFrame([(one, DAY)], "payload string, landed_at timestamp").coalesce(1).write.parquet(str(tmp_path / "landing"))
    seen = []
    monkeypatch.setattr(C, "load_passages", lambda p, *_: seen.append([r["count"] for r in p.groupBy(F.spark_partition_id()).count().collect()]))
    monkeypatch.setattr(C, "run_cycles", lambda *_: None)
    source = spark.readStream.schema("payload string, landed_at timestamp").parquet(str(tmp_path / "landing"))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        live.run_feed(spark, source, stops, C.Tables(f"{root}/t"), f"{root}/checkpoint", KEY, {"availableNow": True}).awaitTermination()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert len(seen) == 1 and sum(seen[0]) == 100 and len(seen[0]) > 1


def test_large_rows_are_written_and_read_one_by_one(spark, tmp_path, rows):
    rng, path = random.Random(3), str(tmp_path / "large")
    sent = [(i, rng.randbytes(1 << 20).hex() if i % 2 else "small") for i in range(12)]
    df = spark.createDataFrame(sent, "part bigint, payload string").coalesce(1)
    T.write_large_rows(df.where("part < 4"), path)
    T.write_large_rows(df.where("part >= 4"), path)
    assert rows(spark.read.parquet(path)) == sorted(sent, key=lambda r: str(r[0]))
    for file in os.listdir(path):
        if file.endswith(".parquet"):
            meta = pq.ParquetFile(f"{path}/{file}").metadata
            groups = [meta.row_group(i) for i in range(meta.num_row_groups)]
            assert max(g.num_rows for g in groups) <= 2
            # whole values as statistics would stay in memory until the file is closed; other columns keep theirs
            assert {(c.path_in_schema, c.statistics is not None and c.statistics.has_min_max) for g in groups for c in (g.column(0), g.column(1))} == {
                ("part", True), ("payload", False)}


def test_payloads_are_built_group_by_group(spark, rows):
    start = dt.datetime(2024, 1, 1, 8)
    events = spark.createDataFrame(
        [(u, ("view", "click", "error")[u % 3], start + dt.timedelta(minutes=u), 0.5 * u) for u in range(300)] + [(None, "view", start, 1.0)],
        "user_id bigint, event_type string, ts timestamp_ntz, value double",
    )
    key = "spark.sql.execution.useObjectHashAggregateExec"
    before = spark.conf.get(key)
    with session.one_group_at_a_time(spark):
        built = adapters.cycle_payloads(events)
        assert "ObjectHashAggregate" not in built._jdf.queryExecution().toString()
        got = {r["landed_at"]: json.loads(r["payload"]) for r in built.collect()}
    assert spark.conf.get(key) == before and len(got) == 2
    for stamp, doc in got.items():
        listed = doc["Siri"]["ServiceDelivery"]["EstimatedTimetableDelivery"][0]["EstimatedJourneyVersionFrame"][0]["EstimatedVehicleJourney"]
        k = {9: 0, 12: 1}[stamp.astimezone(dt.timezone.utc).hour]
        hour = start.replace(hour=(9, 12)[k])
        wanted = {}
        for u in range(300):
            planned = start + dt.timedelta(minutes=u)
            real = planned + dt.timedelta(seconds=0.5 * u * (k + 1))
            if u % 3 <= k and real >= hour:
                stop = adapters.EVENT_STOPS.index(("view", "click", "error")[u % 3]) + 1
                wanted[f"{'SE'[u % 2 == 0]}{u:03d}-{u}-19723"] = [(f"a:{stop}:", planned, real)]
        assert len(listed) == len(wanted) and {
            j["VehicleJourneyName"][0]["value"]: [
                (c["StopPointRef"]["value"], *(dt.datetime.fromisoformat(c[f"{x}DepartureTime"][:-1]) for x in ("Aimed", "Expected")))
                for c in j["EstimatedCalls"]["EstimatedCall"]
            ] for j in listed
        } == wanted


def test_cycles_and_stream_give_the_same_histories(spark, stops, tmp_path, root, rows):
    by_hand = C.Tables(f"{root}/batch")
    landing = tmp_path / "landing"
    landing.mkdir()
    for n in range(3):
        land(landing, n)
        as_of = (DAY + dt.timedelta(minutes=5 * n)).isoformat(sep=" ")
        raw = spark.createDataFrame([(snapshot(n),)], "payload string")
        for _ in range(2 if n == 1 else 1):  # the second cycle runs twice, as after a failure
            C.load_passages(feed.parse_siri(raw, stops, observed_at=as_of), by_hand, as_of, n)
            C.run_cycle(spark, by_hand, "2026-04-15", as_of, n, KEY)
    for size in (1, 3):  # the size of a micro-batch changes nothing
        streamed = C.Tables(f"{root}/stream-{size}")
        source = live.payload_stream(spark, str(landing), max_files=size)
        live.run_feed(
            spark, source, stops, streamed, f"{root}/checkpoint-{size}", KEY, {"availableNow": True}
        ).awaitTermination()
        for name in (*HISTORIES, "passages"):
            a, b = (T.read_history(spark, getattr(t, name)).drop("cycle") for t in (by_hand, streamed))
            assert rows(a) == rows(b), (name, size)
            assert a.count() > 0, name
        assert rows(T.read_current(spark, by_hand.reference)) == rows(T.read_current(spark, streamed.reference))
    passages = T.read_history(spark, by_hand.passages)
    assert passages.where("mission LIKE 'RATP%'").count() == 0

    # the stored rows are those of the operators on the same inputs
    day = passages.where("cycle <= 2")
    want = regularity.widen_scores(regularity.regularity_scores(
        headway.real_headways(day.where("kind = 'real'")), headway.planned_headways(day.where("kind = 'planned'")),
        "2026-04-15 08:10:00"), KEY)
    got = T.read_history(spark, by_hand.scores).where("cycle = 2").select(*want.columns)
    assert rows(got) == rows(want)
    history = T.read_history(spark, by_hand.gap_history)
    assert history.groupBy("mission", "observed_at").count().where("count > 1").count() == 0
    want = drift.drift_stats(drift.mission_drift(history)).select("direction", "mean_drift")
    got = T.read_history(spark, by_hand.drift_stats).where("cycle = 2").select("direction", F.col("moyenne_allongement"))
    assert rows(got) == rows(want)
    got = T.read_history(spark, by_hand.gap_stats).where("cycle = 2")
    want = gaps.gap_stats(history.where("cycle = 2"))
    assert rows(got.select("direction", "ecart_moyen", "ecart_max")) == rows(want.select("direction", "mean_gap", "max_gap"))

    exported = C.archive_day(spark, by_hand, f"{root}/archive", "2026-04-15")
    assert set(exported) == {"passages", "missions_ref", "hist_ecart_horaire", "hist_moyenne_regularite",
                             "hist_moyenne_ecarts", "hist_moyenne_allongement"}
    assert T.read_current(spark, by_hand.reference) is None
    assert T.read_history(spark, by_hand.scores).count() > 0


def test_a_cycle_without_trains_writes_nothing(spark, stops, root):
    tables = C.Tables(root)
    nothing = feed.parse_siri(spark.createDataFrame([(payload(),)], "payload string"), stops, observed_at="2026-04-15 08:00:00")
    C.load_passages(nothing, tables, "2026-04-15 08:00:00", 0)
    C.run_cycle(spark, tables, "2026-04-15", "2026-04-15 08:00:00", 0, KEY)
    # a train that has not left yet is in the reference but not under way
    waiting = feed.parse_siri(spark.createDataFrame([(payload(journey("KALI72", "x", [
        {"StopPointRef": {"value": "a:100:"}, "AimedDepartureTime": "2026-04-15T09:00:00Z"}])),)], "payload string"),
        stops, observed_at="2026-04-15 08:05:00")
    C.load_passages(waiting, tables, "2026-04-15 08:05:00", 1)
    C.run_cycle(spark, tables, "2026-04-15", "2026-04-15 08:05:00", 1, KEY)
    # its real side has no call at all, so only that row counts as fewer stops
    assert T.read_current(spark, tables.reference).count() == 1
    assert T.read_history(spark, tables.drift_stats) is None


def test_snapshot_files_load_once(spark, tmp_path, root):
    tables, head = C.Tables(root), "mission,type_mission,destination,Antony,gare_depart,nb_arrets_desservis,date_observation\n"
    row = "{m},KALI,x,2026-04-15 09:00:00+02:00,Antony,1,2026-04-15 08:00:00+02:00\n"
    landing = tmp_path / "in"
    landing.mkdir()

    def put(name, mtime, *missions, extra=""):
        (landing / name).write_text(head + "".join(row.format(m=m) for m in missions) + extra)
        os.utime(landing / name, (1776000000 + mtime,) * 2)

    def loaded():
        return sorted((r["mission"], r["kind"]) for r in T.read_history(spark, tables.passages).collect())

    as_of = "2026-04-15 08:01:00"
    put("horaires_theoriques_20260415_080000.csv", 1, "OLD001")
    put("horaires_theoriques_20260415_080500.csv", 2, "KALI72", "RATPKALI72", extra="a,b,c,d,e,f,g,h\n")
    put("horaires_reels_20260415_080500.csv", 2, "KALI72")
    rejects = C.load_new_snapshots(spark, str(landing), tables, as_of, 0)
    assert [r["line"] for r in rejects.collect()] == ["a,b,c,d,e,f,g,h"]
    assert loaded() == [("KALI72", "planned"), ("KALI72", "real")]
    for _ in range(2):  # again, and once more after a failure: nothing new
        assert C.load_new_snapshots(spark, str(landing), tables, as_of, 1).count() == 0
    assert len(loaded()) == 2
    put("horaires_reels_20260415_081000.csv", 3, "NEW002")
    C.load_new_snapshots(spark, str(landing), tables, as_of, 2, newest_only=False)
    assert loaded() == [("KALI72", "planned"), ("KALI72", "real"), ("NEW002", "real"), ("OLD001", "planned")]
    ledger = T.read_history(spark, tables.ledger)
    assert {tuple(r) for r in ledger.select("file_name", "n_bad", "n_prefixed", "n_finished", "n_loaded").collect()} == {
        ("horaires_theoriques_20260415_080500.csv", 1, 1, 0, 1), ("horaires_reels_20260415_080500.csv", 0, 0, 0, 1),
        ("horaires_theoriques_20260415_080000.csv", 0, 0, 0, 1), ("horaires_reels_20260415_081000.csv", 0, 0, 0, 1),
    }


def test_streamed_state_over_several_batches_equals_batch(spark, root, tmp_path, rows):
    folder = str(tmp_path / "calls")
    schema = "mission string, direction string, stop_key string, t timestamp, observed_at timestamp"
    moments = [DAY + dt.timedelta(hours=h) for h in (0, 1, 2, 30, 31)]
    data = [(f"M{(i * 7 + k) % 5}", "Nord", f"s{k % 2}", m + dt.timedelta(minutes=(i * 13 + k * 5) % 40), m)
            for i, m in enumerate(moments) for k in range(6)]
    for i, m in enumerate(moments):
        spark.createDataFrame([r for r in data if r[4] == m], schema).coalesce(1).write.mode("append").parquet(folder)
    keys = ["mission", "direction", "stop_key"]
    stream = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    batch = spark.read.schema(schema).parquet(folder)
    for name, build in (("first", state.first_planned), ("last", state.last_real)):
        state.write_updates(build(stream(), keys), f"{root}/{name}", f"{root}/{name}-cp").awaitTermination()
        got = state.current_state(spark, f"{root}/{name}", ["service_day", *keys])
        want = build(batch, keys)
        assert rows(got.select(*want.columns)) == rows(want)
        assert spark.read.parquet(f"{root}/{name}").select("cycle").distinct().count() >= 5


def test_a_closed_day_is_resumed_and_late_rows_are_kept(spark, root, monkeypatch):
    day = "2026-04-17"
    data = spark.createDataFrame([(day, "a\nb"), (day, None), (day, ""), ("2026-04-18", "c")], "service_date string, v string").withColumn(
        "service_date", F.col("service_date").cast("date"))
    tables = {n: f"{root}/{n}" for n in ("passages", "gaps")}
    for path in tables.values():
        T.append_history(data, path, 0, ["service_date"])
    archive, delete = f"{root}/archive", T._delete

    def killed(session, path):
        if path.startswith(tables["passages"]):
            raise KeyboardInterrupt
        delete(session, path)

    monkeypatch.setattr(T, "_delete", killed)
    with pytest.raises(KeyboardInterrupt):  # ends between export and drop
        T.archive_and_retain(spark, tables, archive, day)
    assert all(T.read_history(spark, p).count() == 4 for p in tables.values())
    monkeypatch.setattr(T, "_delete", delete)
    monkeypatch.setattr(T, "_export", lambda *a: pytest.fail("exported twice"))
    assert T.archive_and_retain(spark, tables, archive, day) == {"passages": 3, "gaps": 3}
    monkeypatch.undo()
    assert all(T.read_history(spark, p).count() == 1 for p in tables.values())

    late = data.where("v IS NULL")
    T.append_history(late, tables["gaps"], 1, ["service_date"])
    assert T.archive_and_retain(spark, tables, archive, day) == {"gaps": 1}
    read = spark.read.option("header", True).option("multiLine", True).option("recursiveFileLookup", "true").csv(f"{archive}/gaps")
    assert read.count() == 4  # nothing of the first export is gone

    T.append_history(late, tables["gaps"], 2, ["service_date"])
    sizes = T._size
    monkeypatch.setattr(T, "_size", lambda s, p: [*sizes(s, p), len(T._children(s, f"{archive}/_manifests")) % 2])
    with pytest.raises(RuntimeError, match="changed since"):  # rows that came in between aren't dropped
        T.archive_and_retain(spark, tables, archive, day)
    assert T.read_history(spark, tables["gaps"]).count() == 2


def test_read_files_move_to_the_archive(spark, tmp_path, root):
    landing, archive = tmp_path / "in", tmp_path / "out"
    landing.mkdir()
    for n in range(2):
        land(landing, n)
    for _ in range(2):  # files of a batch are moved when a later batch completes
        q = live.payload_stream(spark, str(landing), str(archive), 1).writeStream.option(
            "checkpointLocation", f"{root}/cp").trigger(availableNow=True).foreachBatch(lambda df, i: None).start()
        q.awaitTermination()
        land(landing, 5 + _)
    assert any(f.endswith(".json") for _, _, files in os.walk(archive) for f in files)
    assert json.loads(snapshot(0))
