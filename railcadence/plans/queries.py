"""Every operator as a query over the driver's tables.

Each entry reads whole tables, or data Spark derives from them. The matching
SQL is in ``oracles.py`` under the same name.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from railcadence.functions import text, times
from railcadence.operators import (
    clean, drift, gaps, headway, latest, load, monitor, quality, reference, regularity, replay, reshape, serve, trips,
)
from railcadence.plans import adapters as A, cycle
from railcadence.session import one_group_at_a_time, work_dir, work_tables
from railcadence.sinks import tables as sink
from railcadence.sources import feed, snapshots
from railcadence.streaming import feed as live, state

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = "2024-01-01 00:00:00"
HORIZON_MIN = 30 * 1440
FINISHED_BEFORE = "1998-09-02 00:00:00"
DAY = "2024-01-01"
EXPORT_STAMP = dt.datetime(2024, 1, 31)
STOPS = {s: s for s in A.EVENT_STOPS}


# ------------------------------------------------------------ headways and scores
def _passages(spark, d, snapshot="hour"):
    return A.event_passages(A.table(spark, d, "events"), snapshot)


def headway_planned(spark, d):
    return headway.planned_headways(A.planned_of(_passages(spark, d)))


def headway_real(spark, d):
    return headway.real_headways(A.real_of(_passages(spark, d)))


def _sides(spark, d):
    p = _passages(spark, d)
    return headway.real_headways(A.real_of(p)), headway.planned_intervals(A.planned_of(p))


def regularity_scores(spark, d):
    real, planned = _sides(spark, d)
    return regularity.regularity_scores(real, planned, AS_OF, HORIZON_MIN)


def regularity_scores_wide(spark, d):
    return regularity.widen_scores(regularity_scores(spark, d), STOPS)


def rolling_horizon_scores(spark, d):
    real, planned = _sides(spark, d)
    return regularity.rolling_scores(real, planned)


# ------------------------------------------------------------------ schedule gaps
def _gap_inputs(spark, d):
    p = _passages(spark, d, "day")
    trip_rows = A.event_trips(A.planned_of(p))
    counted = A.with_stop_counts(p, trip_rows)
    return A.planned_of(counted), A.real_of(counted), reference.build_reference(trip_rows)


def schedule_gaps(spark, d):
    planned, real, ref = _gap_inputs(spark, d)
    return gaps.schedule_gaps(planned, real, ref, latest_by=["mission"])


def mission_gap_max(spark, d):
    return gaps.mission_gaps(schedule_gaps(spark, d))


def gaps_wide(spark, d):
    return gaps.widen_gaps(schedule_gaps(spark, d), A.EVENT_STOPS)


def gap_stats(spark, d):
    return _rounded(gaps.gap_stats(mission_gap_max(spark, d)), "mean_gap")


def _rounded(df, *cols):
    return df.withColumns({c: F.round(c, 9) for c in cols})


# -------------------------------------------------------------------------- drift
def _gap_observations(spark, d):
    """Gap of every event: mission = user, snapshot = day."""
    return A.table(spark, d, "events").select(
        F.col("user_id").cast("string").alias("mission"),
        F.when(F.col("user_id") % 2 == 0, "Nord").otherwise("Sud").alias("direction"),
        F.to_date("ts").cast("timestamp_ntz").alias("observed_at"),
        F.round(F.col("value") / 60).cast("int").alias("max_gap_min"),
    )


def _gap_history(spark, d):
    return _gap_observations(spark, d).groupBy("mission", "direction", "observed_at").agg(
        F.max("max_gap_min").alias("max_gap_min")
    )


def drift_missions(spark, d):
    return _rounded(drift.mission_drift(_gap_history(spark, d)), "drift")


def drift_first_last(spark, d):
    return _rounded(drift.drift_stats(drift.mission_drift(_gap_history(spark, d))), "mean_drift")


def drift_strict_join(spark, d):
    return _rounded(drift.drift_stats_repeated(_gap_observations(spark, d)), "mean_drift")


# -------------------------------------------------------------- mission reference
def reference_build(spark, d):
    runs = A.table(spark, d, "part").select(
        F.col("p_type").alias("mission_type"),
        text.direction(F.col("p_type")).alias("direction"),
        F.col("p_brand").alias("origin"),
        F.element_at(F.split("p_name", " "), -1).alias("destination"),
        F.col("p_size").alias("n_served"),
    )
    return reference.build_reference(runs)


def reference_latest(spark, d):
    return reference.build_reference(
        A.event_trips(A.planned_of(_passages(spark, d, "day"))), latest_only=True
    )


def _part_reference(spark, d, shift, gaps_in_origin):
    word = F.element_at(F.split("p_name", " "), 1 if shift else -1)
    origin = F.when(F.col("p_brand") != "Brand#1", word) if gaps_in_origin else word
    code = F.concat_ws("-", "p_type", (F.col("p_size") + shift).cast("string"))
    return A.table(spark, d, "part").select(
        code.alias("mission_type"),
        text.direction(code).alias("direction"),
        origin.alias("origin"),
        F.col("p_brand").alias("destination"),
        (F.col("p_size") + shift).alias("n_stops"),
    )


RULES = {"P": "Promotion terminus", "S": "South terminus"}


def reference_reconcile(spark, d):
    return reference.reconcile_reference(
        _part_reference(spark, d, 0, True), _part_reference(spark, d, 10, False), RULES
    )


def destination_rules(spark, d):
    orders = A.table(spark, d, "orders").select(
        "o_orderkey",
        F.substring("o_orderpriority", 3, 20).alias("mission_type"),
        F.col("o_orderstatus").alias("destination"),
    )
    return reference.correct_destinations(orders, {"U": "Urgent", "L": "Low", "H": "High"})


# ----------------------------------------------------------------- load and clean
def clean_prefix(spark, d):
    part = A.table(spark, d, "part").select("p_partkey", "p_name")
    return clean.drop_prefixed(part, "p_name", "red")


def _order_trips(spark, d):
    ends = A.table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.max("l_shipdate").alias("ends_at")
    )
    return A.table(spark, d, "orders").select("o_orderkey", "o_orderpriority").join(ends, "o_orderkey", "left")


def clean_finished(spark, d):
    return clean.drop_finished(_order_trips(spark, d), FINISHED_BEFORE)


def clean_counters(spark, d):
    return clean.clean_counters(_order_trips(spark, d), FINISHED_BEFORE, "o_orderpriority", prefix="1-")


def ledger_anti_join(spark, d):
    return clean.not_in_ledger(
        A.table(spark, d, "orders").select("o_orderkey", "o_custkey"),
        A.table(spark, d, "lineitem"), "o_orderkey", "l_orderkey",
    )


def _files(spark, d):
    """A listing of files: one per event, the name built from its type and time."""
    stamp = F.concat(
        F.replace(F.to_date("ts").cast("string"), F.lit("-"), F.lit("")), F.lit("_"),
        *[F.lpad(F.format_string("%02d", part), 2, "0")
          for part in (F.hour("ts"), F.minute("ts"), F.second("ts").cast("int"))],
    )
    prefix = F.when(F.col("event_type").isin("view", "click"), "horaires_reels").otherwise("horaires_theoriques")
    tail = F.when(F.col("event_type") == "error", "_mauvais.csv").otherwise(".csv")
    return A.table(spark, d, "events").select(
        F.concat(prefix, F.lit("_"), stamp, tail).alias("file_name"),
        F.col("user_id"),
        F.expr("ts + make_dt_interval(0, 0, 0, cast(value as decimal(18, 6)))").alias("modified"),
    )


def latest_file(spark, d):
    """Newest well-named file per user, for both prefixes."""
    files = _files(spark, d)
    out = [snapshots.latest_snapshot(files, p, by=["user_id"]).withColumn("prefix", F.lit(p))
           for p in ("horaires_reels", "horaires_theoriques")]
    return out[0].unionByName(out[1])


def files_to_load(spark, d):
    """Files whose name is not among the planned ones already loaded."""
    files = _files(spark, d).select("file_name")
    loaded = load.ledger_rows(files.where(F.col("file_name").startswith("horaires_theoriques")), AS_OF)
    return load.files_to_load(files, loaded)


def latest_rows_per_user(spark, d):
    rows = _passages(spark, d, "day").select("mission_type", "mission", "stop_key", "observed_at")
    return latest.latest(rows, "observed_at", ["mission_type"])


# ------------------------------------------------------------- trips and reshaping
def trip_summary(spark, d):
    calls = A.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    return trips.trip_summary(calls, ["l_orderkey"], "l_shipdate", "l_partkey", ["l_linenumber"])


LINES = (1, 2, 3, 4, 5, 6, 7)


def _wide_calls(spark, d):
    calls = A.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"
    )
    return reshape.pivot_calls(
        calls, ["l_orderkey"], "l_linenumber", LINES, "l_shipdate", ("l_partkey", "l_suppkey"), prefix="stop_"
    )


def calls_pivot_wide(spark, d):
    # a stop no order has stays a NULL column
    wide = reshape.with_missing_columns(_wide_calls(spark, d), ["stop_8"], "timestamp_ntz")
    return wide.withColumn("last_t", reshape.row_max([f"stop_{i}" for i in LINES]))


def calls_unpivot(spark, d):
    return reshape.unpivot_calls(_wide_calls(spark, d), ["l_orderkey"], [f"stop_{i}" for i in LINES])


# ------------------------------------------------------------------------- sources
def siri_parse(spark, d):
    lineitem = A.table(spark, d, "lineitem")
    stops = lineitem.select("l_linenumber").distinct().select(
        F.col("l_linenumber").alias("stop_id"),
        F.col("l_linenumber").alias("stop_seq"),
        F.concat(F.lit("stop_"), F.col("l_linenumber").cast("string")).alias("stop_key"),
        F.concat(F.lit("Stop "), F.col("l_linenumber").cast("string")).alias("stop_name"),
    )
    payloads = A.siri_payloads(A.table(spark, d, "orders"), lineitem)
    parsed = feed.parse_siri(payloads, stops)
    return parsed.select(
        "mission", "mission_type", "direction", "destination", "kind", "stop_id", "stop_key", "stop_seq",
        F.unix_micros("t").alias("t_us"), "origin", "n_served", F.unix_micros("ends_at").alias("ends_us"),
        "service_date",
    )


def json_props(spark, d):
    events = A.table(spark, d, "events")
    return events.select("event_id", F.from_json("props", "k int")["k"].alias("k"))


def _snapshot_records(spark, d):
    """Wide snapshot files as text, one per 100 events; errors have fields too many (each
    thousandth event 5,000 quoted ones), signups too few. Destinations hold a line break."""
    block = F.floor(F.col("event_id") / 100).cast("bigint")
    iso = F.concat(F.replace(F.col("ts").cast("string"), F.lit(" "), F.lit("T")), F.lit("+00:00"))
    head = F.concat_ws(",", F.concat(F.lit("M"), F.col("event_id").cast("string")), F.lit('"a, ""b""\n"'))
    line = (
        F.when(F.col("event_type") == "error", F.concat_ws(
            ",", head, iso, F.lit("NA"), iso,
            F.when(F.col("event_id") % 1000 == 0, F.repeat(F.lit('"q",'), 5000)).otherwise(F.lit("x")),
        ))
        .when(F.col("event_type") == "signup", F.concat_ws(",", head, iso))
        .otherwise(F.concat_ws(",", head, iso, F.lit("NA"), iso))
    )
    files = A.table(spark, d, "events").groupBy(F.concat(F.lit("f"), block.cast("string")).alias("file_name")).agg(
        F.concat_ws("\n", F.lit("mission,destination,Saint-Rémy,Antony,date_observation"),
                    F.collect_list(line)).alias("content")
    )
    return snapshots.split_records(files)


def csv_rows(spark, d):
    rows, _ = snapshots.snapshot_rows(_snapshot_records(spark, d))
    first, second = F.col("stops")[0], F.col("stops")[1]
    return rows.select(
        "file_name", "mission", "destination", "date_observation",
        first["column"].alias("column_1"), first["key"].alias("key_1"), first["value"].alias("value_1"),
        second["column"].alias("column_2"), second["key"].alias("key_2"), second["value"].alias("value_2"),
    )


def csv_rejects(spark, d):
    _, rejects = snapshots.snapshot_rows(_snapshot_records(spark, d))
    return rejects


def csv_roundtrip(spark, d):
    """Event passages written as a wide snapshot, read back and made long again."""
    p = A.planned_of(_passages(spark, d, "day"))
    counted = A.with_stop_counts(p, A.event_trips(p)).withColumns(
        {"destination": F.lit(""), "origin": F.lit(None).cast("string")}
    )
    frame = snapshots.snapshot_frame(counted, [(s, s) for s in A.EVENT_STOPS])
    as_text = frame.select(*[F.col(c).cast("string").alias(c) for c in frame.columns])
    path = sink.write_snapshot(as_text, work_dir(spark, "snapshot"), "horaires_theoriques", EXPORT_STAMP)
    rows, _ = snapshots.read_snapshot_csv(spark, path)
    back = snapshots.snapshot_passages(rows, "planned")
    return back.select("mission", "stop_key", F.unix_micros("t").alias("t_us"), "n_served")


def normalize_key(spark, d):
    parts = A.table(spark, d, "part").select(
        F.lit("part").alias("origin"), F.col("p_partkey").alias("id"), F.col("p_name").alias("name")
    )
    docs = A.table(spark, d, "documents").select(
        F.lit("document").alias("origin"), F.col("doc_id").alias("id"), F.col("text").alias("name")
    )
    both = parts.unionByName(docs)
    return both.select("origin", "id", text.normalize_key(F.col("name")).alias("key"))


def try_parse_times(spark, d):
    """Three spellings of the event time: with offset, without, and unreadable."""
    iso = F.replace(F.col("ts").cast("string"), F.lit(" "), F.lit("T"))
    spelled = (
        F.when(F.col("event_type") == "view", F.concat(iso, F.lit("+02:00")))
        .when(F.col("event_type") == "error", F.concat(F.lit("le "), iso))
        .when(F.col("event_type") == "click", F.concat(iso, F.lit("Z")))
        .otherwise(F.col("ts").cast("string"))
    )
    return A.table(spark, d, "events").select(
        "event_id", F.unix_micros(times.parse_instant_utc(spelled)).alias("us")
    )


# ------------------------------------------------------------- histories and cards
def _daily_gap_stats(spark, d):
    daily = _gap_history(spark, d)
    return gaps.gap_stats(daily, by=["observed_at", "direction"])


def _served_gaps(spark, d):
    return _daily_gap_stats(spark, d).select(
        F.col("observed_at").alias("date_observation"), "direction",
        F.round("mean_gap", 9).alias("ecart_moyen"), F.col("median_gap").alias("ecart_median"),
        F.col("max_gap").cast("double").alias("ecart_max"),
    )


def latest_two(spark, d):
    return latest.latest_rows(_served_gaps(spark, d), "date_observation", 2)


def latest_per_direction(spark, d):
    return latest.latest_per_key(_served_gaps(spark, d), "date_observation")


def last_update(spark, d):
    return latest.newest_stamp(_served_gaps(spark, d), "date_observation")


def kpi_cards(spark, d):
    """Cards of the wide scores, one per stop and direction."""
    return serve.score_cards(_last_call_scores(spark, d), {f"Stop {s}": s for s in A.EVENT_STOPS})


def _last_call_scores(spark, d):
    """Scores with both sides taken at the last call of a mission. Delays are then
    small next to the headways, so the scores spread over the bands."""
    p = _passages(spark, d)
    real = headway.real_headways(A.real_of(p))
    planned = headway.real_headways(A.planned_of(p))
    return regularity.widen_scores(regularity.regularity_scores(real, planned, AS_OF, HORIZON_MIN), STOPS)


def gap_cards(spark, d):
    return serve.gap_cards(_served_gaps(spark, d).withColumn("direction", F.concat_ws(
        " ", "direction", F.to_date("date_observation").cast("string"))))


def drift_cards(spark, d):
    per_mission = drift_missions(spark, d).select(
        F.concat_ws(" ", "direction", "mission").alias("direction"),
        (F.col("drift") * 1000).alias("moyenne_allongement"),
    )
    return serve.drift_cards(per_mission)


def quality_checks(spark, d):
    scores = regularity_scores_wide(spark, d)
    return quality.check_scores(scores, [f"score_{s}" for s in A.EVENT_STOPS]).unionByName(
        quality.check_gaps(_daily_gap_stats(spark, d))
    )


def history_roundtrip(spark, d):
    """Daily gap statistics appended under one cycle, then again without their first day:
    the rerun adds nothing and the first day is gone."""
    path = work_dir(spark, "history")
    rows = _served_gaps(spark, d).withColumn("service_date", F.to_date("date_observation"))
    first_day = rows.agg(F.min("service_date")).scalar()
    for attempt in (rows, rows.where(F.col("service_date") > first_day)):
        sink.append_history(attempt, path, 1, partition_by=["service_date"])
    return sink.read_history(spark, path).select(
        "date_observation", "direction", "ecart_moyen", "ecart_median", "ecart_max"
    )


def update_cycle(spark, d):
    """One whole cycle on the events: load, reference, scores, gaps, drift; read back from its tables."""
    tables = cycle.Tables(work_dir(spark, "cycle"))
    cycle.load_passages(A.full_passages(A.table(spark, d, "events"), DAY), tables, AS_OF, 0)
    cycle.run_cycle(spark, tables, DAY, F.lit(AS_OF).cast("timestamp_ntz"), 0, STOPS, HORIZON_MIN)
    scores = sink.read_day(spark, tables.scores, DAY)
    stats = sink.read_day(spark, tables.gap_stats, DAY)
    drifts = sink.read_day(spark, tables.drift_stats, DAY)
    return (
        scores.select("direction", *[f"score_{s}" for s in A.EVENT_STOPS])
        .join(stats.select("direction", "ecart_moyen", "ecart_median", "ecart_max"), "direction")
        .join(drifts.select("direction", "moyenne_allongement"), "direction")
        .withColumn("ecart_moyen", F.round("ecart_moyen", 9))
    )


CYCLE_HORIZON_MIN = 180


def replay_cycles(spark, d):
    """Scores of every cycle of every day, each from what was known then, in one pass."""
    events = A.table(spark, d, "events")
    folder = work_dir(spark, "replay")
    parsed = feed.parse_siri(A.cycle_payloads(events), A.event_stop_list(events), spread=True)
    with one_group_at_a_time(spark):
        clean.clean_passages(parsed, F.col("observed_at")).write.parquet(f"{folder}/passages")
    passages = spark.read.parquet(f"{folder}/passages")
    cycles = passages.select("service_date", F.unix_micros("observed_at").alias("as_of_us")).distinct()
    with work_tables(spark, "cycles") as keep:
        scores = replay.replay_scores(passages, cycles, A.EVENT_STOPS, keep, CYCLE_HORIZON_MIN)
        scores.write.parquet(f"{folder}/scores")
    return spark.read.parquet(f"{folder}/scores").drop("service_date")


def stream_update_cycles(spark, d):
    """The feed as a stream of several micro-batches: all histories of all cycles. Days reach over
    batches, so first gaps and known times come from earlier ones."""
    events = A.table(spark, d, "events")
    folder = work_dir(spark, "feed")
    hours = F.unix_micros("landed_at") / F.lit(3_600e6)
    with one_group_at_a_time(spark):
        sink.write_large_rows(A.cycle_payloads(events).withColumn("part", F.floor((hours + 12) / 240).cast("bigint")), f"{folder}/payloads")
    landed = spark.read.parquet(f"{folder}/payloads")
    for part in sorted(r[0] for r in landed.select("part").distinct().collect()):  # one file per ten days
        sink.write_large_rows(landed.where(F.col("part") == part).drop("part").coalesce(1), f"{folder}/landing")
    source = spark.readStream.schema("payload string, landed_at timestamp").option("maxFilesPerTrigger", 1).parquet(f"{folder}/landing")
    tables = cycle.Tables(f"{folder}/tables")
    live.run_feed(
        spark, source, A.event_stop_list(events), tables, f"{folder}/checkpoint", STOPS, {"availableNow": True}, CYCLE_HORIZON_MIN
    ).awaitTermination()
    key = ["as_of_us", "direction"]

    def history(path, stamp, *columns):
        return sink.read_history(spark, path).select(F.unix_micros(stamp).alias("as_of_us"), "direction", *columns)

    scores = history(tables.scores, "date_observation", *[f"score_{s}" for s in A.EVENT_STOPS])
    stats = history(tables.gap_stats, "date_observation", F.round("ecart_moyen", 9).alias("ecart_moyen"), "ecart_median", "ecart_max")
    drifts = history(tables.drift_stats, "date_calcul", F.round("moyenne_allongement", 9).alias("moyenne_allongement"))
    return scores.join(stats, key, "full").join(drifts, key, "full")


LOAD_AS_OF = "2024-01-11 00:00:00Z"
_HEADER = "mission,type_mission,destination,Antony,gare_depart,nb_arrets_desservis,date_observation"


def _landed(spark, d, folder, prefix, half):
    """Half a month of events as one snapshot: signups are named as duplicates, errors have a field too many."""
    t = F.col("ts") if prefix == "horaires_theoriques" else F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("value").cast("decimal(18,6)"))
    iso = F.concat(F.replace(t.cast("string"), F.lit(" "), F.lit("T")), F.lit("Z"))
    name = F.concat(F.when(F.col("event_type") == "signup", "RATP").otherwise("M"), F.col("event_id").cast("string"))
    line = F.concat_ws(",", name, F.lit("MISS"), F.lit("x"), iso, F.lit("Antony"), F.lit("1"), F.lit("2024-01-01T00:00:00Z"))
    line = F.when(F.col("event_type") == "error", F.concat(line, F.lit(",y"))).otherwise(line)
    events = A.table(spark, d, "events").where((F.dayofmonth("ts") > 15) == F.lit(half == 1))
    # whole lines: the separator occurs in none of them
    writer = events.select(line.alias(_HEADER)).write.option("header", True).option("sep", "\u0001")
    writer.csv(f"{folder}/{prefix}_2024010{half + 1}_000000.csv")


def load_new_files(spark, d):
    """Snapshots land twice and are loaded twice, with the first load repeated as after a failure; the ledger."""
    folder = work_dir(spark, "load")
    tables = cycle.Tables(f"{folder}/tables")
    for half in (0, 1):
        for prefix in ("horaires_theoriques", "horaires_reels"):
            _landed(spark, d, f"{folder}/landing", prefix, half)
        for _ in range(2 - half):
            cycle.load_new_snapshots(spark, f"{folder}/landing", tables, LOAD_AS_OF, half, newest_only=False)
    ledger = sink.read_history(spark, tables.ledger)
    n_rows = sink.read_history(spark, tables.passages).groupBy("cycle").agg(F.count("*").alias("n_passages"))
    return ledger.join(n_rows, "cycle", "left").select(
        "file_name", "n_bad", "n_prefixed", "n_finished", "n_loaded", F.coalesce("n_passages", F.lit(0)).alias("n_passages")
    )


def archive_day(spark, d):
    """Daily gap statistics as a kept and a working table; a day is closed, gets a late row and is closed again."""
    folder = work_dir(spark, "archive")
    rows = _served_gaps(spark, d).withColumn("service_date", F.to_date("date_observation"))
    tables = {"hist_moyenne_ecarts": f"{folder}/kept", "passages": f"{folder}/working"}
    for path in tables.values():
        sink.append_history(rows, path, 0, partition_by=["service_date"])
    day = str(rows.agg(F.min("service_date")).first()[0])
    sink.archive_and_retain(spark, tables, f"{folder}/archive", day)
    sink.append_history(rows.where(F.col("service_date").cast("string") == day).where("direction = 'Nord'"), tables["passages"], 1, ["service_date"])
    sink.archive_and_retain(spark, tables, f"{folder}/archive", day)
    left = [sink.read_history(spark, path).select(F.lit(name).alias("name"), F.lit("table").alias("place"), "direction") for name, path in tables.items()]
    out = [spark.read.option("header", True).option("recursiveFileLookup", "true").csv(f"{folder}/archive/{name}").select(
        F.lit(name).alias("name"), F.lit("archive").alias("place"), "direction") for name in tables]
    both = left[0].unionByName(left[1]).unionByName(out[0]).unionByName(out[1])
    return both.groupBy("name", "place", "direction").agg(F.count("*").alias("n"))


# ---------------------------------------------------------------------- monitoring
def _events(spark, d):
    return A.table(spark, d, "events").select("ts", "event_id", "user_id", "event_type", "value")


def mon_p95(spark, d):
    return _rounded(monitor.latency_quantile(_events(spark, d), "event_type", "value"), "quantile")


def mon_rate(spark, d):
    return monitor.request_rate(_events(spark, d), "event_type")


def mon_error_pct(spark, d):
    return monitor.error_percent(_events(spark, d), F.col("event_type") == "error")


def mon_counter_rate(spark, d):
    """The value column read as a counter that restarts often; whole hundredths."""
    samples = _events(spark, d).withColumn("c", F.round(F.col("value") * 100).cast("bigint"))
    return monitor.counter_rate(samples, ["event_type"], "c")


def mon_gauge(spark, d):
    return monitor.scaled_gauge(_events(spark, d).select("event_id", "value"), "value")


# ----------------------------------------------------------------------- streaming
def _event_stream(spark, d):
    schema = A.table(spark, d, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)


def _finished(spark, updates, purpose, keys):
    root = work_dir(spark, purpose)
    state.write_updates(updates, f"{root}/table", f"{root}/checkpoint").awaitTermination()
    return state.current_state(spark, f"{root}/table", keys)


def stream_tumbling(spark, d):
    counts = state.tumbling_counts(_event_stream(spark, d), ["event_type"], "ts", "5 minutes", "10 minutes")
    return _finished(spark, counts, "tumbling", ["w", "event_type"]).select(
        F.col("w.start").cast("timestamp_ntz").alias("window_start"), "event_type", "n"
    )


CALL = ["mission", "direction", "stop_key"]


def stream_first_planned(spark, d):
    calls = A.planned_of(A.event_passages(_event_stream(spark, d)))
    rows = _finished(spark, state.first_planned(calls, CALL), "first", ["service_day", *CALL])
    return rows.select(*CALL, F.col("service_day").cast("timestamp_ntz").alias("service_day"), "first_t", "first_observed_at")


def stream_last_real(spark, d):
    calls = A.real_of(A.event_passages(_event_stream(spark, d)))
    rows = _finished(spark, state.last_real(calls, CALL), "last", ["service_day", *CALL])
    return rows.select(*CALL, F.col("service_day").cast("timestamp_ntz").alias("service_day"), "last_t")


def stream_foreach_scores(spark, d):
    """Scores from streamed state: last real times against the first planned ones."""
    real = stream_last_real(spark, d).select(*CALL, F.col("last_t").alias("t"))
    first = stream_first_planned(spark, d).select(
        *CALL, F.col("first_t").alias("t"), F.col("first_observed_at").alias("observed_at")
    )
    return regularity.regularity_scores(
        headway.real_headways(real), headway.planned_intervals(first), AS_OF, HORIZON_MIN
    )


def all_queries() -> dict[str, Query]:
    listed = [
        headway_planned, headway_real, regularity_scores, regularity_scores_wide, rolling_horizon_scores,
        schedule_gaps, mission_gap_max, gaps_wide, gap_stats,
        drift_missions, drift_first_last, drift_strict_join,
        reference_build, reference_latest, reference_reconcile, destination_rules,
        clean_prefix, clean_finished, clean_counters, ledger_anti_join, latest_file, files_to_load,
        latest_rows_per_user, trip_summary, calls_pivot_wide, calls_unpivot,
        siri_parse, json_props, csv_rows, csv_rejects, csv_roundtrip, normalize_key, try_parse_times,
        latest_two, latest_per_direction, last_update, kpi_cards, gap_cards, drift_cards,
        quality_checks, history_roundtrip, update_cycle, replay_cycles, stream_update_cycles, load_new_files, archive_day,
        mon_p95, mon_rate, mon_error_pct, mon_counter_rate, mon_gauge,
        stream_tumbling, stream_first_planned, stream_last_real, stream_foreach_scores,
    ]
    return {q.__name__: q for q in listed}
