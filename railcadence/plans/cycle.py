"""One update cycle: new passages in, three KPI histories out.

The same function serves a batch run and each micro-batch of a stream. Every
table it writes is keyed by cycle, so a cycle that is run again after a failure
replaces its own rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from railcadence import schema as S
from railcadence.functions import times
from railcadence.operators import clean, drift, gaps, headway, load, reference, regularity, replay, trips
from railcadence.session import work_tables
from railcadence.sinks import tables as T
from railcadence.sources import snapshots


@dataclass(frozen=True)
class Tables:
    """Folders of the tables below one root."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    @property
    def passages(self) -> str:
        return self.path("passages")

    @property
    def ledger(self) -> str:
        return self.path("fichiers_charges")

    @property
    def rejects(self) -> str:
        return self.path("lignes_rejetees")

    @property
    def reference(self) -> str:
        return self.path("missions_ref")

    @property
    def gap_history(self) -> str:
        return self.path("hist_ecart_horaire")

    @property
    def scores(self) -> str:
        return self.path("hist_moyenne_regularite")

    @property
    def gap_stats(self) -> str:
        return self.path("hist_moyenne_ecarts")

    @property
    def drift_stats(self) -> str:
        return self.path("hist_moyenne_allongement")


def load_passages(
    passages: DataFrame, tables: Tables, as_of: Column | dt.datetime | str, cycle: int, prefix: str = S.DUPLICATE_PREFIX
) -> None:
    """Clean one batch of passages and add it to the table."""
    T.append_history(
        clean.clean_passages(passages, as_of, prefix), tables.passages, cycle, partition_by=["service_date"]
    )


def load_new_snapshots(
    spark: SparkSession,
    landing: str,
    tables: Tables,
    as_of: dt.datetime | str,
    cycle: int,
    newest_only: bool = True,
) -> DataFrame:
    """Load landed snapshot files that the ledger does not list and list them there.

    With ``newest_only`` the newest file of each kind is taken, else all new ones.
    The ledger tells for every file how many records were unreadable, named as
    duplicates, finished and loaded. Returns the rejected lines, which are kept as well.
    Files are parsed once; the ledger is written last: after a failure the same cycle
    loads the same files again and replaces what it had written.
    """
    files = snapshots.list_files(spark, landing)
    ledger = T.read_history(spark, tables.ledger)
    if ledger is not None:  # rows of a failed attempt at this cycle do not count
        ledger = ledger.where(F.col("cycle") < cycle)
    taken = []
    for prefix in S.SNAPSHOT_PREFIX.values():
        named = files.where(F.col("file_name").rlike(snapshots.snapshot_pattern(prefix)))
        taken.append(load.files_to_load(snapshots.latest_snapshot(named, prefix) if newest_only else named, ledger))
    if newest_only:
        newest = [r["path"] for wanted in taken for r in wanted.select("path").take(1)]  # at most one row each
        if not newest:
            return spark.createDataFrame([], "file_name string, line string")
        records = snapshots.read_records(spark, newest)
    taken = reduce(DataFrame.unionByName, taken).select("file_name").distinct()
    if not newest_only:
        records = snapshots.read_records(spark, landing, taken)
    kind = F.coalesce(*[
        F.when(F.col("file_name").rlike(snapshots.snapshot_pattern(prefix)), kind) for kind, prefix in S.SNAPSHOT_PREFIX.items()
    ])
    with work_tables(spark, "load") as keep:
        records = keep(snapshots.parsed_records(records).withColumn("kind", kind), "records")
        good = records.where("not rejected")
        passages = reduce(DataFrame.unionByName, [
            snapshots.snapshot_passages(good.where(F.col("kind") == kind), kind, "file_name") for kind in S.SNAPSHOT_PREFIX
        ])
        load_passages(passages.drop("file_name"), tables, as_of, cycle)
        bad = records.where("rejected").select("file_name", "line")
        T.append_history(bad, tables.rejects, cycle)
        loaded = keep(taken, "files")
        trip_rows = passages.where("call_pos = 0").select("file_name", "mission", "ends_at")
        T.append_history(load.counted_ledger_rows(loaded, trip_rows, bad, as_of), tables.ledger, cycle)
    rejects = T.read_history(spark, tables.rejects)
    if rejects is None or "cycle" not in rejects.columns:
        return spark.createDataFrame([], "file_name string, line string")
    return rejects.where(F.col("cycle").cast("string") == str(cycle)).select("file_name", "line")


def update_reference(spark: SparkSession, tables: Tables, passages: DataFrame, cycle: int) -> DataFrame:
    """First cycle: build from all planned trips. Later: add what the newest snapshot has."""
    planned_trips = trips.trips_of(passages.where(F.col("kind") == "planned"))
    current = T.read_current(spark, tables.reference, before=cycle)
    if current is None:
        built = reference.build_reference(planned_trips)
    else:
        built = reference.reconcile_reference(
            current, reference.build_reference(planned_trips, latest_only=True)
        )
    return T.rebuild(built, tables.reference, cycle)


def run_cycle(
    spark: SparkSession,
    tables: Tables,
    service_date: str,
    as_of: Column | dt.datetime | str,
    cycle: int,
    key_stops: Mapping[str, str] = S.KEY_STOPS,
    horizon_min: float = S.HORIZON_MINUTES,
    cap: int = S.GAP_CAP_MIN,
    seen_until: Column | None = None,
) -> None:
    """Reference, scores, gaps and drift of one service day as of one moment.

    With ``seen_until`` later snapshots and later cycles do not count, so that the
    cycles of several snapshots may run after all of them were loaded.
    """
    def seen(table: DataFrame | None) -> DataFrame | None:
        return table if table is None or seen_until is None else table.where(F.col("observed_at") <= seen_until)

    day = seen(T.read_day(spark, tables.passages, service_date))
    if day is None or day.isEmpty():
        return
    planned, real = day.where(F.col("kind") == "planned"), day.where(F.col("kind") == "real")
    ref = update_reference(spark, tables, day, cycle)

    def append(df: DataFrame, path: str, **names: str) -> None:
        dated = df.withColumnsRenamed(names).withColumn("service_date", F.lit(service_date).cast("date"))
        T.append_history(dated, path, cycle, partition_by=["service_date"])

    # only key stops are scored, but a mission's first snapshot counts even if it
    # lists none of them: other calls lose their time, not their row
    is_key = F.col("stop_key").isin(*key_stops)
    scores = regularity.regularity_scores(
        headway.real_headways(real.where(is_key)),
        headway.planned_intervals(planned.withColumn("t", F.when(is_key, F.col("t")))),
        as_of, horizon_min,
    )
    wide = regularity.widen_scores(scores, key_stops)
    append(gaps.stamped(wide, as_of), tables.scores, observed_at="date_observation")

    missions = gaps.mission_gaps(gaps.schedule_gaps(planned, real, ref))
    append(gaps.gap_history_rows(missions, as_of), tables.gap_history)

    history = seen(T.read_day(spark, tables.gap_history, service_date))
    if history is None:
        return
    now = history.where(F.col("cycle").cast("string") == str(cycle))
    append(
        gaps.gap_stats(now, as_of, cap), tables.gap_stats,
        observed_at="date_observation", mean_gap="ecart_moyen", median_gap="ecart_median", max_gap="ecart_max",
    )
    drifts = drift.drift_stats(drift.mission_drift(history)).drop("n_missions")
    append(
        gaps.stamped(drifts, as_of), tables.drift_stats,
        observed_at="date_calcul", mean_drift="moyenne_allongement",
    )


def run_cycles(
    spark: SparkSession,
    tables: Tables,
    stamps: Sequence[tuple[int, str]],
    key_stops: Mapping[str, str] = S.KEY_STOPS,
    horizon_min: float = S.HORIZON_MINUTES,
    cap: int = S.GAP_CAP_MIN,
) -> None:
    """:func:`run_cycle` for many stamps at once, each from what was known at its time.

    ``stamps`` are (microseconds, service date); a stamp is its cycle's number. The days'
    passages are read once for all of them, whatever their number. Scores come from versions of
    real and planned times, gaps from each cycle's newest snapshots, drift from first gaps.
    """
    days = sorted({day for _, day in stamps})
    passages = [p for p in (T.read_day(spark, tables.passages, day) for day in days) if p is not None]
    if not passages:
        return
    passages = reduce(DataFrame.unionByName, passages)
    wanted = sorted((dt.date.fromisoformat(day), us) for us, day in stamps)
    newest = replay.newest_snapshots(replay.stamps_of(passages), wanted)
    if not newest:
        return
    first = min(us for *_, us in newest)
    numbers = [us for _, us in wanted]
    wall_clock = times.is_wall_clock(passages, "observed_at")
    cycles = spark.createDataFrame(sorted({(day, at) for day, _, _, at in newest}), "service_date date, as_of_us bigint")

    planned = passages.where(F.col("kind") == "planned")
    trip_rows = trips.trips_of(planned, "service_date").withColumn("observed_us", times.micros(passages, "observed_at"))
    current = T.read_current(spark, tables.reference, before=first)
    changes = replay.replay_reference(trip_rows, current, wanted, newest)
    changes = T.rebuild(changes, f"{tables.reference}_changes", numbers[-1], keep=1)
    T.rebuild(changes.where("to_us is null").select(*reference.COLUMNS), tables.reference, max(us for *_, us in newest))

    def append(df: DataFrame, path: str, stamp: str = "date_observation") -> None:
        rest = [c for c in df.columns if c not in ("service_date", "as_of_us")]
        dated = df.select(times.from_micros("as_of_us", wall_clock).alias(stamp), *rest, "service_date", F.col("as_of_us").alias("cycle"))
        T.append_cycles(dated, path, numbers, partition_by=["service_date"])

    by = ["service_date", "as_of_us"]
    with work_tables(spark, "cycles") as keep:
        scores = replay.replay_scores(passages, cycles, list(key_stops), keep, horizon_min)
        append(regularity.widen_scores(scores, key_stops, [*by, "direction"]), tables.scores)

    shots = spark.createDataFrame(newest, "service_date date, kind string, observed_us bigint, as_of_us bigint")
    missions = replay.replay_mission_gaps(passages, shots, changes)
    append(
        missions.where("max_gap_min is not null").select(*by, "mission", "direction", "max_gap_min"),
        tables.gap_history, "observed_at",
    )
    kept = [h for h in (T.read_day(spark, tables.gap_history, day) for day in days) if h is not None]
    if not kept:
        return
    history = reduce(DataFrame.unionByName, kept)
    history = history.withColumn("us", times.micros(history, "observed_at"))
    own = history.where(F.col("cycle").cast("string").isin(*map(str, numbers))).withColumnRenamed("us", "as_of_us")
    stats = gaps.gap_stats(own, cap=cap, by=[*by, "direction"])
    append(stats.withColumnsRenamed({"mean_gap": "ecart_moyen", "median_gap": "ecart_median", "max_gap": "ecart_max"}), tables.gap_stats)
    drifts = replay.replay_drift(history.select("service_date", "us", "mission", "direction", "max_gap_min"), cycles)
    append(drifts.drop("n_missions").withColumnRenamed("mean_drift", "moyenne_allongement"), tables.drift_stats, "date_calcul")


def archive_day(spark: SparkSession, tables: Tables, archive: str, service_date: str) -> dict[str, int]:
    """Nightly: export all tables, then drop the day's working tables."""
    paths = {p.rsplit("/", 1)[-1]: p for p in (
        tables.passages, tables.gap_history, tables.scores, tables.gap_stats, tables.drift_stats,
    )}
    reference_path = T.current_path(spark, tables.reference)
    if reference_path:
        paths["missions_ref"] = reference_path
    exported = T.archive_and_retain(spark, paths, archive, service_date)
    T.drop_versions(spark, tables.reference)
    return exported
