"""Replay of recorded outputs of the system this engine replaces.

Set RAILCADENCE_EXPORTS to a folder of exported CSV tables. Tables are found by
their columns. Without the setting the tests are skipped.
"""

from __future__ import annotations

import glob
import os

import pytest
from pyspark.sql import functions as F

from railcadence import schema as S
from railcadence.operators import drift, gaps, headway, reference, regularity, reshape
from railcadence.sources.stops import read_stops

FOLDER = os.environ.get("RAILCADENCE_EXPORTS")
STOP_FILE = os.environ.get("RAILCADENCE_STOPS")
pytestmark = pytest.mark.skipif(not FOLDER, reason="RAILCADENCE_EXPORTS is not set")

SHORT = list(S.KEY_STOPS.values())
AS_OF = "2026-04-17 08:10:03.991291"
REF = {"code_mission": "mission_type", "gare_depart": "origin", "gare_destination": "destination", "nb_arrets_mission": "n_stops"}


def tables(spark, *columns):
    """Exports whose header holds all the columns, smallest header first."""
    found = []
    for path in sorted(glob.glob(f"{FOLDER}/*.csv")):
        with open(path, encoding="utf-8") as f:
            header = f.readline().strip().split(",")
        if set(columns) <= set(header):
            found.append((len(header), path))
    return [spark.read.csv(p, header=True) for _, p in sorted(found)]


def headway_table(spark, kind):
    """The wide export as long calls: mission, direction, stop_key, wall-clock t, recorded headway."""
    [wide] = tables(spark, f"heure_{kind}_sceaux", "delta_sceaux")
    pairs = F.explode(F.array(*[
        F.struct(F.lit(s).alias("stop_key"), F.col(f"heure_{kind}_{s}").cast("timestamp_ntz").alias("t"),
                 F.col(f"delta_{s}").cast("double").cast("int").alias("recorded")) for s in SHORT]))
    return wide.select("mission", "direction", pairs.alias("p")).select("mission", "direction", "p.*")


@pytest.mark.parametrize("kind", ["th", "re"])
def test_headways(spark, kind):
    table = headway_table(spark, kind)
    calls = table.where("t IS NOT NULL")
    if kind == "re":
        mine = headway.real_headways(calls)
    else:
        seen = F.lit("2026-04-17").cast("timestamp_ntz")
        mine = headway.planned_headways(calls.withColumn("observed_at", seen))
    both = calls.join(mine, ["mission", "direction", "stop_key", "t"], "full_outer")
    assert both.count() == calls.count() == mine.count()
    assert both.where(~F.col("headway_min").eqNullSafe(F.col("recorded"))).count() == 0
    assert table.where("t IS NULL AND recorded IS NOT NULL").count() == 0
    if kind == "th":
        n = {r[0]: r[1] for r in mine.where("headway_min IS NOT NULL").groupBy("stop_key").count().collect()}
        assert [n[s] for s in SHORT] == [22, 67, 92, 98, 85, 50, 32]


def test_scores(spark):
    real = headway.real_headways(headway_table(spark, "re"))
    planned = headway.real_headways(headway_table(spark, "th"))
    scores = regularity.regularity_scores(real, planned, AS_OF)
    wide = {r["direction"]: list(r[1:]) for r in regularity.widen_scores(scores, {s: s for s in SHORT}).collect()}
    pairs = {(r["direction"], r["stop_key"]): r["n_pairs"] for r in scores.collect()}
    assert wide == {"Nord": [100, 98, 98, 88, 91, 97, 93], "Sud": [100, 86, 89, 98, 98, 100, 100]}
    assert [pairs["Nord", s] for s in SHORT] == [5, 13, 19, 20, 15, 11, 5]
    assert [pairs["Sud", s] for s in SHORT] == [5, 15, 21, 21, 21, 10, 9]
    history = tables(spark, "date_observation", "score_sceaux")[0]
    last = history.where(F.col("date_observation") == history.agg(F.max("date_observation")).first()[0])
    assert {r["direction"]: [int(float(r[f"score_{s}"])) for s in SHORT] for r in last.collect()} == wide


def gap_detail(spark):
    detail = [t for t in tables(spark, "mission", "direction", "ecart_max", "antony")][0]
    stops = [c for c in detail.columns if c not in ("mission", "direction", "ecart_max")]
    return detail.select("mission", "direction", *[F.col(c).cast("double").cast("int").alias(c) for c in stops + ["ecart_max"]]), stops


def test_largest_gaps(spark):
    detail, stops = gap_detail(spark)
    assert len(stops) == 47
    long = detail.unpivot(["mission", "direction"], stops, "stop_key", "gap_min")
    mine = gaps.mission_gaps(long).join(detail.select("mission", "direction", "ecart_max"), ["mission", "direction"])
    assert mine.count() == 50
    assert mine.where(~F.col("max_gap_min").eqNullSafe(F.col("ecart_max"))).count() == 0
    assert detail.where(~reshape.row_max(stops).eqNullSafe(F.col("ecart_max"))).count() == 0
    stats = {r["direction"]: tuple(r)[1:] for r in gaps.gap_stats(gaps.mission_gaps(long)).collect()}
    assert stats == {"Nord": (pytest.approx(1.3636363636363635), 2.0, 3), "Sud": (pytest.approx(2.869565217391304), 3.0, 8)}


def gap_history(spark):
    [h] = tables(spark, "id", "mission", "date_observation", "ecart_max")
    return h.select("mission", "direction", F.col("date_observation").cast("timestamp_ntz").alias("observed_at"),
                    F.col("ecart_max").cast("double").cast("int").alias("max_gap_min"))


def test_gap_history(spark, rows):
    detail, stops = gap_detail(spark)
    long = detail.unpivot(["mission", "direction"], stops, "stop_key", "gap_min")
    added = gaps.gap_history_rows(gaps.mission_gaps(long), AS_OF).select("mission", "direction", "max_gap_min")
    history = gap_history(spark)
    last = history.where(F.col("observed_at") == history.agg(F.max("observed_at")).scalar())
    assert added.count() == 45
    assert rows(added) == rows(last.select("mission", "direction", "max_gap_min"))


@pytest.mark.parametrize("stats", [lambda h: drift.drift_stats(drift.mission_drift(h)), drift.drift_stats_repeated])
def test_drift(spark, stats):
    got = {r["direction"]: (r[1], r["mean_drift"]) for r in stats(gap_history(spark)).collect()}
    assert got == {"Nord": (22, pytest.approx(0.015191303930044671)), "Sud": (23, pytest.approx(0.05245342560388837))}


def test_reference(spark, rows):
    refs = [t.withColumnsRenamed(REF).withColumn("n_stops", F.col("n_stops").cast("int")) for t in tables(spark, *REF)]
    incoming, *full = sorted(refs, key=lambda t: t.count())
    assert incoming.count() == 20 and [t.count() for t in full] == [41, 41]
    # one of the two larger tables is the other with its destinations corrected
    fixed = [rows(reference.correct_destinations(t).distinct().select(*reference.COLUMNS)) for t in full]
    assert fixed[0] == fixed[1] and fixed[0] in [rows(t.select(*reference.COLUMNS)) for t in full]
    current = next(t for t, f in zip(full, fixed) if rows(t.select(*reference.COLUMNS)) == f)
    assert rows(reference.reconcile_reference(current, incoming)) == fixed[0]


@pytest.mark.skipif(not STOP_FILE, reason="RAILCADENCE_STOPS is not set")
def test_stop_list(spark):
    got = read_stops(spark, STOP_FILE).orderBy("stop_seq").collect()
    assert [r["stop_seq"] for r in got] == list(range(47))
    assert {"chatelet_les_halles", "saint_remy_les_chevreuse", *S.KEY_STOPS} <= {r["stop_key"] for r in got}
    _, stops = gap_detail(spark)
    assert set(stops) == {r["stop_key"] for r in got}
