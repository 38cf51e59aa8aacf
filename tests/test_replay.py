"""All cycles of a day in one pass against the cycles one by one."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from railcadence.functions import times
from railcadence.operators import asof, headway, regularity, replay
from railcadence.session import work_tables

START = dt.datetime(2024, 1, 1)
SCHEMA = "service_date date, mission string, direction string, stop_key string, kind string, t timestamp_ntz, observed_at timestamp_ntz"


def snapshots(seed):
    """Trains that come and go, share instants, are late by much, run early and change their times back."""
    rng, rows = random.Random(seed), []
    for day in range(2):
        for s in range(5):
            observed = START + dt.timedelta(days=day, minutes=25 * s)
            for m in range(12):
                if rng.random() < 0.4:
                    continue
                name = f"M{m // 2 if rng.random() < 0.1 else m:02d}"
                for stop in ("a", "b", None):
                    planned = START + dt.timedelta(days=day, minutes=9 * m + rng.choice([0, 0, 3, -40]))
                    late = dt.timedelta(seconds=rng.choice([0, 0, 120, 600, 5000, -300]))
                    for kind, t in (("planned", planned), ("real", planned + late)):
                        if rng.random() < 0.8:
                            rows.append((observed.date(), name, "N", stop, kind, t if rng.random() < 0.95 else None, observed))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_scores_of_all_cycles(spark, seed):
    df = spark.createDataFrame(snapshots(seed), SCHEMA).cache()
    us = times.micros(df, "observed_at")
    cycles = df.select("service_date", us.alias("as_of_us")).distinct()
    with work_tables(spark, "replay-test") as keep:
        got = {tuple(r) for r in replay.replay_scores(df, cycles, ["a", "b"], keep, 60).collect()}
    wanted = set()
    for day, at in cycles.collect():
        seen = df.where((F.col("service_date") == F.lit(day)) & (us <= at))
        is_key = F.col("stop_key").isin("a", "b")
        planned = seen.where("kind = 'planned'").withColumn("t", F.when(is_key, F.col("t")))
        as_of = (dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=at)).isoformat(sep=" ")
        scores = regularity.regularity_scores(
            headway.real_headways(seen.where("kind = 'real'").where(is_key)), headway.planned_intervals(planned), as_of, 60
        )
        wanted |= {(day, at, *tuple(r)) for r in scores.collect()}
    assert got == wanted and len(got) > 10


def test_latest_value(spark):
    rng = random.Random(5)
    notes = [("g" if rng.random() < 0.8 else "h", rng.randrange(-50, 300), rng.randrange(1000)) for _ in range(80)]
    asks = [(g, k) for g in "ghi" for k in range(-60, 320, 7)]
    got = asof.latest_value(
        spark.createDataFrame(notes, "g string, k long, v long"), spark.createDataFrame(asks, "g string, k long"), ["g"], "k", "v", 10
    )
    wanted = {(g, k, max((v for h, n, v in notes if h == g and n <= k), default=None)) for g, k in asks}
    assert {tuple(r) for r in got.collect()} == wanted


def test_between(spark):
    rows = [("g", 5, 5), ("g", 0, 40), ("g", 9, 3), ("h", -20, 100)]
    points = [("g", p) for p in (-1, 0, 5, 39, 40, 41)] + [("h", -20), ("h", 101)]
    got = asof.between(
        spark.createDataFrame(rows, "g string, low long, high long"), spark.createDataFrame(points, "g string, p long"),
        ["g"], "p", F.col("low"), F.col("high"), 10,
    ).select("g", "low", "high", "p")
    assert sorted(map(tuple, got.collect())) == sorted((*r, p) for r in rows for g, p in points if g == r[0] and r[1] <= p <= r[2])


@pytest.mark.parametrize("grow", [False, True])
def test_reference_of_all_cycles(spark, grow):
    from railcadence.operators import reference

    rng = random.Random(7)
    day, kinds = dt.date(2024, 1, 1), ["KALI", "PERA", "EMMY", "UXOL"]
    schema = "mission_type string, direction string, origin string, destination string, n_served int, service_date date, observed_us long"
    rows = [(rng.choice(kinds), "Nord", rng.choice(["x", "y", None]), rng.choice(["p", "q"]), rng.randrange(5), day, s)
            for s in (10, 20, 30, 40) for _ in range(4)]
    trips = spark.createDataFrame(rows, schema)
    cycles = [(day, s) for s in (10, 20, 30, 40)]
    newest = replay.newest_snapshots([(day, "planned", s) for s in (10, 20, 30, 40)], cycles)
    changes = replay.replay_reference(trips, None, cycles, newest, grow_stop_counts=grow).collect()
    current = None
    for _, at in cycles:
        seen = spark.createDataFrame([r for r in rows if r[6] <= at], schema).withColumnRenamed("observed_us", "observed_at")
        if current is None:
            current = reference.build_reference(seen)
        else:
            current = reference.reconcile_reference(current, reference.build_reference(seen, latest_only=True), grow_stop_counts=grow)
        wanted = {tuple(r) for r in current.collect()}
        current = spark.createDataFrame(sorted(wanted, key=str), current.schema)
        assert {tuple(r)[:5] for r in changes if r["from_us"] <= at and (r["to_us"] is None or at < r["to_us"])} == wanted, at
