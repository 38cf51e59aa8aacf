from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from railcadence.operators import headway
from railcadence.operators.ordered import with_previous

DAY = dt.datetime(2026, 4, 17)


def at(seconds):
    return DAY + dt.timedelta(seconds=float(seconds))


def minutes(later, earlier):
    """Half away from zero."""
    m = (later - earlier).total_seconds() / 60
    return int(np.floor(m + 0.5))


def brute(calls):
    """calls: (mission, direction, stop, t) -> multiset of (mission, direction, stop, t, headway)."""
    out, groups = [], {}
    for c in calls:
        groups.setdefault(c[1:3], []).append(c)
    for members in groups.values():
        prev = None
        for c in sorted(members, key=lambda c: (c[3], c[0])):
            out.append((*c, None if prev is None else minutes(c[3], prev)))
            prev = c[3]
    return sorted(out, key=str)


def random_calls(seed, n, span, resolution):
    """Two thirds of the calls in one group, a third of them at one instant."""
    rng = np.random.default_rng(seed)
    calls = {}
    for i in range(n):
        group = ("Nord", "chatelet") if rng.random() < 0.66 else (str(rng.choice(["Nord", "Sud"])), str(rng.choice(["antony", "massy"])))
        s = 1000 if rng.random() < 0.33 else float(rng.integers(0, span)) * resolution
        calls[(f"M{i:04d}", *group)] = at(s)
    return [(*k, t) for k, t in calls.items()]


@pytest.mark.parametrize("seed, n, span, resolution, width", [
    (1, 300, 200, 1.0, 60), (2, 300, 86400, 1.0, 60), (3, 200, 10**7, 0.001, 7), (4, 200, 5000, 1.0, 1), (5, 50, 20, 90.0, 3600),
])
def test_real_headways_equal_lag_over_the_whole_group(spark, seed, n, span, resolution, width):
    calls = random_calls(seed, n, span, resolution)
    df = spark.createDataFrame(calls, "mission string, direction string, stop_key string, t timestamp_ntz")
    got = headway.real_headways(df.repartition(7), slice_seconds=width)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(calls)


def test_crowded_instants_give_the_same_headways(spark):
    calls = random_calls(21, 400, 900, 1.0) + [(f"X{i}", "Sud", "gentilly", at(i)) for i in range(30)]
    df = spark.createDataFrame(calls, "mission string, direction string, stop_key string, t timestamp_ntz")
    got = headway.real_headways(df.repartition(5), slice_seconds=30)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(calls)
    # the same trains again a little later: planned calls repeat a train
    twice = calls + [(m, d, s, t + dt.timedelta(seconds=20)) for m, d, s, t in calls]
    planned = planned_frame(spark, [(*c, at(-60)) for c in twice])
    got = headway.planned_headways(planned, slice_seconds=30).drop("copies")
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(twice)
    positive = headway.planned_intervals(planned, slice_seconds=30)
    assert sorted((tuple(r) for r in positive.collect()), key=str) == sorted(
        ((m, d, s, h) for m, d, s, _, h in brute(twice) if h), key=str)


def test_all_trains_at_one_instant(spark):
    calls = [(f"M{i:03d}", "Nord", "s", at(0)) for i in range(200)]
    df = spark.createDataFrame(calls, "mission string, direction string, stop_key string, t timestamp_ntz")
    got = headway.real_headways(df)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(calls)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" not in plan.lower()  # no hint, whatever the size


def test_order_of_rows_and_partitions_does_not_matter(spark):
    df = spark.createDataFrame(random_calls(9, 150, 3000, 1.0), "mission string, direction string, stop_key string, t timestamp_ntz")
    results = [
        sorted((tuple(r) for r in headway.real_headways(d).collect()), key=str)
        for d in (df, df.orderBy(F.rand(3)).repartition(3))
    ]
    assert results[0] == results[1]


def test_real_headways_use_the_latest_time_and_ignore_missing_ones(spark, rows):
    df = spark.createDataFrame([
        ("A", "Nord", "s", at(0)), ("A", "Nord", "s", at(60)), ("B", "Nord", "s", at(300)), ("C", "Nord", "s", None), ("D", "Sud", "s", at(10)),
    ], "mission string, direction string, stop_key string, t timestamp_ntz")
    assert rows(headway.real_headways(df)) == [
        ("A", "Nord", "s", at(60), None), ("B", "Nord", "s", at(300), 4), ("D", "Sud", "s", at(10), None),
    ]


def planned_frame(spark, data):
    return spark.createDataFrame(data, "mission string, direction string, stop_key string, t timestamp_ntz, observed_at timestamp_ntz")


def test_planned_headways_keep_the_first_snapshot_of_each_mission(spark, rows):
    o1, o2 = at(-600), at(-300)
    df = planned_frame(spark, [
        ("A", "Nord", "s", at(0), o1), ("A", "Nord", "s", at(30), o2),          # later plan is ignored
        ("B", "Nord", "s", at(120), o2),                                         # first seen later
        ("B", "Nord", "s", at(120), o2),                                         # a copy in the same snapshot
        ("C", "Nord", "s", None, o1), ("C", "Nord", "s", at(240), o2),          # listed without a time first
        ("D", "Nord", "s", at(360), o1), ("D", "Nord", "s", at(420), o1),       # two calls in one snapshot
    ])
    assert rows(headway.planned_headways(df)) == [
        ("A", "Nord", "s", at(0), None, 1), ("B", "Nord", "s", at(120), 2, 2),
        ("D", "Nord", "s", at(360), 4, 1), ("D", "Nord", "s", at(420), 1, 1),
    ]


def test_planned_intervals_are_the_positive_planned_headways(spark, rows):
    calls = random_calls(11, 200, 4000, 1.0)
    df = planned_frame(spark, [(*c, at(-60)) for c in calls])
    full = headway.planned_headways(df).where("headway_min > 0").select("mission", "direction", "stop_key", "headway_min")
    assert rows(headway.planned_intervals(df)) == rows(full)


def test_with_previous_carries_values_and_handles_empty_slices(spark, rows):
    df = spark.createDataFrame(
        [("a", 0, 1), ("a", 5_000_000, 2), ("a", 3_600_000_000, 3), ("b", -1, 4), ("b", 1, 5)], "g string, us long, v int"
    )
    got = with_previous(df, ["g"], "us", ["v"], slice_seconds=10).select("g", "us", "v", "prev_us", "prev_v")
    assert rows(got) == [
        ("a", 0, 1, None, None), ("a", 3_600_000_000, 3, 5_000_000, 2), ("a", 5_000_000, 2, 0, 1),
        ("b", -1, 4, None, None), ("b", 1, 5, -1, 4),
    ]


def test_no_window_holds_a_whole_group(spark):
    df = spark.createDataFrame([("A", "Nord", "s", at(0))], "mission string, direction string, stop_key string, t timestamp_ntz")
    plan = headway.real_headways(df)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows
    for line in windows:
        # either inside one slice, or over one row per slice
        assert "_slice" in line
