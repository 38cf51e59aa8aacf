from __future__ import annotations

import datetime as dt

import numpy as np

from pyspark.sql import functions as F

from railcadence.operators import regularity

NOON = dt.datetime(2026, 4, 17, 12)


def at(m):
    return NOON + dt.timedelta(minutes=m)


REAL = "mission string, direction string, stop_key string, t timestamp_ntz, headway_min int"
PLANNED = "mission string, direction string, stop_key string, headway_min int"


def test_score_is_the_mean_excess_over_the_planned_headway(spark, rows):
    real = spark.createDataFrame([
        ("A", "Nord", "s", at(5), 6), ("B", "Nord", "s", at(10), 2), ("C", "Nord", "s", at(15), 9),
        ("D", "Nord", "s", at(20), 30), ("E", "Sud", "s", at(5), None), ("F", "Nord", "s", at(25), 4),
    ], REAL)
    planned = spark.createDataFrame([
        ("A", "Nord", "s", 5), ("B", "Nord", "s", 5), ("C", "Nord", "s", 6),
        ("D", "Nord", "s", 0), ("E", "Sud", "s", 5), ("F", "Nord", "s", None),
    ], PLANNED)
    # excess: A 0.2, B bunched 0, C 0.5; D has no planned interval, E no real one, F no plan
    [(direction, stop, n, avg, score)] = rows(regularity.regularity_scores(real, planned, NOON, 60))
    assert (direction, stop, n, score) == ("Nord", "s", 3, 77)
    assert abs(avg - 0.7 / 3) < 1e-9


def test_both_ends_of_the_horizon_count(spark):
    real = spark.createDataFrame([(str(m), "Nord", "s", at(m), 5) for m in (-0.01, 0, 60, 60.01)], REAL)
    assert sorted(r["mission"] for r in regularity.due_within(real, NOON, 60).collect()) == ["0", "60"]


def test_score_is_never_negative_and_absent_without_pairs(spark, rows):
    real = spark.createDataFrame([("A", "Nord", "x", at(1), 100), ("B", "Sud", "y", at(90), 5)], REAL)
    planned = spark.createDataFrame([("A", "Nord", "x", 5), ("B", "Sud", "y", 5)], PLANNED)
    scores = regularity.regularity_scores(real, planned, NOON, 60)
    assert [r["score"] for r in scores.collect()] == [0]
    wide = regularity.widen_scores(scores, {"x": "x", "y": "y"})
    assert wide.columns == ["direction", "score_x", "score_y"]
    assert rows(wide) == [("Nord", 0, None)]


def test_rolling_scores_equal_one_call_per_cycle(spark, rows):
    rng = np.random.default_rng(5)
    offsets = [*rng.integers(0, 200, 60).tolist(), 0, 5, 60, 65, 120.5]
    real = spark.createDataFrame(
        [(f"M{i}", "Nord" if i % 3 else "Sud", "s", at(m), int(rng.integers(0, 20))) for i, m in enumerate(offsets)], REAL)
    planned = spark.createDataFrame(
        [(f"M{i}", "Nord" if i % 3 else "Sud", "s", int(rng.integers(1, 12))) for i in range(len(offsets))], PLANNED)
    rolling = regularity.rolling_scores(real, planned, 5, 60).cache()
    for m in (-60, -55, -5, 0, 5, 60, 100, 195):
        got = rows(rolling.where(F.col("cycle_at") == F.lit(at(m).isoformat(sep=" ")).cast("timestamp_ntz")).drop("cycle_at"))
        assert got == rows(regularity.regularity_scores(real, planned, at(m), 60))
    rolling.unpersist()


def test_half_ties_round_up_from_the_exact_sum(spark):
    cases = {33: [(2, 1), (27, 20)], 50: [(3, 2), (3, 2)], 63: [(7, 4), (4, 4)], 0: [(9, 1), (1, 1)], 83: [(4, 3), (1, 1)]}
    real = [(f"{k}-{i}", "Nord", str(k), at(1), r) for k, c in cases.items() for i, (r, _) in enumerate(c)]
    planned = [(f"{k}-{i}", "Nord", str(k), p) for k, c in cases.items() for i, (_, p) in enumerate(c)]
    got = regularity.regularity_scores(spark.createDataFrame(real, REAL), spark.createDataFrame(planned, PLANNED), NOON, 60)
    assert {int(r["stop_key"]): r["score"] for r in got.collect()} == {k: k for k in cases}
