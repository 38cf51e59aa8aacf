"""Gaps, drift, reference table, served rows, checks and monitoring."""

from __future__ import annotations

import datetime as dt
import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from railcadence import schema as S
from railcadence.operators import drift, gaps, latest, monitor, quality, reference, serve

T0 = dt.datetime(2026, 4, 17, 8)


def at(m):
    return T0 + dt.timedelta(minutes=m)


CALLS = "mission string, mission_type string, stop_key string, t timestamp, n_served int, observed_at timestamp"
REF = "mission_type string, direction string, origin string, destination string, n_stops int"


# ------------------------------------------------------------------------------- gaps
def test_schedule_gaps(spark, rows):
    old, new = at(-10), at(0)
    planned = spark.createDataFrame([
        ("KALI72", "KALI", "a", at(5), 2, new), ("KALI72", "KALI", "b", at(9), 2, new), ("KALI72", "KALI", "a", at(1), 2, old),
        ("LORE90", "LORE", "a", at(5), 9, new), ("PLAN01", "PLAN", "a", at(5), 1, new), ("FULL01", "FULL", "a", at(5), 4, new),
        ("NONE01", "NONE", None, None, 0, new), ("KALI99", "KALI", "a", at(5), 2, old),
    ], CALLS).withColumn("direction", F.lit("ignored"))
    real = spark.createDataFrame([
        ("KALI72", "KALI", "a", at(8), 2, at(1)), ("KALI72", "KALI", "b", at(8.4), 2, at(1)), ("LORE90", "LORE", "a", at(7), 9, at(1)),
        ("FULL01", "FULL", "a", at(6), 4, at(1)), ("NONE01", "NONE", None, None, 0, at(1)),
    ], CALLS).withColumn("direction", F.lit("ignored"))
    ref = spark.createDataFrame([
        ("KALI", "Sud", "x", "y", 20), ("LORE", "Sud", "x", "y", 9), ("LORE", "Sud", "z", "y", 10),
        ("PLAN", "Nord", "x", "y", 5), ("FULL", "Nord", "x", "y", 4), ("NONE", "Nord", "x", "y", 4),
    ], REF)
    got = gaps.schedule_gaps(planned, real, ref)
    # LORE matches by its larger row, FULL has all stops left, PLAN01 has no real side
    assert rows(got) == [("KALI72", "Sud", "a", 3), ("KALI72", "Sud", "b", -1), ("LORE90", "Sud", "a", 2),
                         ("NONE01", "Nord", None, None), ("PLAN01", "Nord", "a", None)]
    missions = gaps.mission_gaps(got)
    assert rows(missions) == [("KALI72", "Sud", 3), ("LORE90", "Sud", 2), ("NONE01", "Nord", None), ("PLAN01", "Nord", None)]
    wide = gaps.widen_gaps(got, ["a", "b", "c"])
    assert wide.columns == ["mission", "direction", "a", "b", "c", "max_gap_min"]
    assert ("KALI72", "Sud", 3, -1, None, 3) in rows(wide)
    assert rows(gaps.gap_history_rows(missions, "2026-04-17 08:00:00").drop("observed_at")) == [("KALI72", "Sud", 3), ("LORE90", "Sud", 2)]


def test_gaps_are_true_elapsed_time_over_a_clock_change(spark):
    ts = "timestamp'2026-03-29 01:58:00'", "timestamp'2026-03-29 03:03:00'"
    both = spark.sql(f"SELECT 'KALI72' mission, 'KALI' mission_type, 'a' stop_key, {ts[0]} p, {ts[1]} r, 1 n_served, {ts[0]} observed_at, '' direction")
    ref = spark.createDataFrame([("KALI", "Sud", "x", "y", 20)], REF)
    got = gaps.schedule_gaps(both.withColumnRenamed("p", "t"), both.withColumnRenamed("r", "t"), ref)
    assert got.first()["gap_min"] == 5


def test_gap_stats(spark):
    data = [("a", "Nord", 2), ("b", "Nord", -4), ("c", "Nord", 29), ("d", "Nord", 30), ("e", "Nord", None), ("f", "Nord", 5)]
    df = spark.createDataFrame(data, "mission string, direction string, max_gap_min int")
    r = gaps.gap_stats(df, "2026-04-17 08:00:00").first()
    assert (r["mean_gap"], r["median_gap"], r["max_gap"]) == (9.0, 3.5, 29)
    assert gaps.gap_stats(df.where("mission = 'd'")).count() == 0


# ------------------------------------------------------------------------------ drift
HIST = "mission string, direction string, observed_at timestamp, max_gap_min int"


def test_drift(spark, rows):
    df = spark.createDataFrame([
        ("A", "Nord", at(0), 1), ("A", "Nord", at(5), 9), ("A", "Nord", at(10.9), 4),
        ("B", "Nord", at(10.9), 7),                          # seen once: no change
        ("C", "Sud", at(0), 5), ("C", "Sud", at(5), 0),      # gone before the newest snapshot
        ("D", "Sud", at(0), None), ("D", "Sud", at(10.9), 3),
    ], HIST)
    m = drift.mission_drift(df)
    assert {r["mission"]: (r["minutes"], round(r["drift"], 6)) for r in m.collect()} == {
        "A": (10, round(3 / 11, 6)), "B": (0, 0.0), "D": (10, 0.0)}
    got = {r["direction"]: (r["n_missions"], round(r["mean_drift"], 6)) for r in drift.drift_stats(m).collect()}
    assert got == {"Nord": (2, round(3 / 22, 6)), "Sud": (1, 0.0)}
    twice = {r["direction"]: (r["n_pairs"], round(r["mean_drift"], 6)) for r in drift.drift_stats_repeated(df).collect()}
    assert twice == got


def test_drift_can_wrap_at_a_day(spark):
    df = spark.createDataFrame([("A", "Nord", at(0), 0), ("A", "Nord", at(26 * 60), 121)], HIST)
    assert drift.mission_drift(df).first()["minutes"] == 1560
    assert drift.mission_drift(df, wrap_at_day=True).first()["drift"] == 1.0


def test_repeated_history_rows_compare_all_firsts_with_all_lasts(spark):
    rng = np.random.default_rng(3)
    data = [(str(rng.choice(["A", "B", "C"])), str(rng.choice(["Nord", "Sud"])), int(rng.integers(0, 4)),
             None if rng.random() < 0.15 else int(rng.integers(-3, 20))) for _ in range(80)]
    df = spark.createDataFrame([(m, d, at(7 * k), g) for m, d, k, g in data], HIST)
    newest, sums = max(k for _, _, k, _ in data), {}
    for m, d in {(m, d) for m, d, _, _ in data}:
        seen = [k for m2, d2, k, _ in data if (m2, d2) == (m, d)]
        if max(seen) != newest:
            continue
        at_time = lambda k: [g for m2, _, k2, g in data if (m2, k2) == (m, k)]
        for a, b in itertools.product(at_time(min(seen)), at_time(max(seen))):
            change = 0 if a is None or b is None else b - a
            sums.setdefault(d, []).append(change / (7 * (max(seen) - min(seen)) + 1))
    got = {r["direction"]: (r["n_pairs"], r["mean_drift"]) for r in drift.drift_stats_repeated(df).collect()}
    assert set(got) == set(sums)
    for d, values in sums.items():
        assert got[d][0] == len(values) and abs(got[d][1] - np.mean(values)) < 1e-12


# -------------------------------------------------------------------------- reference
TRIPS = "mission_type string, direction string, origin string, destination string, n_served int, observed_at timestamp"


def test_reference_keeps_the_fullest_runs(spark, rows):
    df = spark.createDataFrame([
        ("KALI", "Sud", "a", "x", 5, at(0)), ("KALI", "Sud", "a", "x", 5, at(5)), ("KALI", "Sud", "b", "x", 5, at(0)),
        ("KALI", "Sud", "c", "x", 4, at(5)), ("LORE", "Sud", "a", "x", 3, at(0)), ("ELOI", "Nord", None, "x", 1, at(5)),
    ], TRIPS)
    assert rows(reference.build_reference(df)) == rows(spark.createDataFrame([
        ("KALI", "Sud", "a", "x", 5), ("KALI", "Sud", "b", "x", 5), ("LORE", "Sud", "a", "x", 3), ("ELOI", "Nord", None, "x", 1)], REF))
    assert rows(reference.build_reference(df, latest_only=True)) == rows(spark.createDataFrame([
        ("KALI", "Sud", "a", "x", 5), ("ELOI", "Nord", None, "x", 1)], REF))


def test_reconcile_equals_a_full_outer_join(spark, rows):
    rng = np.random.default_rng(8)

    def some(seed_codes):
        return [(str(rng.choice(seed_codes)), "Sud", None if rng.random() < 0.2 else str(rng.choice(["o1", "o2"])),
                 None if rng.random() < 0.2 else str(rng.choice(["d1", "d2"])), int(rng.integers(1, 4))) for _ in range(25)]

    cur, inc = some(["KALI", "LORE", "ELOI"]), some(["KALI", "PERA", "UPAC", "ELOI"])
    want = set()
    for c in cur:
        matches = [i for i in inc if i[0] == c[0]] or [(None,) * 5]
        want |= {tuple(a if a is not None else b for a, b in zip(c, i)) for i in matches}
    want |= {i for i in inc if i[0] not in {c[0] for c in cur}}
    fixed = {(*w[:3], S.DESTINATION_RULES.get(w[0][0], w[3]), w[4]) for w in want}
    got = reference.reconcile_reference(spark.createDataFrame(cur, REF), spark.createDataFrame(inc, REF))
    assert {tuple(r) for r in got.collect()} == fixed and got.count() == len(fixed)


def test_stop_counts_can_grow(spark):
    cur = spark.createDataFrame([("PROC", "Sud", "Palaiseau", "x", 9)], REF)
    inc = spark.createDataFrame([("PROC", "Sud", "Mitry", "x", 20)], REF)
    assert reference.reconcile_reference(cur, inc).first()["n_stops"] == 9
    r = reference.reconcile_reference(cur, inc, grow_stop_counts=True).first()
    assert (r["origin"], r["n_stops"]) == ("Palaiseau", 20)


# ------------------------------------------------------------------------ served rows
def score_history(spark):
    cols = "date_observation timestamp, direction string, " + ", ".join(f"score_{s} int" for s in S.KEY_STOPS.values())
    return spark.createDataFrame([
        (at(0), "Nord", 1, 1, 1, 1, 1, 1, 1), (at(0), "Sud", 2, 2, 2, 2, 2, 2, 2),
        (at(5), "Sud", 72, 80, None, 65, None, 70, 75), (at(5), "Nord", 90, 85, 80, 78, 88, 92, 88),
    ], cols)


def test_latest_rows_and_their_schema(spark):
    got = serve.latest_regularity(score_history(spark))
    assert got.schema.names == S.REGULARITY_ROW.names
    assert [(r["direction"], r["score_sceaux"]) for r in got.collect()] == [("Nord", 90), ("Sud", 72)]
    assert serve.for_direction(got, "Sud").first()["score_antony"] == 80
    assert serve.for_direction(got, "Est").count() == 0
    assert latest.newest_stamp(got, "date_observation").first()[0] == at(5)
    empty = score_history(spark).where("1 = 0")
    assert serve.latest_regularity(empty).count() == 0 and latest.newest_stamp(empty, "date_observation").first()[0] is None


def test_other_served_rows(spark):
    d = spark.createDataFrame([(at(0), "Nord", 0.12), (at(0), "Sud", 0.05)], "date_calcul timestamp, direction string, moyenne_allongement double")
    g = spark.createDataFrame([(at(0), "Nord", 2.5, 2.0, 8), (at(0), "Sud", 1.2, 1.0, 4)],
                              "date_observation timestamp, direction string, ecart_moyen double, ecart_median double, ecart_max int")
    assert serve.latest_drift(d).schema.names == S.DRIFT_ROW.names
    assert [f.dataType for f in serve.latest_gaps(g).schema] == [f.dataType for f in S.GAPS_ROW]
    assert [tuple(r) for r in serve.drift_cards(serve.latest_drift(d)).collect()] == [("Nord", "+ 12%"), ("Sud", "+ 5%")]
    assert [tuple(r) for r in serve.gap_cards(serve.latest_gaps(g)).collect()] == [
        ("Nord", "2.5 min", "2.0 min", "8 min"), ("Sud", "1.2 min", "1.0 min", "4 min")]


def test_score_cards(spark):
    sud = {r["label"]: (r["value"], r["band"]) for r in serve.score_cards(score_history(spark).where("direction = 'Sud' AND score_cdg1 = 70")).collect()}
    assert sud == {"Mitry-Claye": ("75", "orange"), "Saint-Rémy-lès-Ch.": ("80", "orange"), "Aéroport CDG": ("70", "orange"),
                   "Tronçon central": ("65", "red"), "Robinson": ("72", "orange")}
    none = serve.score_cards(score_history(spark).select("direction", *[F.lit(None).cast("int").alias(f"score_{s}") for s in S.KEY_STOPS.values()]))
    assert {(r["value"], r["band"]) for r in none.collect()} == {("—", "grey")}


@pytest.mark.parametrize("stamp", [at(5), at(7)])
def test_latest_snapshot_and_first_seen(spark, rows, stamp):
    df = spark.createDataFrame([("a", 1, at(0)), ("a", 2, stamp), ("a", 3, stamp), ("b", 4, at(5))], "k string, v int, observed_at timestamp")
    assert [r[0] for r in rows(latest.latest(df, "observed_at", ["k"]).select("v"))] == [2, 3, 4]
    assert [r[0] for r in rows(latest.first_seen(df, "observed_at", ["k"]).select("v"))] == [1, 4]
    newest = [2, 3, 4] if stamp == at(5) else [2, 3]
    assert [r[0] for r in rows(latest.latest(df, "observed_at").select("v"))] == newest


def test_quality_checks(spark):
    scores = score_history(spark).unionByName(score_history(spark).limit(1).withColumns({"direction": F.lit("Est"), "score_antony": F.lit(101)}))
    names = [f"score_{s}" for s in S.KEY_STOPS.values()]
    bad = {r["check"]: r["n_bad"] for r in quality.check_scores(scores, names).collect()}
    assert bad.pop("direction") == 1 and bad.pop("score_antony") == 1 and set(bad.values()) == {0}
    g = spark.createDataFrame([("Nord", 2.0, 1), ("Sud", 2.0, 2), (None, None, None)], "direction string, mean_gap double, max_gap int")
    assert {r["check"]: r["n_bad"] for r in quality.check_gaps(g).collect()} == {"direction": 1, "max_below_mean": 1}
    assert quality.missing_columns(scores, ["direction", "score_x"]) == ["score_x"]


# ------------------------------------------------------------------------- monitoring
def test_histogram_quantile(spark):
    bounds = (1.0, 2.0, 4.0)
    df = spark.createDataFrame([(2, 6, 10, 10), (0, 0, 0, 5), (0, 0, 0, 0), (10, 10, 10, 10), (0, 0, 8, 8)], "a int, b int, c int, n int")
    q = monitor.histogram_quantile(0.5, bounds, [F.col("a"), F.col("b"), F.col("c")], F.col("n"))
    assert [r[0] for r in df.select(q).collect()] == [1.75, 4.0, None, 0.5, 3.0]


def test_counter_rate_with_a_restart(spark):
    t = dt.datetime(2024, 1, 1)
    data = [(0, 10), (30, 40), (60, 5), (90, 25), (90, 20), (200, 25)]
    df = spark.createDataFrame([("api", t + dt.timedelta(seconds=s), v) for s, v in data], "name string, ts timestamp_ntz, v long")
    got = {(r["window_start"] - t).total_seconds(): r["increase"] for r in monitor.counter_rate(df, ["name"], "v").collect()}
    # increases: 30 at 0:30, 5 after the restart at 1:00, 20 at 1:30, 0 at 3:20
    assert got == {-60.0: 30, 0.0: 55, 60.0: 25, 120.0: 0, 180.0: 0}


def test_error_share_is_zero_without_errors(spark):
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(t, "200"), (t, "500"), (t + dt.timedelta(minutes=10), "200")], "ts timestamp_ntz, code string")
    got = monitor.error_percent(df, F.col("code").startswith("5"), length_min=5, step_min=5)
    assert sorted(r["error_pct"] for r in got.collect()) == [0.0, 50.0]
    assert monitor.request_rate(df, "code", length_min=5, step_min=5).agg(F.sum("per_second")).first()[0] == 3 / 300
    assert monitor.scaled_gauge(spark.createDataFrame([(3 * 1024.0 * 1024,)], "b double"), "b").first()["mb"] == 3.0
