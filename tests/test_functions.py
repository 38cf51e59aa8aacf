from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from railcadence.functions import display, text, times


@pytest.mark.parametrize("ref, expected", [
    ("STIF:StopArea:SP:43186:", 43186), ("STIF:StopArea:SP:1:", 1), ("broken", None), ("a:b:", None), (None, None),
])
def test_stop_id(one, ref, expected):
    assert one(text.stop_id(F.col("v")), "v string", ref) == expected


def test_directions(one):
    for letter in "EIJOQNMGA":
        assert one(text.direction(F.col("v")), "v string", letter + "LOI") == "Nord"
    for letter in "KPUSBe":
        assert one(text.direction(F.col("v")), "v string", letter + "LOI") == "Sud"
    assert one(text.direction(F.col("v"), "EIJOQNGA"), "v string", "MOKA") == "Sud"
    assert one(text.mission_type(F.col("v")), "v string", "KALI72") == "KALI"


@pytest.mark.parametrize("name, key", [
    ("Rémy", "remy"), ("saint-remy", "saint_remy"), ("gare depart", "gare_depart"),
    ("heure (depart)", "heure"), ("GARE", "gare"), ("gare__depart", "gare_depart"), ("_gare_", "gare"),
    ("Saint-Rémy-lès-Chevreuse", "saint_remy_les_chevreuse"), ("a (b) c (d)", "a_c"),
    ("ﬁn ² Ångström", "fin_2_angstrom"), ("l'Haÿ", "lhay"), ("!?", ""), ("x(\n)y", "xy"),
    ("Aéroport CDG 1 (RER)", "aeroport_cdg_1"), (None, None),
])
def test_normalize_key(one, name, key):
    assert one(text.normalize_key(F.col("v")), "v string", name) == key


def test_corrected_destination(one):
    got = [one(text.corrected_destination(F.col("v"), F.lit("elsewhere")), "v string", c) for c in ("KALI", "PERA", "UPAC", "EURO")]
    assert got == ["Massy - Palaiseau", "Saint Rémy-lès-Chevreuse", "Laplace", "elsewhere"]


def test_instants_and_wall_clocks_differ_over_a_clock_change(spark):
    df = spark.sql("""SELECT timestamp'2026-03-29 01:55:00' a, timestamp'2026-03-29 03:05:00' b,
                             timestamp_ntz'2026-03-29 01:55:00' c, timestamp_ntz'2026-03-29 03:05:00' d""")
    got = df.select(
        times.whole_minutes(times.micros(df, "b"), times.micros(df, "a")),
        times.whole_minutes(times.micros(df, "d"), times.micros(df, "c")),
    ).first()
    assert tuple(got) == (10, 70)


def test_micros_of_a_wall_clock_need_no_zone(spark):
    # 02:30 does not exist in Paris on that day
    df = spark.sql("SELECT timestamp_ntz'2024-03-31 02:30:00.123456' a UNION ALL SELECT timestamp_ntz'1965-01-02 03:04:05.000007'")
    us = df.select("a", times.micros(df, "a").alias("us")).withColumn("back", times.from_micros("us", True))
    for r in us.collect():
        assert r["us"] == (r["a"] - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)
        assert r["back"] == r["a"]


def test_minutes_round_half_away_from_zero(spark):
    df = spark.createDataFrame([(30,), (90,), (-30,), (-90,), (29,), (89,), (-29,)], "s long")
    got = [r[0] for r in df.select(times.whole_minutes(F.col("s") * 1_000_000, F.lit(0))).collect()]
    assert got == [1, 2, -1, -2, 0, 1, 0]


def test_elapsed_minutes_can_wrap_at_a_day(spark):
    df = spark.createDataFrame([((26 * 60 + 3) * 60_000_000 + 59_000_000,)], "us long")
    got = df.select(times.elapsed_minutes(F.col("us"), F.lit(0)), times.elapsed_minutes(F.col("us"), F.lit(0), True)).first()
    assert tuple(got) == (26 * 60 + 3, 2 * 60 + 3)


@pytest.mark.parametrize("value, us", [
    ("2026-04-15T08:00:00Z", 1776240000000000), ("2026-04-15 08:00:00", 1776240000000000),
    ("2026-04-15 10:00:00+02:00", 1776240000000000), ("2026-04-15", 1776211200000000),
    ("soon", None), ("", None), (None, None),
])
def test_parse_instant_utc(one, value, us):
    assert one(F.unix_micros(times.parse_instant_utc("v")), "v string", value) == us


@pytest.mark.parametrize("score, band", [(100, "green"), (85, "green"), (84, "orange"), (70, "orange"), (69, "red"), (0, "red"), (None, "grey")])
def test_band(one, score, band):
    assert one(display.band(F.col("v")), "v int", score) == band


def test_texts_round_like_python(spark):
    rng = np.random.default_rng(7)
    values = [float(a) / float(b) for a, b in zip(rng.integers(0, 900, 400), rng.integers(1, 41, 400))]
    values += [0.25, 0.75, 0.35, 1.15, 2.35, 0.05, 12345.25, 0.125, 0.005, 2.5, 3.5]
    df = spark.createDataFrame([(v,) for v in values], "v double").select(
        "v", display.minutes_text(F.col("v")).alias("m1"), display.minutes_text(F.col("v"), 0).alias("m0"),
        display.drift_text(F.col("v") - 5).alias("d"),
    )
    for r in df.collect():
        v = r["v"]
        assert r["m1"] == f"{v:.1f} min"
        assert r["m0"] == f"{v:.0f} min"
        assert r["d"] == f"+ {max(0, round((v - 5) * 100))}%"


def test_missing_values_have_a_text(one):
    assert one(display.minutes_text(F.col("v")), "v double", None) == "—"
    assert one(display.drift_text(F.col("v")), "v double", None) == "+ —"
    assert one(display.score_text(F.col("v")), "v int", None) == "—"
    assert one(display.stamp_text(F.col("v")), "v timestamp", None) == "—"
    assert one(display.stamp_text(F.col("v").cast("timestamp_ntz")), "v string", "2026-04-17 08:10:03") == "17/04/2026 08:10"
