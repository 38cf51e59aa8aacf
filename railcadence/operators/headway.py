"""Headways: minutes to the previous train at the same stop and direction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from railcadence.functions import times
from railcadence.operators import ordered as O

GROUP = ("direction", "stop_key")


def headways_of(
    calls: DataFrame,
    group: Sequence[str] = GROUP,
    train: str = "mission",
    t: str = "t",
    slice_seconds: float = O.SLICE_SECONDS,
) -> DataFrame:
    """Add ``headway_min`` to calls that are unique by group, train and time.

    Calls are ordered by time and then by ``train``. Of the calls at one instant the
    first one has the headway of the instant; the others follow by 0 minutes. So
    very many trains at one instant never meet in a task: instants are an aggregate,
    and the join that brings them back to the calls is keyed by train too.
    """
    rows = calls.withColumn("_us", times.micros(calls, t))
    leading = leading_headways(rows, group, train, "_us", slice_seconds).select(
        *group, "_us", train, F.col("headway_min").alias("_lead_min"), F.lit(True).alias("_leads")
    )
    headway = F.when(F.col("_leads"), F.col("_lead_min")).otherwise(F.lit(0))
    return rows.join(leading, [*group, "_us", train], "left").select(*calls.columns, headway.alias("headway_min"))


def leading_headways(
    rows: DataFrame, group: Sequence[str], train: str, us: str, slice_seconds: float = O.SLICE_SECONDS
) -> DataFrame:
    """group, train, ``us``, headway_min: the first train of every instant."""
    instants = rows.groupBy(*group, us).agg(F.min(train).alias(train))
    minutes = times.whole_minutes(F.col(us), F.col(f"prev_{us}"))
    return O.with_previous(instants, group, us, slice_seconds=slice_seconds).select(
        *group, train, us, minutes.alias("headway_min")
    )


def _usable(passages: DataFrame, group: Sequence[str]) -> DataFrame:
    """Passages with a time, a train and a place. Stating it here, once, lets every
    later use of the calls share one scan and one shuffle."""
    return passages.where(O.all_known("mission", *group, "t"))


def real_calls(passages: DataFrame, group: Sequence[str] = GROUP) -> DataFrame:
    """Latest known real time per mission and stop."""
    return _usable(passages, group).groupBy("mission", *group).agg(F.max("t").alias("t"))


def planned_calls(
    passages: DataFrame,
    group: Sequence[str] = GROUP,
    per: Sequence[str] = ("mission",),
    observed_at: str = "observed_at",
    with_copies: bool = False,
) -> DataFrame:
    """Planned times from the first snapshot in which each mission was seen.

    A call belongs to that snapshot exactly if its own first sighting is the
    mission's. So calls are aggregated first: a planned time repeats in snapshot
    after snapshot, and the repeats combine before any row is shuffled.
    ``copies`` counts identical calls within the first snapshot.
    """
    key = ["mission", *group, "t"]
    timed = _usable(passages, group)
    sighting = [F.min(observed_at).alias(observed_at)]
    if with_copies:
        timed = timed.groupBy(*key, observed_at).agg(F.count("*").alias("copies"))
        sighting.append(F.min_by("copies", observed_at).alias("copies"))
    # a mission first listed without any time still had its first sighting then
    first = passages.groupBy(*per).agg(F.min(observed_at).alias(observed_at))
    calls = timed.groupBy(*key).agg(*sighting)
    return calls.join(first, [*per, observed_at], "left_semi").drop(observed_at)


def real_headways(passages: DataFrame, group: Sequence[str] = GROUP, **tuning) -> DataFrame:
    """mission, direction, stop_key, t, headway_min for the latest real times."""
    calls = real_calls(passages, group)
    return headways_of(calls, group, **tuning).select("mission", *group, "t", "headway_min")


def planned_headways(
    passages: DataFrame, group: Sequence[str] = GROUP, per: Sequence[str] = ("mission",), **tuning
) -> DataFrame:
    """mission, direction, stop_key, t, headway_min, copies for the first planned times.

    ``headway_min`` is that of the first copy; further copies follow by 0 minutes.
    """
    calls = planned_calls(passages, group, per, with_copies=True)
    return headways_of(calls, group, **tuning).select(
        "mission", *group, "t", "headway_min", "copies"
    )


def planned_intervals(
    passages: DataFrame, group: Sequence[str] = GROUP, per: Sequence[str] = ("mission",), **tuning
) -> DataFrame:
    """Planned headways a score can divide by, those above 0 minutes: mission,
    direction, stop_key, headway_min. Only the first train of an instant can have one,
    and copies cannot matter."""
    calls = planned_calls(passages, group, per)
    rows = calls.withColumn("_us", times.micros(calls, "t"))
    return leading_headways(rows, group, "mission", "_us", **tuning).where(F.col("headway_min") > 0).select(
        "mission", *group, "headway_min"
    )
