"""Schedule gaps: real minus planned time, per mission and stop."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from railcadence import schema as S
from railcadence.functions import times
from railcadence.operators.latest import latest


def running_calls(calls: DataFrame, reference: DataFrame) -> DataFrame:
    """Calls of missions under way: fewer stops left than their type serves.

    The direction is taken from the reference. A type may have several reference
    rows; comparing with the largest stop count per type and direction keeps the
    same calls as joining all of them, without the fan-out. There is no hint: a
    stored reference is small on disk, so Spark broadcasts it after looking at
    its size.
    """
    limits = reference.groupBy("mission_type", "direction").agg(F.max("n_stops").alias("_n_stops"))
    return (
        calls.drop("direction")
        .join(limits, "mission_type")
        .where(F.col("n_served") < F.col("_n_stops"))
        .drop("_n_stops")
    )


def schedule_gaps(
    planned: DataFrame,
    real: DataFrame,
    reference: DataFrame,
    observed_at: str = "observed_at",
    latest_by: Sequence[str] | None = None,
) -> DataFrame:
    """mission, direction, stop_key, gap_min (whole minutes, positive = late).

    Each side contributes its own latest snapshot. Both go through one
    conditional aggregate; a call known on one side only has a NULL gap.
    """
    cols = ["mission", "mission_type", "stop_key", "t", "n_served"]
    both = latest(planned, observed_at, latest_by).select(*cols, F.lit("planned").alias("kind")).unionByName(
        latest(real, observed_at, latest_by).select(*cols, F.lit("real").alias("kind"))
    )
    us = times.micros(both, "t")
    return (
        running_calls(both.withColumn("_us", us), reference)
        .groupBy("mission", "direction", "stop_key")
        .agg(
            F.max(F.when(F.col("kind") == "real", F.col("_us"))).alias("_real"),
            F.max(F.when(F.col("kind") == "planned", F.col("_us"))).alias("_planned"),
        )
        .select(
            "mission", "direction", "stop_key",
            times.whole_minutes(F.col("_real"), F.col("_planned")).alias("gap_min"),
        )
    )


def mission_gaps(gaps: DataFrame) -> DataFrame:
    """Largest gap per mission; NULL if it has none."""
    return gaps.groupBy("mission", "direction").agg(F.max("gap_min").alias("max_gap_min"))


def widen_gaps(gaps: DataFrame, stop_keys: Sequence[str]) -> DataFrame:
    """One column per stop plus the mission's largest gap."""
    return gaps.groupBy("mission", "direction").agg(
        *[F.max(F.when(F.col("stop_key") == k, F.col("gap_min"))).alias(k) for k in stop_keys],
        F.max("gap_min").alias("max_gap_min"),
    )


def gap_stats(
    missions: DataFrame,
    as_of: Column | dt.datetime | str | None = None,
    cap: int = S.GAP_CAP_MIN,
    by: Sequence[str] = ("direction",),
) -> DataFrame:
    """direction, mean_gap, median_gap, max_gap over missions with a gap below ``cap``.

    Trains ahead of time count as 0. The gaps are whole minutes from 0 to
    ``cap`` - 1, so the exact median needs at most ``cap`` counters per group.
    """
    gap = F.greatest(F.lit(0), F.col("max_gap_min"))
    stats = (
        missions.where(F.col("max_gap_min").isNotNull() & (F.col("max_gap_min") < cap))
        .withColumn("_gap", gap)
        .groupBy(*by)
        .agg(
            F.avg("_gap").alias("mean_gap"),
            F.percentile("_gap", 0.5).alias("median_gap"),
            F.max("_gap").alias("max_gap"),
        )
    )
    return stamped(stats, as_of)


def stamped(df: DataFrame, as_of: Column | dt.datetime | str | None, name: str = "observed_at") -> DataFrame:
    """Put the time of the cycle in front; no change without ``as_of``."""
    if as_of is None:
        return df
    stamp = as_of if isinstance(as_of, Column) else times.literal(as_of, wall_clock=False)
    return df.select(stamp.alias(name), *df.columns)


def gap_history_rows(missions: DataFrame, as_of: Column | dt.datetime | str) -> DataFrame:
    """Rows a cycle adds to the gap history: missions with a known gap."""
    return stamped(missions.where(F.col("max_gap_min").isNotNull()), as_of)
