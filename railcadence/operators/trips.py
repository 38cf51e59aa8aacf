"""One row per trip from its calls."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def trip_summary(
    calls: DataFrame,
    by: Sequence[str],
    t: str = "t",
    stop: str = "stop_key",
    order: Sequence[str] = ("stop_seq",),
) -> DataFrame:
    """Origin (earliest call, ties to the first stop), number of timed calls, end time.

    Trips without any timed call stay, with NULL origin and 0 calls.
    """
    timed = F.col(t).isNotNull()
    first = F.min(F.when(timed, F.struct(t, *order, stop))).alias("_first")
    return (
        calls.groupBy(*by)
        .agg(first, F.count(t).cast("int").alias("n_served"), F.max(t).alias("ends_at"))
        .withColumn("origin", F.col("_first")[stop])
        .select(*by, "origin", "n_served", "ends_at")
    )


def trips_of(passages: DataFrame, *more: str) -> DataFrame:
    """Trips of parsed passages. Each call repeats its trip's values, so the
    first call stands for the trip and nothing is aggregated."""
    return passages.where(F.col("call_pos") == 0).select(
        "mission", "mission_type", "direction", "origin", "destination", "kind",
        "n_served", "ends_at", "observed_at", *more,
    )
