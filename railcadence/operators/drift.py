"""Journey drift: does a train lose more time the longer it runs?"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from railcadence.functions import times


def mission_drift(
    history: DataFrame,
    observed_at: str = "observed_at",
    gap: str = "max_gap_min",
    wrap_at_day: bool = False,
) -> DataFrame:
    """First and last gap of every mission still seen in the newest snapshot.

    mission, direction, first_at, last_at, first_gap, last_gap, minutes,
    drift = (last_gap - first_gap) / (minutes + 1). One aggregate; expects one
    row per mission and stamp (see :func:`drift_stats_repeated` otherwise).
    """
    us = times.micros(history, observed_at)
    spans = history.withColumn("_us", us).groupBy("mission", "direction").agg(
        F.min(observed_at).alias("first_at"),
        F.max(observed_at).alias("last_at"),
        F.min("_us").alias("_first_us"),
        F.max("_us").alias("_last_us"),
        F.min_by(gap, observed_at).alias("first_gap"),
        F.max_by(gap, observed_at).alias("last_gap"),
    )
    newest = history.agg(F.max(observed_at)).scalar()
    minutes = times.elapsed_minutes(F.col("_last_us"), F.col("_first_us"), wrap_at_day)
    change = F.coalesce(F.col("last_gap") - F.col("first_gap"), F.lit(0))
    return (
        spans.where(F.col("last_at") == newest)
        .withColumn("minutes", minutes)
        .withColumn("drift", change / (F.col("minutes") + 1))
        .drop("_first_us", "_last_us")
    )


def drift_stats(drift: DataFrame, by: Sequence[str] = ("direction",)) -> DataFrame:
    """Mean drift of the running missions per direction."""
    return drift.groupBy(*by).agg(
        F.count("*").alias("n_missions"), (_exact_sum("drift") / F.count("drift")).alias("mean_drift")
    )


def _exact_sum(col: str) -> Column:
    """Sum of a ratio, added up as decimals: it does not depend on row order."""
    return F.sum(F.col(col).cast("decimal(28,12)")).cast("double")


def drift_stats_repeated(
    history: DataFrame,
    observed_at: str = "observed_at",
    gap: str = "max_gap_min",
    wrap_at_day: bool = False,
) -> DataFrame:
    """:func:`drift_stats` for a history in which (mission, stamp) may repeat.

    Every first row of a mission is then compared with every last one, whatever
    their direction. The mean over those pairs follows from counts and sums at
    both ends, so no pair is ever built:

        sum over pairs (last - first) = n_first * sum_last - n_last * sum_first
        number of pairs               = rows_first * rows_last
    """
    at_stamp = (
        history.groupBy("mission", observed_at)
        .agg(
            F.count("*").alias("rows"),
            F.count(gap).alias("n"),
            F.coalesce(F.sum(gap), F.lit(0)).alias("total"),
            F.collect_set("direction").alias("directions"),
        )
        .withColumn("direction", F.explode("directions"))
    )
    ends = F.struct("rows", "n", "total")
    spans = at_stamp.withColumn("_us", times.micros(at_stamp, observed_at)).groupBy("mission", "direction").agg(
        F.max(observed_at).alias("last_at"),
        F.min("_us").alias("_first_us"),
        F.max("_us").alias("_last_us"),
        F.min_by(ends, observed_at).alias("a"),
        F.max_by(ends, observed_at).alias("b"),
    )
    newest = history.agg(F.max(observed_at)).scalar()
    minutes = times.elapsed_minutes(F.col("_last_us"), F.col("_first_us"), wrap_at_day)
    change = F.col("a.n") * F.col("b.total") - F.col("b.n") * F.col("a.total")
    return (
        spans.where(F.col("last_at") == newest)
        .select(
            "direction",
            (F.col("a.rows") * F.col("b.rows")).alias("_pairs"),
            (change / (minutes + 1)).alias("_drift"),
        )
        .groupBy("direction")
        .agg(
            F.sum("_pairs").alias("n_pairs"),
            (_exact_sum("_drift") / F.sum("_pairs")).alias("mean_drift"),
        )
    )
