"""Regularity scores: how far real headways stretch beyond the planned ones."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from railcadence import schema as S
from railcadence.functions import times

# A ratio of whole minutes kept as a decimal: sums do not depend on row order.
_RATIO = "decimal(28,12)"


def due_within(df: DataFrame, as_of: Column | dt.datetime | str, horizon_min: float, t: str = "t") -> DataFrame:
    """Rows due from ``as_of`` to ``as_of`` + horizon, both ends included."""
    start = times.literal_like(df, t, as_of)
    return df.where(F.col(t).between(start, start + times.minutes_horizon(horizon_min)))


PAIR_KEY = ("mission", "direction", "stop_key")


def headway_pairs(real: DataFrame, planned: DataFrame, on: Sequence[str] = PAIR_KEY) -> DataFrame:
    """Real and planned headway of the same mission at the same stop, and the
    relative excess of the real one. Bunched trains have excess 0."""
    p = planned.where(F.col("headway_min") > 0).select(*on, F.col("headway_min").alias("planned_min"))
    r = real.where(F.col("headway_min").isNotNull()).withColumnRenamed("headway_min", "real_min")
    ratio = (F.col("real_min") - F.col("planned_min")) / F.col("planned_min").cast("double")
    return r.join(p, list(on)).withColumn(
        "excess", F.greatest(F.lit(0.0), ratio).cast(_RATIO)
    )


def score_columns(total: Column, n: Column) -> dict[str, Column]:
    """n_pairs, avg_excess and score from a summed excess.

    The score is rounded half up from the exact decimal sum: at a tie the numerator is a
    whole multiple of 2 n, so the quotient is exact.
    """
    avg = total.cast("double") / n
    pairs = n.cast("decimal(15,0)")
    halves = ((pairs - total.cast("decimal(30,12)")) * 200 + pairs).cast("double")
    return {
        "n_pairs": n,
        "avg_excess": F.round(avg, 9),
        "score": F.greatest(F.lit(0), F.floor(halves / (2 * n)).cast("int")),
    }


def regularity_scores(
    real: DataFrame,
    planned: DataFrame,
    as_of: Column | dt.datetime | str,
    horizon_min: float = S.HORIZON_MINUTES,
    by: Sequence[str] = ("direction", "stop_key"),
    on: Sequence[str] = PAIR_KEY,
) -> DataFrame:
    """direction, stop_key, n_pairs, avg_excess, score; no row where no pair qualifies.

    Missions must carry the same direction on both sides. The time filter runs
    on the real side before the join.
    """
    pairs = headway_pairs(due_within(real, as_of, horizon_min), planned, on)
    sums = pairs.groupBy(*by).agg(F.sum("excess").alias("_total"), F.count("*").alias("_n"))
    return sums.select(*by, *[c.alias(k) for k, c in score_columns(F.col("_total"), F.col("_n")).items()])


def widen_scores(
    scores: DataFrame,
    stops: Mapping[str, str] = S.KEY_STOPS,
    by: Sequence[str] = ("direction",),
    prefix: str = "score_",
) -> DataFrame:
    """One column per key stop, NULL where there is no score."""
    return scores.groupBy(*by).agg(*[
        F.max(F.when(F.col("stop_key") == key, F.col("score"))).alias(f"{prefix}{short}")
        for key, short in stops.items()
    ])


def rolling_scores(
    real: DataFrame,
    planned: DataFrame,
    every_min: int = 5,
    horizon_min: int = S.HORIZON_MINUTES,
    by: Sequence[str] = ("direction", "stop_key"),
    on: Sequence[str] = PAIR_KEY,
) -> DataFrame:
    """The score of every cycle at once: cycle_at, direction, stop_key, n_pairs, ...

    A cycle at time c covers trains due in [c, c + horizon]. Pairs are summed per
    pane of ``every_min`` first; only panes are copied to the cycles they belong
    to. A train due exactly on a cycle time also counts for the cycle that ends
    there, so panes keep those trains apart.
    """
    if horizon_min % every_min:
        raise ValueError("the horizon must be a multiple of the cycle length")
    pane_us = every_min * times.MICROS_PER_MINUTE
    pairs = headway_pairs(real, planned, on).withColumn("_us", times.micros(real, "t"))
    panes = (
        pairs
        .withColumn("_pane", F.floor(F.col("_us") / F.lit(float(pane_us))).cast("bigint"))
        .withColumn("_on_edge", F.col("_us") == F.col("_pane") * pane_us)
        .groupBy(*by, "_pane", "_on_edge")
        .agg(F.sum("excess").alias("_total"), F.count("*").alias("_n"))
    )
    reach = horizon_min // every_min
    earliest = F.col("_pane") - F.when(F.col("_on_edge"), reach).otherwise(reach - 1)
    cycles = (
        panes.withColumn("_cycle", F.explode(F.sequence(earliest, F.col("_pane"))))
        .groupBy(*by, "_cycle")
        .agg(F.sum("_total").alias("_total"), F.sum("_n").alias("_n"))
        .withColumn("_us", F.col("_cycle") * pane_us)
    )
    return cycles.select(
        times.from_micros("_us", times.is_wall_clock(real, "t")).alias("cycle_at"),
        *by,
        *[c.alias(k) for k, c in score_columns(F.col("_total"), F.col("_n")).items()],
    )
