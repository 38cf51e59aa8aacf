"""Request monitoring on any timestamped event table.

Sliding windows are built from panes: events are counted once per pane of one
step, combined before the shuffle, and only panes are copied to the windows
they belong to. A window starts on a step and covers [start, start + length).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from railcadence.functions import times
from railcadence.operators.ordered import SLICE_SECONDS, with_previous

# Upper bounds of the latency buckets; one more bucket takes everything above.
LATENCY_BUCKETS = (1.0, 5.0, 10.0, 25.0, 50.0, 100.0, 250.0, 500.0)


def sliding_sums(
    events: DataFrame,
    keys: Sequence[str],
    sums: dict[str, Column],
    ts: str = "ts",
    length_min: int = 5,
    step_min: int = 1,
) -> DataFrame:
    """window_start, keys and one summed aggregate per entry of ``sums``.

    Each entry must be an aggregate that may be summed over panes (count, sum).
    """
    if length_min % step_min:
        raise ValueError("the window length must be a multiple of the step")
    wall_clock = times.is_wall_clock(events, ts)
    step_us = step_min * times.MICROS_PER_MINUTE
    panes = (
        events.withColumn("_pane", F.floor(times.micros(events, ts) / F.lit(float(step_us))).cast("bigint"))
        .groupBy(*keys, "_pane")
        .agg(*[agg.alias(name) for name, agg in sums.items()])
    )
    reach = length_min // step_min
    if reach > 1:
        panes = panes.withColumn("_pane", F.explode(F.sequence(F.col("_pane") - (reach - 1), F.col("_pane"))))
        panes = panes.groupBy(*keys, "_pane").agg(*[F.sum(name).alias(name) for name in sums])
    return panes.withColumn("_us", F.col("_pane") * step_us).select(
        times.from_micros("_us", wall_clock).alias("window_start"), *keys, *sums
    )


def histogram_quantile(q: float, bounds: Sequence[float], cumulative: Sequence[Column], total: Column) -> Column:
    """Quantile from cumulative bucket counts, linear within a bucket.

    Buckets start at 0. Above the last bound the answer is that bound. NULL
    without observations.
    """
    rank = F.lit(q) * total
    out = None
    for i, upper in enumerate(bounds):
        lower = F.lit(0.0) if i == 0 else F.lit(float(bounds[i - 1]))
        below = F.lit(0) if i == 0 else cumulative[i - 1]
        share = (rank - below) / (cumulative[i] - below)
        value = lower + (F.lit(float(upper)) - lower) * share
        reached = (cumulative[i] >= rank) & (total > 0)
        out = F.when(reached, value) if out is None else out.when(reached, value)
    return out.when(total > 0, F.lit(float(bounds[-1])))


def latency_quantile(
    events: DataFrame,
    key: str,
    value: str,
    q: float = 0.95,
    bounds: Sequence[float] = LATENCY_BUCKETS,
    ts: str = "ts",
    length_min: int = 5,
    step_min: int = 1,
) -> DataFrame:
    """Quantile per key and window, from bucket counts of fixed number."""
    names = [f"_le{i}" for i in range(len(bounds))]
    sums = {n: F.count_if(F.col(value) <= float(b)) for n, b in zip(names, bounds)}
    sums["n"] = F.count(value)
    windows = sliding_sums(events, [key], sums, ts, length_min, step_min)
    quantile = histogram_quantile(q, bounds, [F.col(n) for n in names], F.col("n"))
    return windows.select("window_start", key, "n", quantile.alias("quantile"))


def request_rate(
    events: DataFrame, key: str, ts: str = "ts", length_min: int = 5, step_min: int = 1
) -> DataFrame:
    """Events per second, key and window."""
    windows = sliding_sums(events, [key], {"n": F.count("*")}, ts, length_min, step_min)
    return windows.select("window_start", key, (F.col("n") / (length_min * 60.0)).alias("per_second"))


def error_percent(
    events: DataFrame, is_error: Column, ts: str = "ts", length_min: int = 5, step_min: int = 1
) -> DataFrame:
    """Share of errors per window in percent; 0 where there is no error."""
    sums = {"n": F.count("*"), "n_errors": F.count_if(is_error)}
    windows = sliding_sums(events, [], sums, ts, length_min, step_min)
    return windows.select("window_start", "n", (100.0 * F.col("n_errors") / F.col("n")).alias("error_pct"))


def counter_rate(
    samples: DataFrame,
    series: Sequence[str],
    value: str,
    ts: str = "ts",
    length_min: int = 2,
    step_min: int = 1,
    slice_seconds: int = SLICE_SECONDS,
) -> DataFrame:
    """Increase per second of a counter that may restart, per series and window.

    A sample below its predecessor means the counter restarted at 0. The first
    sample of a series has no increase. Samples at one instant count as one, the
    largest.
    """
    one = (
        samples.where(F.col(value).isNotNull())
        .withColumn("_us", times.micros(samples, ts))
        .groupBy(*series, "_us")
        .agg(F.max(value).alias("_v"))
    )
    steps = with_previous(one, series, "_us", carry=["_v"], slice_seconds=slice_seconds)
    increase = F.when(F.col("_v") >= F.col("prev__v"), F.col("_v") - F.col("prev__v")).otherwise(F.col("_v"))
    increase = F.when(F.col("prev__v").isNull(), F.lit(0)).otherwise(increase)
    timed = steps.withColumn("_inc", increase).withColumn(
        "_ts", times.from_micros("_us", times.is_wall_clock(samples, ts))
    )
    windows = sliding_sums(timed, series, {"increase": F.sum("_inc")}, "_ts", length_min, step_min)
    return windows.select(
        "window_start", *series, "increase", (F.col("increase") / (length_min * 60.0)).alias("per_second")
    )


def scaled_gauge(samples: DataFrame, value: str, divisor: float = 1024.0 * 1024.0, name: str = "mb") -> DataFrame:
    """A gauge in larger units."""
    return samples.withColumn(name, F.col(value) / F.lit(divisor))
