"""As-of lookups along a time axis, without a task per group.

Two building blocks, both linear in their rows:

* :func:`between` meets rows with the points of their group inside an interval of their own, by an
  equi-join on buckets of the axis;
* :func:`latest_value` gives every query the largest value noted up to its place. The axis is cut
  into slices: inside a slice it is a running maximum, and what earlier slices hold is carried over by
  one small note per slice. Their number is bounded by the time span, not by the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from railcadence.functions.times import MICROS_PER_MINUTE


def _bucket(value: Column, width: int) -> Column:
    return F.floor(value / F.lit(float(width))).cast("bigint")


def between(
    rows: DataFrame, points: DataFrame, on: Sequence[str], at: str, low: Column, high: Column, width: int
) -> DataFrame:
    """Every pair of a row and a point of its group with ``low`` <= ``at`` <= ``high``.

    ``low`` and ``high`` are BIGINT expressions over ``rows``, ``at`` a BIGINT column of
    ``points`` only. A row is copied to the buckets its interval touches: two, if ``width`` is no
    shorter than the interval.
    """
    spread = rows.where(low <= high).withColumn(
        "_bucket", F.explode(F.sequence(_bucket(low, width), _bucket(high, width)))
    )
    placed = points.withColumn("_bucket", _bucket(F.col(at), width))
    return spread.join(placed, [*on, "_bucket"]).where(F.col(at).between(low, high)).drop("_bucket")


def latest_value(
    notes: DataFrame, queries: DataFrame, group: Sequence[str], key: str, value: str, width: int = MICROS_PER_MINUTE
) -> DataFrame:
    """``group``, ``key`` of the queries, each once, and ``value``: the largest one of the group's
    notes whose key is not above the query's; NULL without any."""
    noted = notes.groupBy(*group, key).agg(F.max(value).alias(value), F.lit(False).alias("_asks"))
    asked = queries.select(*group, key).distinct().select(
        *group, key, F.lit(None).cast(notes.schema[value].dataType).alias(value), F.lit(True).alias("_asks")
    )
    rows = noted.unionByName(asked).withColumn("_slice", _bucket(F.col(key), width))
    here = Window.partitionBy(*group, "_slice").orderBy(key)  # equal keys count
    before = Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = rows.groupBy(*group, "_slice").agg(F.max(value).alias("_most")).select(
        *group, "_slice", F.max("_most").over(before).alias("_before")
    )
    found = rows.withColumn("_here", F.max(value).over(here)).where("_asks")
    return found.join(slices, [*group, "_slice"]).select(*group, key, F.greatest("_here", "_before").alias(value))
