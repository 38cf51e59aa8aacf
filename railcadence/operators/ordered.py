"""Previous value in time order, without a task per group.

A stop and direction of a busy network can hold a large part of all rows, so
``lag`` over the whole group would sort that part in one task. The order is cut
into fixed time slices instead:

1. one small aggregate notes the last row of every (group, slice);
2. ``lag`` runs inside each (group, slice);
3. the first row of a slice takes the last row of the slice before it, from a
   ``lag`` over the notes of step 1. Their number is bounded by the time span,
   not by the data: 525,600 a year and group at one minute.

Slices depend on the time value alone, so a recomputed task gives equal rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

SLICE_SECONDS = 60
SLICE = "_slice"


def with_slice(df: DataFrame, group: Sequence[str], us: str, slice_seconds: float) -> DataFrame:
    """Add the slice. The NULL checks state up front what the joins would otherwise
    add branch by branch: with equal branches Spark computes the rows once."""
    number = F.floor(F.col(us) / F.lit(float(slice_seconds) * 1e6)).cast("bigint")
    return df.withColumn(SLICE, number).where(all_known(*group, SLICE))


def all_known(*names: str) -> Column:
    """None of the columns is NULL, as plain conditions Spark can push down."""
    return reduce(and_, [F.col(c).isNotNull() for c in names])


def slice_notes(sliced: DataFrame, group: Sequence[str], us: str, carry: Sequence[str] = ()) -> DataFrame:
    """group, slice, _last: last row of every slice."""
    # a bare BIGINT keeps the aggregate hash-based
    last = F.max(F.struct(us, *carry)) if carry else F.max(us)
    return sliced.groupBy(*group, SLICE).agg(last.alias("_last"))


def previous_in_slices(
    sliced: DataFrame,
    notes: DataFrame,
    group: Sequence[str],
    us: str,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Add ``prev_<us>`` and ``prev_<carry>``.

    The lookup of the slice before joins on the window's own keys, so the rows
    are shuffled and sorted once for both.
    """
    value = F.struct(us, *carry) if carry else F.col(us)
    key = [*group, SLICE]
    before = notes.select(
        *key, F.lag("_last").over(Window.partitionBy(*group).orderBy(SLICE)).alias("_before")
    ).where(F.col("_before").isNotNull())
    inside = sliced.withColumn("_in", F.lag(value).over(Window.partitionBy(*key).orderBy(us)))
    prev = F.coalesce("_in", "_before")
    found = {us: prev} if not carry else {c: prev[c] for c in (us, *carry)}
    return inside.join(before, key, "left").select(
        *sliced.columns, *[p.alias(f"prev_{c}") for c, p in found.items()]
    )


def with_previous(
    instants: DataFrame,
    group: Sequence[str],
    us: str,
    carry: Sequence[str] = (),
    slice_seconds: float = SLICE_SECONDS,
) -> DataFrame:
    """Add ``prev_<col>`` for ``us`` and each ``carry`` column.

    ``instants`` must hold one row per (group, us), ``us`` being a BIGINT in
    microseconds; neither may be NULL. A slice then has at most one row per
    microsecond of its width, and for feeds with whole seconds one per second.
    The first row of a group gets NULLs.
    """
    sliced = with_slice(instants, group, us, slice_seconds)
    notes = slice_notes(sliced, group, us, carry)
    return previous_in_slices(sliced, notes, group, us, carry).drop(SLICE)
