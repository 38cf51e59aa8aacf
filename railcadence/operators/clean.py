"""Row rules applied when passages are loaded."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from railcadence import schema as S
from railcadence.functions import times


def is_duplicate_name(col: Column, prefix: str = S.DUPLICATE_PREFIX) -> Column:
    """True for names with the duplicate prefix; NULL names are not duplicates."""
    return F.coalesce(col.startswith(prefix), F.lit(False))


def is_finished(ends_at: Column, as_of: Column) -> Column:
    """True if the last call lies strictly before ``as_of``; no call at all is not finished."""
    return F.coalesce(ends_at < as_of, F.lit(False))


def drop_prefixed(df: DataFrame, col: str = "mission", prefix: str = S.DUPLICATE_PREFIX) -> DataFrame:
    """Drop rows whose name repeats another one; no change if the column is absent."""
    if col not in df.columns:
        return df
    return df.where(~is_duplicate_name(F.col(col), prefix))


def drop_finished(df: DataFrame, as_of: Column | dt.datetime | str, ends_at: str = "ends_at") -> DataFrame:
    return df.where(~is_finished(F.col(ends_at), times.literal_like(df, ends_at, as_of)))


def clean_passages(
    passages: DataFrame, as_of: Column | dt.datetime | str, prefix: str = S.DUPLICATE_PREFIX
) -> DataFrame:
    """Both rules. Passages carry the end time of their trip, so this is a plain filter."""
    return drop_finished(drop_prefixed(passages, "mission", prefix), as_of)


def clean_counters(
    trips: DataFrame,
    as_of: Column | dt.datetime | str,
    name: str = "mission",
    ends_at: str = "ends_at",
    prefix: str = S.DUPLICATE_PREFIX,
    by: Sequence[str] = (),
) -> DataFrame:
    """One row (per ``by``): trips read, dropped by each rule (name first), kept. One pass."""
    dup = is_duplicate_name(F.col(name), prefix)
    over = is_finished(F.col(ends_at), times.literal_like(trips, ends_at, as_of))
    return trips.groupBy(*by).agg(
        F.count("*").alias("n_read"),
        F.count_if(dup).alias("n_prefixed"),
        F.count_if(~dup & over).alias("n_finished"),
        F.count_if(~dup & ~over).alias("n_kept"),
    )


def not_in_ledger(items: DataFrame, ledger: DataFrame, key: str, ledger_key: str | None = None) -> DataFrame:
    """Items whose key the ledger does not hold. The ledger is reduced to its
    distinct keys first, so a key it repeats often does not pile up in one task."""
    known = ledger.select(F.col(ledger_key or key).alias(key)).distinct()
    return items.join(known, key, "left_anti")
