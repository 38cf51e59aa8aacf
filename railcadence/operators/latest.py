"""First, latest and extreme rows.

All of these are combinable aggregates, or an aggregate joined back: none puts
a whole group through one window task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def latest(df: DataFrame, order_col: str, by: Sequence[str] | None = None) -> DataFrame:
    """Rows of the latest snapshot, over everything or per ``by`` key. Ties are kept.

    Without ``by`` the maximum is a scalar subquery, which prunes partitions
    when ``order_col`` is a partition column.
    """
    if not by:
        newest = df.select(order_col).agg(F.max(order_col)).scalar()
        return df.where(F.col(order_col) == newest)
    newest = df.groupBy(*by).agg(F.max(order_col).alias(order_col))
    return df.join(newest, [*by, order_col], "left_semi")


def first_seen(df: DataFrame, order_col: str, by: Sequence[str]) -> DataFrame:
    """Rows of the first snapshot in which each ``by`` key occurs. Ties are kept."""
    oldest = df.groupBy(*by).agg(F.min(order_col).alias(order_col))
    return df.join(oldest, [*by, order_col], "left_semi")


def rows_at_max(df: DataFrame, value_col: str, by: Sequence[str]) -> DataFrame:
    """Rows that hold the largest value of their group. Ties are kept, NULLs are not."""
    return latest(df, value_col, by)


def latest_rows(history: DataFrame, order_col: str, n: int = 2, tie_break: str = "direction") -> DataFrame:
    """The ``n`` newest rows; equal stamps are ordered by ``tie_break``."""
    return history.orderBy(F.col(order_col).desc(), F.col(tie_break).asc()).limit(n)


def latest_per_key(history: DataFrame, order_col: str, by: Sequence[str] = ("direction",)) -> DataFrame:
    """One newest row per key, in the column order of ``history``.

    Equal stamps are settled by the remaining columns, so the result does not
    depend on row order. ``max_by`` combines before the shuffle.
    """
    rest = [c for c in history.columns if c not in by]
    if not rest or order_col not in rest:
        raise ValueError(f"{order_col} must be a column outside {list(by)}")
    order = F.struct(order_col, *[c for c in rest if c != order_col])
    picked = history.groupBy(*by).agg(F.max_by(F.struct(*rest), order).alias("_row"))
    return picked.select(
        *[F.col(c) if c in by else F.col("_row")[c].alias(c) for c in history.columns]
    )


def newest_stamp(history: DataFrame, order_col: str) -> DataFrame:
    """One row with the newest stamp of a history (NULL if it is empty)."""
    return history.agg(F.max(order_col).alias("updated_at"))
