"""Long to wide and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def pivot_calls(
    calls: DataFrame,
    by: Sequence[str],
    stop: str,
    stops: Sequence,
    t: str = "t",
    order: Sequence[str] = ("call_pos",),
    prefix: str = "",
) -> DataFrame:
    """One column per listed stop; if a trip repeats a stop the last call wins.

    The column list is given, so stops nobody serves are NULL columns and the
    schema never depends on the data.
    """
    def last_call(value) -> Column:
        here = (F.col(stop) == F.lit(value)) & F.col(t).isNotNull()
        return F.max_by(F.when(here, F.col(t)), F.when(here, F.struct(*order, t)))

    return calls.groupBy(*by).agg(*[last_call(v).alias(f"{prefix}{v}") for v in stops])


def unpivot_calls(
    wide: DataFrame, ids: Sequence[str], stops: Sequence[str], stop: str = "stop_key", t: str = "t"
) -> DataFrame:
    """One row per trip and stop that has a time."""
    return wide.unpivot(list(ids), list(stops), stop, t).where(F.col(t).isNotNull())


def with_missing_columns(df: DataFrame, names: Sequence[str], dtype: str = "timestamp") -> DataFrame:
    """Add absent columns as NULL."""
    absent = {n: F.lit(None).cast(dtype) for n in names if n not in df.columns}
    return df.withColumns(absent) if absent else df


def row_max(names: Sequence[str]) -> Column:
    """Largest value of a row, NULLs ignored."""
    return F.array_max(F.array(*names))
