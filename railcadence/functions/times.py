"""Time arithmetic that behaves the same for instants and wall clocks.

TIMESTAMP columns are instants: differences are true elapsed time, also across
a clock change. TIMESTAMP_NTZ columns are wall clocks: differences are what a
clock on the wall shows. The choice is made by the column type alone.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F, types as T

MICROS_PER_SECOND = 1_000_000
MICROS_PER_MINUTE = 60 * MICROS_PER_SECOND

_EPOCH_NTZ = "timestamp_ntz'1970-01-01 00:00:00'"


def is_wall_clock(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, T.TimestampNTZType)


def micros(df: DataFrame, col: str) -> Column:
    """Microseconds since the epoch as BIGINT."""
    if is_wall_clock(df, col):
        return _wall_micros(f"`{col}`")
    return F.unix_micros(F.col(col))


def _wall_micros(ntz: str) -> Column:
    # Subtracting two wall clocks involves no time zone. (timestampdiff would go
    # through the session zone and move times inside a clock change.)
    seconds = f"cast(cast({ntz} - {_EPOCH_NTZ} as interval second) as decimal(18, 6))"
    return F.expr(f"cast({seconds} * 1000000 as bigint)")


def from_micros(us: str, wall_clock: bool) -> Column:
    """Inverse of :func:`micros` for a BIGINT column named ``us``."""
    if wall_clock:
        # seconds as DECIMAL keep every microsecond
        return F.expr(
            f"{_EPOCH_NTZ} + make_dt_interval(0, 0, 0, cast(`{us}` / 1000000BD as decimal(18, 6)))"
        )
    return F.timestamp_micros(F.col(us))


def literal(value: dt.datetime | str, wall_clock: bool) -> Column:
    """A timestamp constant of the wanted kind."""
    text = value.isoformat(sep=" ") if isinstance(value, dt.datetime) else value
    return F.lit(text).cast("timestamp_ntz" if wall_clock else "timestamp")


def literal_like(df: DataFrame, col: str, value: Column | dt.datetime | str) -> Column:
    """``value`` as a constant of the type of ``df[col]``; Columns pass through."""
    if isinstance(value, Column):
        return value
    return literal(value, is_wall_clock(df, col))


def whole_minutes(us_later: Column, us_earlier: Column) -> Column:
    """Minutes between two BIGINT instants, rounded half away from zero."""
    return F.round((us_later - us_earlier) / F.lit(float(MICROS_PER_MINUTE))).cast("int")


def minutes_horizon(minutes: int | float) -> Column:
    return F.expr(f"make_dt_interval(0, 0, 0, {float(minutes) * 60:.6f}BD)")


def parse_instant(col: Column | str) -> Column:
    """ISO-8601 text with offset or ``Z`` to an instant; unreadable text gives NULL."""
    return F.try_to_timestamp(F.col(col) if isinstance(col, str) else col)


def parse_instant_utc(col: Column | str) -> Column:
    """Like :func:`parse_instant`, but text without an offset is UTC, whatever the session zone."""
    text = F.col(col) if isinstance(col, str) else col
    has_offset = text.rlike(r"(Z|[+-]\d{2}:?\d{2})$")
    seconds = (text.try_cast("timestamp_ntz") - F.expr(_EPOCH_NTZ)).cast("interval second")
    as_utc = F.timestamp_micros((seconds.cast("decimal(18, 6)") * 1_000_000).cast("bigint"))
    return F.when(has_offset, parse_instant(text)).otherwise(as_utc)


def elapsed_minutes(us_later: Column, us_earlier: Column, wrap_at_day: bool = False) -> Column:
    """Whole minutes between two BIGINT instants, seconds dropped.

    ``wrap_at_day`` drops whole days first, as hour and minute fields of an
    interval do.
    """
    minutes = F.floor((us_later - us_earlier) / F.lit(float(MICROS_PER_MINUTE))).cast("bigint")
    return minutes % 1440 if wrap_at_day else minutes
