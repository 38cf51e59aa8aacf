"""How KPI values are shown."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from railcadence import schema as S


def band(score: Column, green_from: int = S.GREEN_FROM, orange_from: int = S.ORANGE_FROM) -> Column:
    return (
        F.when(score.isNull(), "grey")
        .when(score >= green_from, "green")
        .when(score >= orange_from, "orange")
        .otherwise("red")
    )


def or_missing(text: Column) -> Column:
    return F.coalesce(text, F.lit(S.MISSING_TEXT))


def score_text(score: Column) -> Column:
    return or_missing(score.cast("string"))


def drift_text(drift: Column) -> Column:
    """``+ 12%``; never negative; halves go to the even number."""
    pct = F.greatest(F.lit(0), F.bround(drift * 100, 0).cast("int"))
    return F.concat(F.lit("+ "), or_missing(F.when(drift.isNotNull(), F.concat(pct.cast("string"), F.lit("%")))))


def minutes_text(value: Column, decimals: int = 1) -> Column:
    """``2.5 min``. format_number rounds the exact binary value, halves to even."""
    pattern = "0." + "0" * decimals if decimals else "0"
    return or_missing(F.concat(F.call_function("format_number", value.cast("double"), F.lit(pattern)), F.lit(" min")))


def stamp_text(ts: Column) -> Column:
    return or_missing(F.date_format(ts, "dd/MM/yyyy HH:mm"))
