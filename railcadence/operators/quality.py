"""Sanity checks on the histories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from railcadence import schema as S

DIRECTIONS = (S.NORTH, S.SOUTH)


def missing_columns(df: DataFrame, expected: Sequence[str]) -> list[str]:
    return [c for c in expected if c not in df.columns]


def _report(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """check, n_rows, n_bad; all checks in one aggregate pass."""
    counts = df.agg(
        F.count("*").alias("_rows"), *[F.count_if(bad).alias(name) for name, bad in checks.items()]
    )
    lines = F.explode(F.array(*[
        F.struct(F.lit(name).alias("check"), F.col(name).alias("n_bad")) for name in checks
    ]))
    return counts.select("_rows", lines.alias("_line")).select(
        F.col("_line.check").alias("check"), F.col("_rows").alias("n_rows"), F.col("_line.n_bad").alias("n_bad")
    )


def _bad_direction() -> Column:
    return F.coalesce(~F.col("direction").isin(*DIRECTIONS), F.lit(True))


def check_scores(history: DataFrame, scores: Sequence[str]) -> DataFrame:
    """Directions are known and every score lies in 0..100 (NULL is allowed)."""
    checks = {"direction": _bad_direction()}
    checks |= {c: F.coalesce(~F.col(c).between(0, 100), F.lit(False)) for c in scores}
    return _report(history, checks)


def check_drift(history: DataFrame) -> DataFrame:
    return _report(history, {"direction": _bad_direction()})


def check_gaps(history: DataFrame, mean: str = "mean_gap", largest: str = "max_gap") -> DataFrame:
    """Directions are known and no largest gap is below the mean."""
    return _report(history, {
        "direction": _bad_direction(),
        "max_below_mean": F.coalesce(F.col(largest) < F.col(mean), F.lit(False)),
    })
