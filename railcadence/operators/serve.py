"""What a front end asks for: newest rows and display cards."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F, types as T

from railcadence import schema as S
from railcadence.functions import display
from railcadence.operators.latest import latest_per_key, latest_rows


def as_rows(df: DataFrame, row_type: T.StructType) -> DataFrame:
    """Exactly the columns and types of a served row."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in row_type.fields])


def latest_regularity(history: DataFrame, n: int = 2) -> DataFrame:
    return as_rows(latest_rows(history, "date_observation", n), S.REGULARITY_ROW)


def latest_drift(history: DataFrame, n: int = 2) -> DataFrame:
    return as_rows(latest_rows(history, "date_calcul", n), S.DRIFT_ROW)


def latest_gaps(history: DataFrame, n: int = 2) -> DataFrame:
    return as_rows(latest_rows(history, "date_observation", n), S.GAPS_ROW)


def for_direction(rows: DataFrame, direction: str, order_col: str = "date_observation") -> DataFrame:
    """The newest row of one direction."""
    return latest_per_key(rows.where(F.col("direction") == direction), order_col)


def score_cards(
    scores: DataFrame, cards: Mapping[str, str] = S.CARD_STOPS, prefix: str = "score_"
) -> DataFrame:
    """direction, label, value, band: one card per shown stop."""
    each = F.explode(F.array(*[
        F.struct(F.lit(label).alias("label"), F.col(f"{prefix}{short}").cast("int").alias("score"))
        for label, short in cards.items()
    ]))
    return scores.select("direction", each.alias("_card")).select(
        "direction",
        F.col("_card.label").alias("label"),
        display.score_text(F.col("_card.score")).alias("value"),
        display.band(F.col("_card.score")).alias("band"),
    )


def drift_cards(rows: DataFrame, drift: str = "moyenne_allongement") -> DataFrame:
    return rows.select("direction", display.drift_text(F.col(drift)).alias("value"))


def gap_cards(rows: DataFrame, mean: str = "ecart_moyen", median: str = "ecart_median",
              largest: str = "ecart_max") -> DataFrame:
    return rows.select(
        "direction",
        display.minutes_text(F.col(mean)).alias("mean_text"),
        display.minutes_text(F.col(median)).alias("median_text"),
        display.minutes_text(F.col(largest), 0).alias("max_text"),
    )
