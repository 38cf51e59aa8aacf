"""Mission reference: what the fullest run of each mission type looks like."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from railcadence import schema as S
from railcadence.functions.text import corrected_destination
from railcadence.operators.latest import rows_at_max

COLUMNS = ["mission_type", "direction", "origin", "destination", "n_stops"]


def build_reference(
    trips: DataFrame, latest_only: bool = False, observed_at: str = "observed_at"
) -> DataFrame:
    """Per mission type the runs that serve the most stops, ties kept.

    With ``latest_only`` the most stops are still taken over all snapshots, but
    only runs listed in the newest one stay. Runs are reduced to their distinct
    shapes before anything else, so a type with very many runs is no larger than
    its number of shapes.
    """
    shape = ["mission_type", "direction", "origin", "destination", "n_served"]
    seen = [F.max(observed_at).alias("_seen")] if latest_only else []
    shapes = trips.groupBy(*shape).agg(*seen) if seen else trips.select(*shape).distinct()
    fullest = rows_at_max(shapes, "n_served", ["mission_type"])
    if latest_only:
        newest = trips.agg(F.max(observed_at)).scalar()
        fullest = fullest.where(F.col("_seen") == newest)
    return fullest.withColumnRenamed("n_served", "n_stops").select(*COLUMNS)


def reconcile_reference(
    current: DataFrame,
    incoming: DataFrame,
    rules: dict[str, str] | None = None,
    grow_stop_counts: bool = False,
) -> DataFrame:
    """Current reference plus the types only ``incoming`` has, destinations corrected.

    Known rows win; their NULL columns are filled from ``incoming``. Only rows
    that do have a NULL are joined with the rows of their type, all others pass
    straight through, so no type multiplies its rows. ``grow_stop_counts`` raises
    a stop count that was taken from a train already under way.
    """
    rules = S.DESTINATION_RULES if rules is None else rules
    filled = COLUMNS[1:]
    current, incoming = current.select(*COLUMNS).distinct(), incoming.select(*COLUMNS).distinct()
    has_null = F.greatest(*[F.col(c).isNull() for c in filled])

    whole = current.where(~has_null)
    other = incoming.select("mission_type", *[F.col(c).alias(f"_new_{c}") for c in filled])
    mended = current.where(has_null).join(other, "mission_type", "left").select(
        "mission_type", *[F.coalesce(F.col(c), F.col(f"_new_{c}")).alias(c) for c in filled]
    )
    added = incoming.join(current.select("mission_type").distinct(), "mission_type", "left_anti")
    merged = whole.unionByName(mended).unionByName(added)
    if grow_stop_counts:
        most = incoming.groupBy("mission_type").agg(F.max("n_stops").alias("_most"))
        merged = merged.join(most, "mission_type", "left").withColumn(
            "n_stops", F.greatest("n_stops", "_most")
        )
    return correct_destinations(merged.select(*COLUMNS), rules).distinct()


def correct_destinations(reference: DataFrame, rules: dict[str, str] | None = None) -> DataFrame:
    rules = S.DESTINATION_RULES if rules is None else rules
    return reference.withColumn(
        "destination", corrected_destination(F.col("mission_type"), F.col("destination"), rules)
    )
