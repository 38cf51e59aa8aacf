"""Real-time timetable feed (SIRI EstimatedTimetable JSON) to passages."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from railcadence import schema as S
from railcadence.functions import text, times

TIME_FIELDS = {"planned": "AimedDepartureTime", "real": "ExpectedDepartureTime"}


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Landed payload files, one row per file: payload, file_name, landed_at."""
    return spark.read.text(path, wholetext=True).select(
        F.col("value").alias("payload"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_modification_time").alias("landed_at"),
    )


def _frames(payload: str, schema: T.StructType) -> Column:
    """The frames of a payload's first delivery."""
    doc = F.from_json(F.col(payload), schema)
    return F.get(doc["Siri"]["ServiceDelivery"]["EstimatedTimetableDelivery"], F.lit(0))["EstimatedJourneyVersionFrame"]


def _named(rows: DataFrame, calls: Column) -> DataFrame:
    """Journeys ``j`` that have a name, with their calls."""
    return rows.where(F.size("j.VehicleJourneyName") > 0).select(
        "observed_at",
        F.get("j.VehicleJourneyName", F.lit(0))["value"].alias("mission"),
        F.coalesce(F.get("j.DestinationName", F.lit(0))["value"], F.lit("")).alias("destination"),
        calls.alias("calls"),
    )


def journeys(payloads: DataFrame, observed_at: Column, payload: str = "payload") -> DataFrame:
    """One row per named journey of the first delivery, calls still nested."""
    frames = payloads.select(observed_at.alias("observed_at"), F.explode(_frames(payload, S.SIRI_PAYLOAD)).alias("frame"))
    listed = frames.select("observed_at", F.explode("frame.EstimatedVehicleJourney").alias("j"))
    return _named(listed, F.col("j.EstimatedCalls.EstimatedCall"))


def spread_journeys(payloads: DataFrame, observed_at: Column, payload: str = "payload") -> DataFrame:
    """:func:`journeys` dealt out to all tasks, for few or large payloads.

    The task that reads a payload leaves the calls as text, which takes a fraction of their
    memory; they are parsed where their journey goes. One generator lists the journeys, so no
    frame is copied as a row of its own.
    """
    none = F.array().cast(T.ArrayType(S.SIRI_JOURNEY_OF_TEXT))
    listed = F.flatten(F.transform(
        _frames(payload, S.SIRI_PAYLOAD_OF_TEXT), lambda frame: F.coalesce(frame["EstimatedVehicleJourney"], none)
    ))
    rows = _named(payloads.select(observed_at.alias("observed_at"), F.explode(listed).alias("j")), F.col("j.EstimatedCalls"))
    # what is no object has no calls; from_json would take the first object of an array
    calls = F.when(F.col("calls").startswith("{"), F.from_json("calls", S.SIRI_CALLS))["EstimatedCall"]
    return rows.repartition("observed_at", "mission").withColumn("calls", calls)


def _timed_calls(calls: Column, field: str) -> Column:
    """Calls that have the wanted time, as (stop_id, pos, t)."""
    located = F.transform(
        calls,
        lambda c, i: F.struct(
            text.stop_id(c["StopPointRef"]["value"]).alias("stop_id"),
            i.alias("pos"),
            times.parse_instant(c[field]).alias("t"),
        ),
    )
    return F.filter(located, lambda c: c["t"].isNotNull())


def parse_siri(
    payloads: DataFrame,
    stops: DataFrame,
    time_field: str | None = None,
    observed_at: Column | dt.datetime | str | None = None,
    payload: str = "payload",
    spread: bool = False,
) -> DataFrame:
    """Payloads to passages, planned and real in one pass.

    ``time_field`` limits the result to one of the two time fields. Journeys
    without a name are left out; journeys without any usable call stay as one row
    without a stop. Calls at stops outside ``stops`` are dropped; a stop repeated
    within a journey keeps its last call.

    Everything known per journey (origin, stop count, end time) is computed
    inside the journey's own call array before it is exploded: parsing never
    shuffles. The stop list reaches the rows as one map value. ``spread`` deals the
    journeys out to all tasks, see :func:`spread_journeys`.
    """
    if observed_at is None:
        stamp = F.col("landed_at")
    elif isinstance(observed_at, Column):
        stamp = observed_at
    else:
        stamp = times.literal(observed_at, wall_clock=False)
    wanted = {k: f for k, f in TIME_FIELDS.items() if time_field in (None, f)}
    if not wanted:
        raise ValueError(f"unknown time field {time_field}")

    # An unreadable id names no stop; of a repeated one the last entry holds.
    entries = stops.where("stop_id is not null").agg(F.array_sort(F.collect_list(
        F.struct("stop_id", "stop_seq", "stop_key", "stop_name")
    )).alias("sorted"))
    last = F.filter("sorted", lambda x, i: ~x["stop_id"].eqNullSafe(F.get("sorted", i + 1)["stop_id"]))
    known = entries.select(F.map_from_entries(F.transform(last, lambda x: F.struct(
        x["stop_id"], F.struct(x["stop_seq"].alias("stop_seq"), x["stop_key"].alias("stop_key"), x["stop_name"].alias("stop_name"))
    )))).scalar()
    per_kind = F.array(*[
        F.struct(F.lit(kind).alias("kind"), _timed_calls(F.col("calls"), field).alias("calls"))
        for kind, field in wanted.items()
    ])
    listed = (spread_journeys if spread else journeys)(payloads, stamp, payload)
    split = (
        listed
        .select("observed_at", "mission", "destination", F.explode(per_kind).alias("k"))
        .select(
            "observed_at", "mission", "destination", "k.kind",
            F.array_sort("k.calls").alias("ordered"), known.alias("known"),
        )
    )
    # sorted by (stop, position): the last call of a stop is followed by another stop
    last_calls = F.filter(
        "ordered",
        lambda c, i: F.coalesce(F.get(F.col("ordered"), i + 1)["stop_id"] != c["stop_id"], F.lit(True)),
    )
    located = F.filter(
        F.transform(last_calls, lambda c: F.struct(
            c["t"].alias("t"), F.try_element_at(F.col("known"), c["stop_id"]).alias("stop"), c["stop_id"].alias("stop_id"),
        )),
        lambda c: c["stop"].isNotNull(),
    )
    by_time = F.transform(F.col("located"), lambda c: F.struct(
        c["t"].alias("t"), c["stop"]["stop_seq"].alias("seq"), c["stop"]["stop_name"].alias("name"),
    ))
    trips = (
        split.select("observed_at", "mission", "destination", "kind", located.alias("located"))
        .withColumn("origin", F.array_min(by_time)["name"])
        .withColumn("n_served", F.coalesce(F.size("located"), F.lit(0)))
        .withColumn("ends_at", F.array_max(F.col("located.t")))
    )
    return trips.select("*", F.posexplode_outer("located").alias("call_pos", "c")).select(
        "mission",
        text.mission_type(F.col("mission")).alias("mission_type"),
        text.direction(F.col("mission")).alias("direction"),
        "destination",
        "kind",
        F.col("c.stop_id").alias("stop_id"),
        F.col("c.stop.stop_key").alias("stop_key"),
        F.col("c.stop.stop_seq").alias("stop_seq"),
        F.col("c.t").alias("t"),
        F.coalesce("call_pos", F.lit(0)).alias("call_pos"),
        "origin",
        F.greatest(F.col("n_served"), F.lit(0)).alias("n_served"),
        "ends_at",
        "observed_at",
        F.to_date("observed_at").alias("service_date"),
    )
