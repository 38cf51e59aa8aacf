"""Event and order tables read as train data.

events      mission    = 4-digit type of the user, the user id and the day
            direction  = parity of the user id
            stop_key   = event type
            planned t  = ts, real t = ts + value seconds
            observed_at = hour or day of ts
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from railcadence import schema as S
from railcadence.functions import times

EVENT_STOPS = ("click", "error", "purchase", "signup", "view")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_passages(events: DataFrame, snapshot: str = "hour") -> DataFrame:
    """mission, mission_type, direction, stop_key, planned_t, real_t, observed_at.

    Times stay TIMESTAMP_NTZ, so results do not depend on the session time zone.
    """
    code = F.lpad((F.col("user_id") % 10000).cast("string"), 4, "0")
    day = F.to_date("ts")
    midnight = day.cast("timestamp_ntz")
    return events.select(
        F.concat_ws("-", code, F.col("user_id").cast("string"), day.cast("string")).alias("mission"),
        code.alias("mission_type"),
        F.when(F.col("user_id") % 2 == 0, S.NORTH).otherwise(S.SOUTH).alias("direction"),
        F.col("event_type").alias("stop_key"),
        F.col("ts").alias("planned_t"),
        F.expr("ts + make_dt_interval(0, 0, 0, cast(value as decimal(18, 6)))").alias("real_t"),
        (midnight + F.make_dt_interval(F.lit(0), F.hour("ts")) if snapshot == "hour" else midnight).alias("observed_at"),
    )


def planned_of(passages: DataFrame) -> DataFrame:
    return passages.drop("real_t").withColumnRenamed("planned_t", "t")


def real_of(passages: DataFrame) -> DataFrame:
    return passages.drop("planned_t").withColumnRenamed("real_t", "t")


def event_trips(passages: DataFrame) -> DataFrame:
    """One row per mission and snapshot: origin, last stop, number of stops served."""
    return (
        passages.groupBy("mission", "mission_type", "direction", "observed_at")
        .agg(
            F.min_by("stop_key", F.struct("t", "stop_key")).alias("origin"),
            F.max_by("stop_key", F.struct("t", "stop_key")).alias("destination"),
            # a bit per stop: the number of distinct stops without keeping a set
            F.bit_count(F.bit_or(_stop_bit())).alias("n_served"),
        )
    )


def _stop_bit():
    bit = None
    for i, stop in enumerate(EVENT_STOPS):
        here = F.col("stop_key") == stop
        bit = F.when(here, F.lit(1 << i)) if bit is None else bit.when(here, F.lit(1 << i))
    return bit


def with_stop_counts(passages: DataFrame, trips: DataFrame) -> DataFrame:
    """Each call with the stop count of its trip."""
    return passages.join(
        trips.select("mission", "observed_at", "n_served"), ["mission", "observed_at"]
    )


def full_passages(events: DataFrame, service_date: str) -> DataFrame:
    """Events as a complete passages table, all on one service day.

    The stop order is the alphabet; a mission is one day of a user.
    """
    p = event_passages(events, "day")
    seq = F.array_position(F.array(*[F.lit(s) for s in EVENT_STOPS]), F.col("stop_key")).cast("int") - 1
    both = planned_of(p).withColumn("kind", F.lit("planned")).unionByName(
        real_of(p).withColumn("kind", F.lit("real"))
    )
    trips = event_trips(planned_of(p)).drop("mission_type", "direction")
    ends = both.groupBy("mission", "kind").agg(F.max("t").alias("ends_at"), F.min(F.struct("t", "stop_key")).alias("_first"))
    first = F.struct("t", "stop_key") == F.col("_first")
    return (
        both.join(trips, ["mission", "observed_at"])
        .join(ends, ["mission", "kind"])
        .withColumns({
            "stop_seq": seq,
            "call_pos": F.when(first, 0).otherwise(1),
            "service_date": F.lit(service_date).cast("date"),
        })
        .drop("_first")
    )


CYCLE_HOURS = (9, 12, 15, 18)
_PIECES = 1024
_AROUND_JOURNEYS = (
    '{"Siri":{"ServiceDelivery":{"EstimatedTimetableDelivery":[{"EstimatedJourneyVersionFrame":[{"EstimatedVehicleJourney":[',
    "]}]}]}}}",
)


def event_stop_list(events: DataFrame) -> DataFrame:
    """The event types as a stop list, numbered in the order of the alphabet."""
    seq = F.array_position(F.array(*[F.lit(s) for s in EVENT_STOPS]), F.col("event_type")).cast("int")
    kinds = events.select("event_type").where("event_type is not null").distinct()
    return kinds.select(
        seq.alias("stop_seq"), seq.alias("stop_id"), F.col("event_type").alias("stop_name"), F.col("event_type").alias("stop_key")
    )


def cycle_payloads(events: DataFrame) -> DataFrame:
    """Four feed payloads a day (payload, landed_at), each with the trains then known.

    A train is a user's day; its calls are the user's last event of each type. It is listed from
    the snapshot numbered user_id % 3 on, late by its value in seconds once, twice, ... as the
    day goes on, and without the calls it has passed.
    """
    us = times.micros(events, "ts")
    calls = events.select("user_id", "event_type", us.alias("us"), F.round(F.col("value") * 1_000_000).cast("bigint").alias("late")).groupBy(
        "user_id", "event_type", F.floor(F.col("us") / F.lit(86_400e6)).cast("bigint").alias("day")
    ).agg(F.max_by(F.struct("us", "late"), "us").alias("call"))
    hours = F.array(*[F.lit(h).cast("bigint") for h in CYCLE_HOURS])
    listed = calls.select("user_id", "event_type", "day", "call.*", F.posexplode(hours).alias("k", "hour")).select(
        "*", ((F.col("day") * 24 + F.col("hour")) * 3_600_000_000).alias("stamp"), (F.col("us") + F.col("late") * (F.col("k") + 1)).alias("real_us"),
    ).where((F.col("user_id") % 3 <= F.col("k")) & (F.col("real_us") >= F.col("stamp")))

    def iso(micros):
        return F.concat(F.replace(times.from_micros(micros, True).cast("string"), F.lit(" "), F.lit("T")), F.lit("Z"))

    stop = F.array_position(F.array(*[F.lit(s) for s in EVENT_STOPS]), F.col("event_type")).cast("string")
    call = F.struct(
        F.struct(F.concat(F.lit("a:"), stop, F.lit(":")).alias("value")).alias("StopPointRef"),
        iso("us").alias("AimedDepartureTime"), iso("real_us").alias("ExpectedDepartureTime"),
    )
    letter = F.when(F.col("user_id") % 2 == 0, "E").otherwise("S")
    mission = F.concat(letter, F.lpad((F.col("user_id") % 1000).cast("string"), 3, "0"), F.lit("-"), F.col("user_id").cast("string"), F.lit("-"), F.col("day").cast("string"))
    journey = F.struct(
        F.array(F.struct(F.col("mission").alias("value"))).alias("VehicleJourneyName"),
        F.struct(F.col("calls").alias("EstimatedCall")).alias("EstimatedCalls"),
    )
    # a payload is put together as text, in two steps: as one nested value it would take a multiple of its length
    named = listed.withColumn("mission", mission).withColumn("piece", F.pmod(F.xxhash64("mission"), F.lit(_PIECES)))
    journeys = named.repartition("stamp", "piece").groupBy("stamp", "piece", "mission").agg(F.collect_list(call).alias("calls"))
    pieces = journeys.groupBy("stamp", "piece").agg(F.listagg(F.to_json(journey), F.lit(",")).alias("text"))
    head, tail = (F.lit(x) for x in _AROUND_JOURNEYS)
    return pieces.groupBy("stamp").agg(F.concat(head, F.listagg("text", F.lit(",")), tail).alias("payload")).select(
        "payload", F.timestamp_micros("stamp").alias("landed_at")
    )


def siri_payloads(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """One feed payload per line of an order, as JSON text.

    The journey is named after the order and has four calls: the stop of the line,
    the same stop again a day later (which replaces it), the stop after it without
    an expected time, and a stop no list knows. A second journey has no name.
    """
    def iso(ts):
        # a wall clock as text, marked as UTC
        return F.concat(F.replace(ts.cast("string"), F.lit(" "), F.lit("T")), F.lit("Z"))

    def texts(value):
        return F.array(F.struct(value.alias("value")))

    def call(stop, aimed, expected):
        ref = F.concat(F.lit("STIF:StopArea:SP:"), stop.cast("string"), F.lit(":"))
        none = F.lit(None).cast("string")
        return F.struct(
            F.struct(ref.alias("value")).alias("StopPointRef"),
            iso(aimed).alias("AimedDepartureTime"),
            (none if expected is None else iso(expected)).alias("ExpectedDepartureTime"),
        )

    line, ship = F.col("l_linenumber"), F.col("l_shipdate")
    minutes = F.expr("make_dt_interval(0, 0, cast(l_quantity as int))")
    next_day = F.expr("make_dt_interval(1)")
    calls = F.array(
        call(line, ship, ship + minutes),
        call(line, ship + next_day, ship + next_day + minutes),
        call(line + 1, ship + next_day, None),
        call(F.lit(0), ship, ship),
    )
    named = F.struct(
        texts(F.concat(F.substring("o_orderpriority", 3, 4), F.col("l_orderkey").cast("string")))
        .alias("VehicleJourneyName"),
        texts(F.col("o_orderstatus")).alias("DestinationName"),
        F.struct(calls.alias("EstimatedCall")).alias("EstimatedCalls"),
    )
    unnamed = F.struct(
        F.slice(named["VehicleJourneyName"], 1, 0).alias("VehicleJourneyName"),
        named["DestinationName"].alias("DestinationName"),
        named["EstimatedCalls"].alias("EstimatedCalls"),
    )
    frame = F.struct(F.array(named, unnamed).alias("EstimatedVehicleJourney"))
    delivery = F.struct(F.array(frame).alias("EstimatedJourneyVersionFrame"))
    service = F.struct(F.array(delivery).alias("EstimatedTimetableDelivery"))
    doc = F.struct(F.struct(service.alias("ServiceDelivery")).alias("Siri"))
    # a merge join spreads the rows over all tasks before the costly JSON work,
    # however few files the tables have
    return lineitem.join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.to_json(doc).alias("payload"), F.col("o_orderdate").alias("landed_at")
    )
