"""Streaming state: first planned and last real time per mission and stop.

State is keyed by service day as well, and the one-day watermark on the
observation time drops a day's state once the next day is over. Nothing has to
be reset by hand and the state never outgrows two days.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from railcadence.sinks.tables import append_history

DAY = "1 day"


def _by_day(calls: DataFrame, keys: Sequence[str], observed_at: str):
    # the start of the local day, as an instant: what the watermark moves along
    day = F.to_date(observed_at).cast("timestamp")
    return (
        calls.where(F.col("t").isNotNull())
        .withColumn("service_day", day)
        .withWatermark("service_day", DAY)
        .groupBy("service_day", *keys)
    )


def first_planned(calls: DataFrame, keys: Sequence[str], observed_at: str = "observed_at") -> DataFrame:
    """Earliest observation of each key in its service day, and the time it gave."""
    return _by_day(calls, keys, observed_at).agg(
        F.min_by("t", F.struct(observed_at, "t")).alias("first_t"),
        F.min(observed_at).alias("first_observed_at"),
    )


def last_real(calls: DataFrame, keys: Sequence[str], observed_at: str = "observed_at") -> DataFrame:
    """Latest real time of each key in its service day."""
    return _by_day(calls, keys, observed_at).agg(F.max("t").alias("last_t"))


def tumbling_counts(events: DataFrame, keys: Sequence[str], ts: str, width: str, delay: str) -> DataFrame:
    """Events per tumbling window and key. Wall-clock times are read in the session zone."""
    events = events.withColumn(ts, F.col(ts).cast("timestamp"))
    return events.withWatermark(ts, delay).groupBy(F.window(ts, width).alias("w"), *keys).agg(
        F.count("*").alias("n")
    )


def write_updates(updates: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Run an update-mode aggregation into a table of updates, one partition per batch."""
    def put(batch: DataFrame, batch_id: int) -> None:
        append_history(batch, path, f"{batch_id:012d}")

    return (
        updates.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .foreachBatch(put)
        .start()
    )


def current_state(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Latest update of every key."""
    updates = spark.read.parquet(path)
    rest = [c for c in updates.columns if c not in (*keys, "cycle")]
    return updates.groupBy(*keys).agg(F.max_by(F.struct(*rest), "cycle").alias("_s")).select(
        *keys, "_s.*"
    )
