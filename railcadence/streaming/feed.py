"""The feed as a stream: landed payload files to passages and KPI histories.

The checkpoint remembers which files were read, in place of a ledger table, and
read files can be moved to an archive folder.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from railcadence import schema as S
from railcadence.plans import cycle as C
from railcadence.sources.feed import parse_siri

CYCLE = "5 minutes"


def payload_stream(
    spark: SparkSession, landing: str, archive: str | None = None, max_files: int = 1000
) -> DataFrame:
    """Payload files as they land, oldest first: payload, file_name, landed_at.

    ``max_files`` bounds a micro-batch and changes no result.
    """
    reader = spark.readStream.format("text").option("wholetext", True).option("maxFilesPerTrigger", max_files)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.load(landing).select(
        F.col("value").alias("payload"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_modification_time").alias("landed_at"),
    )


def run_feed(
    spark: SparkSession,
    payloads: DataFrame,
    stops: DataFrame,
    tables: C.Tables,
    checkpoint: str,
    key_stops: Mapping[str, str] = S.KEY_STOPS,
    trigger: dict | None = None,
    horizon_min: float = S.HORIZON_MINUTES,
) -> StreamingQuery:
    """Every payload stamp is one cycle, however the payloads fall into micro-batches.

    Passages are cleaned against the stamp of their own payload. The cycles of a
    batch are worked out together, in one pass over the passages of their days; each
    has its stamp in microseconds as its number, belongs to the day of its stamp and
    sees passages up to its stamp only. A stamp that a later batch repeats runs again
    and replaces its rows. So the size of a batch bounds the work at once and changes
    no result, and a backlog costs no more jobs than one payload.

    A watermark would not do for the finished-mission rule: it follows event
    times, and departure times lie in the future.
    """
    def cycles(batch: DataFrame, batch_id: int) -> None:
        # payloads that landed in one file don't stay in one task, nor do the journeys of one payload
        C.load_passages(parse_siri(batch, stops, spread=True), tables, F.col("observed_at"), batch_id)
        # two small values per payload stamp, at most one stamp per file of the batch
        stamps = batch.select(
            F.unix_micros("landed_at").alias("us"), F.to_date("landed_at").cast("string").alias("day")
        ).where("us IS NOT NULL").distinct().collect()
        C.run_cycles(spark, tables, [tuple(s) for s in stamps], key_stops, horizon_min)

    return (
        payloads.writeStream.option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": CYCLE}))
        .foreachBatch(cycles)
        .start()
    )
