"""Load-once bookkeeping for landed files."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from railcadence import schema as S
from railcadence.functions import times
from railcadence.operators.clean import clean_counters, not_in_ledger


def files_to_load(files: DataFrame, ledger: DataFrame | None) -> DataFrame:
    """Landed files the ledger does not list yet (all of them without a ledger)."""
    return files if ledger is None else not_in_ledger(files, ledger, "file_name")


def ledger_rows(files: DataFrame, as_of: dt.datetime | str) -> DataFrame:
    """Ledger entries for loaded files, one per name."""
    return files.select("file_name").distinct().withColumn(
        "loaded_at", times.literal(as_of, wall_clock=False)
    )


def counted_ledger_rows(
    files: DataFrame, trips: DataFrame, rejects: DataFrame, as_of: dt.datetime | str, prefix: str = S.DUPLICATE_PREFIX
) -> DataFrame:
    """Ledger entries with what became of each file's records: n_bad, n_prefixed, n_finished, n_loaded.

    ``trips`` (file_name, mission, ends_at) are the readable records, ``rejects`` (file_name) the others.
    Files without any record have zeros.
    """
    counts = clean_counters(trips, as_of, prefix=prefix, by=["file_name"]).withColumnRenamed("n_kept", "n_loaded").drop("n_read")
    bad = rejects.groupBy("file_name").agg(F.count("*").alias("n_bad"))
    names = ["n_bad", "n_prefixed", "n_finished", "n_loaded"]
    return ledger_rows(files, as_of).join(bad, "file_name", "left").join(counts, "file_name", "left").select(
        "file_name", "loaded_at", *[F.coalesce(n, F.lit(0)).alias(n) for n in names]
    )
