"""Stop lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from railcadence import schema as S
from railcadence.functions.text import normalize_key


def read_stops(spark: SparkSession, path: str) -> DataFrame:
    """Ordered stop list: stop_seq, stop_id, stop_name, stop_key, lat, lon.

    The order of the file is the geographic order, so the file (one line's
    stops) is read as one partition and numbered from 0. A byte-order mark is
    dropped by the reader.
    """
    raw = spark.read.csv(path, header=True, schema=S.STOP_LIST_CSV, escape='"', encoding="UTF-8")
    point = F.split("geo_point_2d", ",")
    return raw.coalesce(1).select(
        F.monotonically_increasing_id().cast("int").alias("stop_seq"),
        F.col("id_ref_zda").alias("stop_id"),
        F.col("nom_zda").alias("stop_name"),
        normalize_key(F.col("nom_zda")).alias("stop_key"),
        F.trim(point[0]).try_cast("double").alias("lat"),
        F.trim(F.get(point, F.lit(1))).try_cast("double").alias("lon"),
    )


def read_station_master(spark: SparkSession, path: str) -> DataFrame:
    """Station master file: semicolons, quoted GeoJSON with doubled quotes; all text."""
    return spark.read.csv(path, header=True, sep=";", quote='"', escape='"', encoding="UTF-8")
