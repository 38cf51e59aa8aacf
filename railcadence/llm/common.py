"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import json
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession, functions as F

from railcadence.session import work_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` below the session's shared folder and read it back.

    Cuts the lineage: what later steps read is fixed, whatever executor is lost.
    """
    path = work_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Spark's row ids hold the partition above this many bits.
PLACE_BITS = 33


def numbered(df: DataFrame, into: str, purpose: str) -> DataFrame:
    """``df``, staged, with numbers from 0 without gaps in the order of its partitions and
    rows. The driver gets one small number per partition."""
    placed = staged(df.withColumn(into, F.monotonically_increasing_id()), purpose)
    part = F.shiftright(into, PLACE_BITS).cast("int")
    sizes = dict(placed.groupBy(part.alias("part")).count().collect())
    before = [0, *accumulate(sizes.get(p, 0) for p in range(max(sizes, default=0)))]
    start = F.get(F.from_json(F.lit(json.dumps(before)), "array<long>"), part)
    return placed.withColumn(into, start + F.col(into).bitwiseAND(F.lit((1 << PLACE_BITS) - 1)))
