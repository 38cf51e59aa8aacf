"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from railcadence.llm.common import staged


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label`` (smallest node it is connected with) for all nodes of ``edges``
    (``a``, ``b``). Every step is an aggregate and a join; nothing reaches the driver but a
    count and a checksum."""
    now = staged(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    seen = _mark(now)
    while seen[0]:
        both = now.union(now.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = staged(large.where("a <> b").distinct(), "edges")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b")))
        now = staged(small.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
        before, seen = seen, _mark(now)
        if seen == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).union(now.select("b", "b")).distinct()
