"""Exact duplicates by content sort.

Sampled splitters range-partition the normalised texts, Spark's external sort puts
equal texts next to each other, and every row is compared in full with its neighbour.
The splitters are bounded keys (leading characters, digest, length, id), so the sample
stays small however long the texts are, and a text with very many copies is split over
several partitions. Runs that touch a partition's edge are then joined to one group.

Defined results: NULL text counts as empty, empty texts form one group, NULL ids are
the largest, of fully equal rows exactly one is kept, extra columns are ignored, an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from railcadence.llm.common import staged

WHITE_SPACE = " \t\n\x0b\x0c\r"
KEY_CHARS = 32
RUN_BITS = 40


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), WHITE_SPACE, "")


def _mark_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the runs of equal neighbours; ``head`` marks the first row of each."""
    run = (TaskContext.get().partitionId() << RUN_BITS) - 1
    before = None
    for batch in batches:
        if not batch.num_rows:
            continue
        norm = batch.column("norm")
        head = np.ones(batch.num_rows, dtype=bool)
        head[0] = before is None or norm[0].as_buffer() != before
        if batch.num_rows > 1:
            head[1:] = ~pc.equal(norm[1:], norm[:-1]).to_numpy(zero_copy_only=False)
        runs = run + np.cumsum(head)
        run, before = int(runs[-1]), pa.py_buffer(norm[-1].as_buffer().to_pybytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("n_points"), batch.column("digest"), pa.array(runs), pa.array(head)],
            names=["id", "n_points", "digest", "run", "head"],
        )


def content_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id``, ``keep_id``, ``group_size``, ``kept``, ``digest``.

    Texts are equal when identical without white space. The row with the most code
    points, then the smallest id, stays.
    """
    norm = normalised(F.col(text_col))
    rows = df.select(
        F.col(id_col).alias("id"),
        F.length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("n_points"),
        norm.alias("norm"), F.sha2(norm, 256).alias("digest"),
    ).withColumn("lead", F.substring("norm", 1, KEY_CHARS))
    best_first = [F.col("n_points").desc(), F.col("id").asc_nulls_last()]
    ordered = rows.repartitionByRange("lead", "digest", *best_first).sortWithinPartitions(
        "lead", "digest", "norm", *best_first
    )
    id_type = rows.schema["id"].dataType.simpleString()
    marked = staged(
        ordered.select("id", "n_points", "digest", "norm").mapInArrow(
            _mark_runs, f"id {id_type}, n_points long, digest string, run long, head boolean"
        ),
        "content-sort",
    )
    runs = marked.groupBy("run").agg(
        F.count("*").alias("n"), F.max(F.when(F.col("head"), F.struct("id"))).alias("first"),
        F.first("digest").alias("digest"),
    ).withColumn("part", F.shiftright("run", RUN_BITS))
    last = runs.groupBy("part").agg(F.max("run").alias("last_run"))
    first_of_part = F.shiftleft(F.shiftright("run", RUN_BITS), RUN_BITS)
    runs = runs.join(last, "part").withColumn(
        "group", F.when((F.col("run") == first_of_part) | (F.col("run") == F.col("last_run")), F.col("digest"))
        .otherwise(F.col("run").cast("string")),
    )
    groups = runs.groupBy("group").agg(
        F.sum("n").alias("group_size"), F.min("run").alias("first_run"),
        F.min_by("first", "run").alias("first"),
    ).where("group_size > 1")
    found = runs.join(groups.withColumnRenamed("first", "keep"), "group").select(
        "run", "group_size", "first_run", "keep"
    )
    return marked.join(found, "run", "left").select(
        "id",
        F.when(F.col("keep").isNull(), F.col("id")).otherwise(F.col("keep.id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("head") & (F.coalesce("first_run", "run") == F.col("run"))).alias("kept"),
        "digest",
    )
