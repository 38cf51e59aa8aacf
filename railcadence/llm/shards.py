"""Uniform shuffle into shards of exact size, by a hypergeometric communication matrix.

Every source partition permutes its rows locally; how many of them go to each shard is
drawn exactly (multivariate hypergeometric) so that all shard sizes come out as planned;
the rows are exchanged and each shard is permuted once more. A shard is permuted in blocks
of bounded size, so no task ever holds a shard. The driver sees one number per source
partition and shard, never rows.

Defined results: NULLs are ordinary values, repeated rows stay repeated, shard sizes
differ by one at most (surplus rows go to the first shards), an empty table gives no rows,
columns of any name are carried along unchanged.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from railcadence.llm.common import staged

ROW_BITS = 33
BLOCK_ROWS = 200_000


def draw(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """Hypergeometric draw of any size: how many of ``n`` taken from good + bad are good.

    Weights follow from the mode by the ratios of neighbours, over a range outside which
    less than a double's rounding is left.
    """
    low, high = max(0, n - bad), min(n, good)
    if low == high:
        return low
    mode = min(max((n + 1) * (good + 1) // (good + bad + 2), low), high)
    p = good / (good + bad)
    spread = int(12 * math.sqrt(n * p * (1 - p) + 1)) + 60
    a, b = max(low, mode - spread), min(high, mode + spread)
    k = np.arange(a, b, dtype=np.float64)  # step k -> k + 1
    steps = np.log((good - k) * (n - k)) - np.log((k + 1) * (bad - n + k + 1))
    log_w = np.concatenate(([0.0], np.cumsum(steps)))
    w = np.exp(log_w - log_w.max())
    return a + int(np.searchsorted(np.cumsum(w), rng.random() * w.sum(), side="right"))


def communication_matrix(part_sizes: list[int], shard_sizes: list[int], seed: int) -> list[list[int]]:
    """Rows from each partition to each shard; margins are exactly the two size lists."""
    rng, left, matrix = np.random.default_rng(seed), list(shard_sizes), []
    for n in part_sizes:
        row, rest = [], sum(left)
        for s, room in enumerate(left):
            rest -= room
            row.append(draw(rng, room, rest, n - sum(row)) if s + 1 < len(left) else n - sum(row))
        left = [a - b for a, b in zip(left, row, strict=True)]
        matrix.append(row)
    return matrix


def uniform_shards(df: DataFrame, n_shards: int, seed: int = 0, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``row`` (all columns of ``df``), ``shard`` and ``slot`` (0, 1, ... in each shard)."""
    spark = df.sparkSession
    local = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.rand(seed).alias("u"))
    rows = staged(
        local.sortWithinPartitions("u").select("row", F.monotonically_increasing_id().alias("at")), "shards"
    )
    rows = rows.select(
        "row", "at", F.shiftright("at", ROW_BITS).alias("part"),
        F.col("at").bitwiseAND(F.lit((1 << ROW_BITS) - 1)).alias("rank"),
    )
    parts = sorted((r["part"], r["count"]) for r in rows.groupBy("part").count().collect())
    total = sum(n for _, n in parts)
    sizes = [total // n_shards + (s < total % n_shards) for s in range(n_shards)]
    matrix = communication_matrix([n for _, n in parts], sizes, seed)
    plan = spark.createDataFrame(
        [(p, [int(x) for x in np.cumsum(m)]) for (p, _), m in zip(parts, matrix, strict=True)],
        "part long, upto array<long>",
    )
    n_blocks = max(1, -(-total // n_shards // block_rows))
    sent = rows.join(plan, "part").select(
        "row", "at",
        F.size(F.filter("upto", lambda x: x <= F.col("rank"))).alias("shard"),
        F.pmod(F.xxhash64(F.lit(seed), F.col("at")), F.lit(n_blocks)).alias("block"),
        F.xxhash64(F.col("at"), F.lit(seed + 1)).alias("u"),
    )
    blocks = sent.groupBy("shard", "block").count()
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("shard", "block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    ranked = sent.withColumn(
        "rank", F.row_number().over(Window.partitionBy("shard", "block").orderBy("u", "at"))
    )
    return ranked.join(starts, ["shard", "block"]).select(
        "row", "shard", (F.col("start") + F.col("rank") - 1).cast("long").alias("slot")
    )
