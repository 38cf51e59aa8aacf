"""Near duplicates by SimHash fingerprints in a Gray-order hierarchical index.

A document's fingerprint takes, bit by bit, the majority of the XXH64 values of its word
shingles. Distinct fingerprints are sorted by their rank in Gray order, where neighbours
share most bits, and cut into leaves of ``LEAF``. A node of the index knows the bits that all
fingerprints below it share (``mask``) and their values (``pattern``); what its parent knows
already is factored out, so differences add up on the way down.

The index is joined with itself from its root. Two nodes differ at least in the bits in which
their shared patterns differ; a pair of nodes above ``MAX_DIFFERENCES`` is dropped with all
fingerprints below. Pairs of leaves that remain are searched in a task each: the fingerprints
of one go down a small index of the other, built the same way, with their differences so far.
Leaves have one size however alike the fingerprints are, and no leaf leaves its task but for
leaves it may have links with. What a task finds is sent on as a forest, not as all pairs.

Defined results: NULL, empty and blank texts have the fingerprint 0 and are linked like any
other, texts under ``width`` words are one shingle, repeated rows are given one by one, NULL
ids are in no way special but never name a component, extra columns are ignored, an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from railcadence.llm.common import numbered, staged
from railcadence.llm.components import components

WIDTH = 3
SEED = 42
MAX_DIFFERENCES = 2
#: Fingerprints of a leaf, children of a node, the same within a task, and queries per step.
LEAF, FAN_OUT_BITS, INNER, STEP = 4096, 4, 8, 256
#: Shingles of a text that are hashed at a time.
SHINGLES = 1 << 16
U64 = np.uint64

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


# ---------------------------------------------------------------- fingerprints
def shingle_hashes(text: bytes, width: int = WIDTH, seed: int = SEED) -> Iterator[np.ndarray]:
    """XXH64 of every run of ``width`` words, space-joined, repeats included."""
    words = text.translate(_LOWER).split()
    if not words:
        return
    joined, width = b" ".join(words), min(width, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    firsts, lasts, digest = starts[: len(words) - width + 1], ends[width - 1 :], xxhash.xxh64_intdigest
    for at in range(0, len(firsts), SHINGLES):
        spans = zip(firsts[at : at + SHINGLES].tolist(), lasts[at : at + SHINGLES].tolist(), strict=True)
        yield np.array([digest(joined[a:b], seed) for a, b in spans], dtype=U64)


def fingerprint(text: bytes, width: int = WIDTH, seed: int = SEED) -> int:
    """A bit is set if more than half of the hashes have it."""
    ones, n = np.zeros(64, dtype=np.int64), 0
    for hashes in shingle_hashes(text, width, seed):
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0]) if n else 0


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, seed: int = SEED) -> DataFrame:
    """``id`` and ``fp`` (a signed 64-bit number) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py() or b"", width, seed) for t in batch.column("text")], dtype=U64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found.view(np.int64))], names=["id", "fp"])

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, "id long, fp long")


def gray_rank(fp: Column) -> Column:
    """Rank of a fingerprint in Gray order, shifted so that signed numbers sort alike."""
    for shift in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, shift))
    return fp.bitwiseXOR(F.lit(-(1 << 63)))


# ---------------------------------------------------------------- index over all leaves
def _leaf_rows(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(0, dtype=np.int64)
        for batch in batches:
            held = np.concatenate((held, batch.column("fp").to_numpy()))
            whole = len(held) // size * size
            if whole:
                yield _leaves(held[:whole].reshape(-1, size))
                held = held[whole:]
        if len(held):
            yield _leaves(held.reshape(1, -1))

    return run


def _leaves(rows: np.ndarray) -> pa.RecordBatch:
    both, some = np.bitwise_and.reduce(rows, axis=1), np.bitwise_or.reduce(rows, axis=1)
    return pa.RecordBatch.from_arrays(
        [pa.array([r.tobytes() for r in rows], pa.binary()), pa.array(~(both ^ some)), pa.array(both)],
        names=["fps", "mask", "pattern"],
    )


def _levels(leaves: DataFrame, n_leaves: int) -> list[DataFrame]:
    """Tables of nodes (no, parent, mask, pattern) from the leaves up to below the root."""
    nodes = leaves.select("no", "mask", "pattern")
    up, out = F.shiftright("no", FAN_OUT_BITS), []
    while True:
        out.append(nodes.withColumn("parent", up))
        n_leaves = -(-n_leaves >> FAN_OUT_BITS)
        if n_leaves <= 1:
            return out
        nodes = staged(
            nodes.groupBy(up.alias("no")).agg(
                F.bit_and("mask").alias("known"), F.bit_and("pattern").alias("both"), F.bit_or("pattern").alias("some")
            ).select(
                "no",
                F.col("known").bitwiseAND(F.bitwise_not(F.col("both").bitwiseXOR(F.col("some")))).alias("mask"),
                F.col("both").alias("pattern"),
            ),
            "nodes",
        )


def _leaf_pairs(levels: list[DataFrame], most: int) -> DataFrame:
    """Pairs of leaves (a <= b) that may hold fingerprints with ``most`` differences or fewer."""
    pairs = None
    for nodes in reversed(levels):
        left = nodes.select(F.col("parent").alias("pa"), *[F.col(c).alias(f"{c}_a") for c in ("no", "mask", "pattern")])
        right = nodes.select(F.col("parent").alias("pb"), *[F.col(c).alias(f"{c}_b") for c in ("no", "mask", "pattern")])
        if pairs is None:  # all these nodes, FAN_OUT at most, have one parent: the root
            pairs = left.select(F.col("pa").alias("a")).distinct().select(
                "a", F.col("a").alias("b"), F.lit(0).cast("long").alias("shared"), F.lit(0).alias("differences")
            )
        both = F.col("mask_a").bitwiseAND(F.col("mask_b"))
        new = both.bitwiseAND(F.bitwise_not(F.col("shared")))
        more = F.bit_count(F.col("pattern_a").bitwiseXOR(F.col("pattern_b")).bitwiseAND(new))
        met = pairs.join(left, F.col("a") == F.col("pa")).join(right, F.col("b") == F.col("pb")).where("no_a <= no_b")
        pairs = staged(
            met.select(
                F.col("no_a").alias("a"), F.col("no_b").alias("b"), both.alias("shared"),
                (F.col("differences") + more).alias("differences"),
            ).where(F.col("differences") <= most), "node-pairs",
        )
    return pairs


# ---------------------------------------------------------------- search within a task
class LeafIndex:
    """Index of one leaf: levels from the top, each with the bits it adds to its parent's."""

    def __init__(self, fps: np.ndarray):
        self.fps, levels = fps, []
        both, some = fps.copy(), fps.copy()
        mask = np.full(len(fps), U64(0xFFFFFFFFFFFFFFFF))
        levels.append((mask, both))
        while len(both) > 1:
            at = np.arange(0, len(both), INNER)
            both, some = np.bitwise_and.reduceat(both, at), np.bitwise_or.reduceat(some, at)
            levels.append((~(both ^ some), both))
        self.levels = []
        above = None
        for mask, pattern in reversed(levels):
            residual = mask if above is None else mask & ~np.repeat(above, INNER)[: len(mask)]
            self.levels.append((residual, pattern & residual))
            above = mask

    def search(self, queries: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of queries and of fingerprints with at most ``most`` differences."""
        q = np.arange(len(queries))
        node, differences = np.zeros(len(queries), dtype=np.int64), np.zeros(len(queries), dtype=np.uint8)
        for depth, (residual, pattern) in enumerate(self.levels):
            if depth:
                q, node, differences = np.repeat(q, INNER), np.repeat(node * INNER, INNER), np.repeat(differences, INNER)
                node += np.tile(np.arange(INNER), len(node) // INNER)
                inside = node < len(residual)
                q, node, differences = q[inside], node[inside], differences[inside]
            differences = differences + np.bitwise_count((queries[q] & residual[node]) ^ pattern[node])
            near = differences <= most
            q, node, differences = q[near], node[near], differences[near]
        return q, node


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node linked with it) for the nodes that have a smaller one."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        label = label[label]
        rest = label[a] != label[b]
        a, b = a[rest], b[rest]
    while (label[label] != label).any():
        label = label[label]
    found = np.flatnonzero(label != np.arange(n))
    return found, label[found]


def leaf_links(left: np.ndarray, right: np.ndarray | None, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between two leaves, or within one, as a forest over its fingerprints."""
    every = left if right is None else np.concatenate((left, right))
    index, shift = LeafIndex(left if right is None else right), 0 if right is None else len(left)
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    for at in range(0, len(left), STEP):
        q, found = index.search(left[at : at + STEP], most)
        q, found = q + at, found + shift
        apart = q != found
        parts.append(_forest(len(every), q[apart], found[apart]))
    a, b = _forest(len(every), *(np.concatenate(p) for p in zip(*parts, strict=True)))
    return every[a], every[b]


def _link_rows(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                own = batch.column("a")[i].as_py() == batch.column("b")[i].as_py()
                left, right = (np.frombuffer(batch.column(c)[i].as_buffer(), dtype="<u8") for c in ("fps_a", "fps_b"))
                a, b = leaf_links(left, None if own else right, most)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (a, b)], names=["a", "b"])

    return run


# ---------------------------------------------------------------- operator
def links(fps: DataFrame, most: int = MAX_DIFFERENCES, leaf: int = LEAF) -> DataFrame:
    """Of distinct fingerprints (``fp``): forests (``a``, ``b``) over all links of at most
    ``most`` differing bits."""
    ordered = fps.select("fp", gray_rank(F.col("fp")).alias("rank")).repartitionByRange("rank").sortWithinPartitions("rank")
    leaves = numbered(ordered.select("fp").mapInArrow(_leaf_rows(leaf), "fps binary, mask long, pattern long"), "no", "leaves")
    pairs = _leaf_pairs(_levels(leaves, leaves.count()), most)
    left = leaves.select(F.col("no").alias("a"), F.col("fps").alias("fps_a"))
    right = leaves.select(F.col("no").alias("b"), F.col("fps").alias("fps_b"))
    rows = pairs.select("a", "b").join(left, "a").join(right, "b")
    return staged(rows.mapInArrow(_link_rows(most), "a long, b long"), "links")


def simhash_components(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = MAX_DIFFERENCES, width: int = WIDTH,
    seed: int = SEED, leaf: int = LEAF,
) -> DataFrame:
    """One row per input row: ``id``, ``fp``, ``component`` (smallest id reachable by links
    of at most ``most`` differing bits, itself included)."""
    rows = staged(fingerprints(df, id_col, text_col, width, seed), "fingerprints")
    fps = staged(rows.groupBy("fp").agg(F.min("id").alias("first")), "distinct-fingerprints")
    found = components(links(fps, most, leaf))
    labelled = fps.join(found.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("label", "fp").alias("label")
    )
    smallest = labelled.groupBy("label").agg(F.min("first").alias("component"))
    named = labelled.join(smallest, "label").select("fp", "component")
    return rows.join(named, "fp").select("id", "fp", "component")
