"""Jaccard self-join on word shingles with PartEnum signatures.

Two sets of s and t shingles whose Jaccard similarity is at least 3/4 differ in at most
(s + t) // 7 shingles. Pairs are grouped into bands by that bound, doubling from band to
band. In a band the shingle domain is cut into more partitions than shingles may differ,
and a set's signatures are the contents of single partitions: of the subsets that PartEnum
enumerates these are the fewest (n2 = k2 + 1). A set with bound k needs only its first k + 1
non-empty partitions: of the partitions before the first one that both sets agree on, each
is spoiled by a difference. Sets with fewer non-empty partitions, and the small bands,
use single shingles as partitions. So no pair above the threshold is lost.

Each set emits some signatures more than it needs. So two similar sets share several, and
a pair is compared only if it shares as many as it must. And a set with few signatures in
crowded buckets can leave these without losing a partner; those who stay are mostly large
groups of near copies. In crowded buckets sets are compared with the smallest of them, not
with each other. The Jaccard distance is a metric: a set within 1/4 of that leader can't be
similar to one more than 1/2 away, and sets linked with one leader are one component
already. Of the buckets that still hold several components, the sets are compared in blocks
of bounded size, each pair of blocks by one matrix product.

Equal sets are one node, named by the first of two 64-bit digests. Where different sets
share it, all of them are named by both (``Names``), until no name is shared: about n * n / 2^65
digests of n sets, so the list of them fits anywhere. Shingles are compared by 64-bit hashes. Only signature rows, candidate pairs and the texts in them are moved.

Defined results: NULL, empty and blank texts have no shingles and no links, texts under
``width`` words are one shingle, rows with one id are one document, extra columns are
ignored, an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from railcadence.llm import wordhash
from railcadence.llm.common import staged
from railcadence.llm.components import components
from railcadence.llm.wordhash import U64, mix

WIDTH = 5
#: The signature scheme is worked out for this threshold: 3/4.
NEAR, WHOLE = 75, 100
#: Up to this bound single shingles are the partitions.
FINE = 8
#: Partitions per unit of the bound of a band.
PARTITIONS = 1.3
#: Buckets of more sets than this are crowded.
CROWD = 8
#: Sets per block and shingles per step where what is left is compared block by block.
BLOCK, COLUMNS = 256, 4096
#: Digests a task remembers, so that it sends the signatures of equal sets once.
SEEN = 200_000

_STEP = U64(0xD6E8FEB86659FD93)
_SET_ROW = "id long, n long, node long, check long"


# ---------------------------------------------------------------- sets
def shingle_sets(group: list[bytes], width: int = WIDTH) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text of a group."""
    hashes, counts = wordhash.words(group)
    total = np.zeros(max(0, len(hashes) - width + 1), dtype=np.uint64)
    for j in range(width):
        total = total * _STEP + hashes[j : j + len(total)]
    total = mix(total)
    sets, at = [], 0
    for n in counts.tolist():
        if n >= width:
            s = np.sort(total[at : at + n - width + 1])
            sets.append(s[np.concatenate(([True], s[1:] != s[:-1]))])
        elif n:
            one = U64(n)
            with np.errstate(over="ignore"):
                for h in hashes[at : at + n]:
                    one = one * _STEP + h
            sets.append(mix(np.array([one], dtype=np.uint64) ^ U64(0xA5A5)))
        else:
            sets.append(np.zeros(0, dtype=np.uint64))
        at += n
    return sets


def digests(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sizes and two 64-bit digests of each set, as signed numbers."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    out = np.zeros((2, len(sets)), dtype=np.uint64)
    some = np.flatnonzero(sizes)
    if len(some):
        flat = np.concatenate([sets[i] for i in some])
        starts = np.concatenate(([0], np.cumsum(sizes[some])[:-1]))
        for k, salt in enumerate((0x1F83D9ABFB41BD6B, 0x5BE0CD19137E2179)):
            out[k, some] = mix(np.add.reduceat(mix(flat ^ U64(salt)), starts) + sizes[some].astype(np.uint64))
    return sizes, out[0].view(np.int64), out[1].view(np.int64)


@dataclass(frozen=True)
class Names:
    """How sets are named. ``clashes`` are first digests that different sets share; ``bits`` (for
    tests) shortens the first digest so that they do."""

    clashes: frozenset[int] = frozenset()
    bits: int = 64
    attempt: int = 0

    def of(self, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sizes, names and second digests."""
        sizes, names, second = digests(sets)
        names &= np.int64(-1 << (64 - self.bits))
        if self.clashes:
            both = mix((names.view(np.uint64) + U64(self.attempt)) * _STEP + second.view(np.uint64)).view(np.int64)
            shared = np.fromiter((x in self.clashes for x in names.tolist()), dtype=bool, count=len(names))
            names = np.where(shared, both, names)
        return sizes, names, second

    def and_clashes(self, found: list[int]) -> Names:
        return Names(self.clashes | frozenset(found), self.bits, self.attempt + 1)


# ---------------------------------------------------------------- signatures
def bands(size: int) -> list[tuple[int, int]]:
    """(band, most differences) for all bands that a set of this size has partners in."""
    low, high = (size + -(-3 * size // 4)) // 7, (size + 4 * size // 3) // 7
    if high < 1:
        return []  # only an equal set is similar enough
    first, last = (max(low, 1) - 1).bit_length(), (high - 1).bit_length()
    return [(j, min(high, 1 << j)) for j in range(first, last + 1)]


def spare(bound: int) -> int:
    """Signatures beyond those needed; sets of the small bands emit all they have."""
    return 3 + bound // 8 if bound > FINE else 4 * FINE


#: Size, band and signatures to spare of a row, in one number.
SLACK_BITS, BAND_BITS = 12, 6


def _info(size: int, band: int, slack: int) -> int:
    return ((size << BAND_BITS) + band << SLACK_BITS) + min(slack, (1 << SLACK_BITS) - 2) + 1


def signatures(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of a set and, for each, its size, band and what its scheme has to spare."""
    out, infos = [], []

    def emit(sigs: np.ndarray, band: int, slack: int) -> None:
        out.append(mix(sigs))
        infos.append(np.full(len(sigs), _info(len(s), band, slack), dtype=np.int64))

    for band, k in bands(len(s)):
        bound = 1 << band
        want = k + 1 + spare(bound)
        if bound <= FINE:
            first = s[:want]
            emit(first + U64((band << 1) + 1), band, len(first) - k - 1)
            continue
        n_parts = int(PARTITIONS * bound) + 1
        part = ((s >> U64(32)) * U64(n_parts)) >> U64(32)
        starts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
        upto = starts[want] if len(starts) > want else len(s)
        starts = starts[:want]
        content = np.add.reduceat(mix(s[:upto] ^ U64(0x3C6EF372FE94F82B)), starts)
        short = len(starts) <= k
        emit(content + part[starts] * _STEP + U64(band << 1), band, -1 if short else len(starts) - k - 1)
        if short:
            emit(s[: k + 1] + U64((band << 1) + 1), band, -1)
    if not out:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    return np.concatenate(out), np.concatenate(infos)


def _set_rows(batches: Iterator[pa.RecordBatch], names: Names) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, group in wordhash.buffers(batch.column("text").to_pylist()):
            sizes, node, check = names.of(shingle_sets(group))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(at)), pa.array(sizes), pa.array(node), pa.array(check)],
                names=["id", "n", "node", "check"],
            )


def _signature_rows(batches: Iterator[pa.RecordBatch], names: Names) -> Iterator[pa.RecordBatch]:
    seen: set[int] = set()
    for batch in batches:
        for _, group in wordhash.buffers(batch.column("text").to_pylist()):
            sets = shingle_sets(group)
            found, nodes, infos = [], [], []
            for s, node in zip(sets, names.of(sets)[1].tolist(), strict=True):
                if node in seen:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(node)
                sig, info = signatures(s)
                found.append(sig)
                infos.append(info)
                nodes.append(np.full(len(sig), node))
            if found:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(found).view(np.int64)),
                        pa.array(np.concatenate(nodes).astype(np.int64)),
                        pa.array(np.concatenate(infos)),
                    ],
                    names=["sig", "node", "info"],
                )


def _shared_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted rows each (sig, node) once, without signatures that only one set has. The
    first and last row of a partition stay: their neighbours may be in another one."""
    names = ["sig", "node", "info"]
    tail, tail_stays = None, True
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(c).to_numpy() for c in names]
        stays = np.zeros(batch.num_rows, dtype=bool)
        if tail is None:
            stays[0] = True
        else:
            columns = [np.concatenate((t, c)) for t, c in zip(tail, columns, strict=True)]
            stays = np.concatenate(([tail_stays], stays))
        sig, node, _ = columns
        new = np.concatenate(([True], (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])))
        columns, stays = [c[new] for c in columns], stays[new]
        equal = columns[0][1:] == columns[0][:-1]
        stays[1:] |= equal
        stays[:-1] |= equal
        tail, tail_stays = [c[-1:] for c in columns], bool(stays[-1])
        yield pa.RecordBatch.from_arrays([pa.array(c[:-1][stays[:-1]]) for c in columns], names=names)
    if tail is not None:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in tail], names=names)


def _with(rows: DataFrame, key: str, *aggregates: Column) -> DataFrame:
    """``rows`` with aggregates of their group. Unlike a window, aggregate and join let Spark
    combine before the shuffle and split a group that holds a large part of all rows."""
    return rows.join(rows.groupBy(key).agg(*aggregates), key)


# ---------------------------------------------------------------- verification
def _own_text(batches: Iterator[pa.RecordBatch], names: Names) -> Iterator[pa.RecordBatch]:
    """Rows whose text has the node's shingles: an id may be repeated with another text."""
    last = None
    for batch in batches:
        nodes, keep = batch.column("node").to_pylist(), []
        for at, group in wordhash.buffers(batch.column("text").to_pylist()):
            for i, node in zip(at, names.of(shingle_sets(group))[1].tolist(), strict=True):
                if node == nodes[i] and node != last:
                    keep.append(i)
                    last = node
        yield batch.take(pa.array(keep, pa.int64()))


def _compare_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sizes of intersection and union; rows of one leader follow each other."""
    last, lead = None, None
    for batch in batches:
        texts, heads = batch.column("text"), batch.column("lead_text")
        a, b = batch.column("lead").to_pylist(), batch.column("node").to_pylist()
        shared, union = [], []
        for at, group in wordhash.buffers(texts.to_pylist()):
            for i, s in zip(at, shingle_sets(group), strict=True):
                if a[i] != last:
                    last, lead = a[i], shingle_sets([heads[i].as_py().encode("utf-8")])[0]
                where = np.minimum(np.searchsorted(lead, s), len(lead) - 1)
                common = int((lead[where] == s).sum())
                shared.append(common)
                union.append(len(lead) + len(s) - common)
        yield pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(shared, pa.int64()), pa.array(union, pa.int64())],
            names=["lead", "node", "shared", "total"],
        )


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``lead``, ``node``, ``near`` (at the threshold), ``mid`` (within 1/2)."""
    rows = pairs.join(texts, "node").join(
        texts.select(F.col("node").alias("lead"), F.col("text").alias("lead_text")), "lead"
    )
    found = rows.sortWithinPartitions("lead").mapInArrow(
        _compare_rows, "lead long, node long, shared long, total long"
    )
    return staged(
        found.select(
            "lead", "node", (F.col("shared") * WHOLE >= F.col("total") * NEAR).alias("near"),
            (F.col("shared") * 2 >= F.col("total")).alias("mid"),
        ).distinct(),
        "verified",
    )


def _texts(documents: DataFrame, nodes: DataFrame, needed: DataFrame, names: Names) -> DataFrame:
    """Text of one document for each needed node."""
    found = documents.join(needed.join(nodes, "node"), F.col("id").eqNullSafe(F.col("first")))
    return staged(found.select("node", "text").mapInArrow(partial(_own_text, names=names), "node long, text string"), "texts")


# ---------------------------------------------------------------- operator
def _named(documents: DataFrame, names: Names) -> tuple[DataFrame, DataFrame, Names]:
    """The set of each document, one row per node with its ``first`` document, and names that
    no two different sets share."""
    while True:
        sets = staged(documents.mapInArrow(partial(_set_rows, names=names), _SET_ROW), "sets")
        nodes = staged(sets.where("n > 0").groupBy("node").agg(
            F.min("id").alias("first"), (F.min("check") != F.max("check")).alias("clash")
        ), "nodes")
        found = [r["node"] for r in nodes.where("clash").select("node").collect()]
        if not found:
            return sets, nodes.select("node", "first"), names
        names = names.and_clashes(found)


def jaccard_components(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", crowd: int = CROWD, digest_bits: int = 64
) -> DataFrame:
    """One row per input row: ``id``, ``n_shingles``, ``component`` (smallest id reachable
    by links of Jaccard similarity 3/4 or more, itself included)."""
    documents = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    sets, nodes, names = _named(documents, Names(bits=digest_bits))

    # Ranges of (sig, node), not of sig: a bucket of very many sets is split over tasks.
    shared = staged(
        documents.mapInArrow(partial(_signature_rows, names=names), "sig long, node long, info long")
        .repartitionByRange("sig", "node").sortWithinPartitions("sig", "node")
        .mapInArrow(_shared_rows, "sig long, node long, info long"), "signatures",
    )
    rows = _with(shared, "sig", F.count("*").alias("n_sets")).where("n_sets > 1")
    rows = staged(rows.select("sig", "node", "info", (F.col("n_sets") > crowd).alias("crowded")), "buckets").select(
        "sig", "node", "crowded", F.shiftright("info", SLACK_BITS + BAND_BITS).alias("n"),
        F.shiftright("info", SLACK_BITS).bitwiseAND(F.lit((1 << BAND_BITS) - 1)).alias("band"),
        (F.col("info").bitwiseAND(F.lit((1 << SLACK_BITS) - 1)) - 1).alias("slack"),
    )
    held = staged(
        rows.groupBy("node", "band").agg(
            F.min("slack").alias("slack"), F.count_if("crowded").alias("n_crowded"), F.first("n").alias("n")
        ), "held",
    )
    pairs = staged(_candidates(rows.where("not crowded"), held), "pairs")
    stay = held.where("n_crowded > slack").select("node", "band")
    rows = staged(rows.where("crowded").join(stay, ["node", "band"]).select("sig", "node"), "buckets")
    rows = staged(_with(rows, "sig", F.min("node").alias("lead")), "buckets")
    involved = pairs.select(F.col("lead").alias("node")).union(pairs.select("node")).union(rows.select("node")).distinct()
    texts = _texts(documents, nodes, involved, names)
    pairs = staged(pairs.union(rows.where("node <> lead").select("lead", "node")).distinct(), "pairs")
    done = _verified(pairs, texts)
    labels = _components(done.where("near"))
    rest = staged(_unsettled(rows, done, labels), "rest")
    edges = done.where("near").select("lead", "node").union(_block_links(rest, texts))
    return _labelled(sets, _components(staged(edges, "links")))


def _components(edges: DataFrame) -> DataFrame:
    return components(edges.select(F.col("lead").alias("a"), F.col("node").alias("b")))


def _candidates(rows: DataFrame, held: DataFrame) -> DataFrame:
    """Pairs that share as many signatures of a band as similar sets must. Those in crowded
    buckets aren't seen here and count as shared."""
    left = rows.select("sig", "band", F.col("node").alias("lead"), F.col("n").alias("lead_n"))
    met = rows.select("sig", "band", "node", "n").join(left, ["sig", "band"]).where(
        "lead < node and 4 * least(n, lead_n) >= 3 * greatest(n, lead_n)"
    ).groupBy("lead", "node", "band").agg(F.count("*").alias("met"))
    a = held.select("band", F.col("node").alias("lead"), F.col("slack").alias("s0"), F.col("n_crowded").alias("c0"))
    b = held.select("band", "node", F.col("slack").alias("s1"), F.col("n_crowded").alias("c1"))
    return met.join(b, ["band", "node"]).join(a, ["band", "lead"]).where(
        "met >= least(s0, s1) + 1 - least(c0, c1)"
    ).select("lead", "node").distinct()


def _unsettled(rows: DataFrame, done: DataFrame, labels: DataFrame) -> DataFrame:
    """Buckets without their leader and, where nothing was in between, without the sets near
    it; only those that still hold several components."""
    left = rows.where("node <> lead").join(done, ["lead", "node"], "left").join(labels, "node", "left").select(
        "sig", "node", "near", (F.col("mid") & ~F.col("near")).alias("apart"), F.coalesce("label", "node").alias("label")
    )
    left = _with(staged(left, "left"), "sig", F.max("apart").alias("between")).where("between or not near")
    left = _with(
        staged(left, "left"), "sig",
        F.min("label").alias("low"), F.max("label").alias("high"), F.min("node").alias("first"),
    ).where("low <> high").select("sig", "node", "first")
    # A set has nearly the same group in all its buckets then, and is placed once or twice.
    left = staged(_with(staged(left, "left"), "node", F.min("first").alias("own")).select("sig", "node", "own"), "left")
    return _with(left, "sig", F.min("own").alias("lead")).select("lead", "node").distinct()


def _block_links(groups: DataFrame, texts: DataFrame) -> DataFrame:
    """Links within each group (``lead``, ``node``), as trees over the linked sets."""
    sizes = groups.groupBy("lead").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("n_blocks"))
    placed = groups.join(sizes, "lead").withColumn("block", F.pmod(F.xxhash64("node"), F.col("n_blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1))
    cells = placed.select("lead", "node", "block", other.alias("other")).select(
        "lead", "node", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        (F.col("block") > F.col("other")).alias("second"),
    )
    return cells.join(texts, "node").groupBy("lead", "i", "j").applyInPandas(_compare_blocks, "lead long, node long")


def _compare_blocks(cell: pd.DataFrame) -> pd.DataFrame:
    """A block with itself, or two blocks with each other."""
    cell = cell.sort_values("node")
    sets: list[np.ndarray] = []
    for _, group in wordhash.buffers(cell["text"].tolist()):
        sets += shingle_sets(group)
    own = bool((cell["i"] == cell["j"]).all())
    second = cell["second"].to_numpy()
    left = np.flatnonzero(~second)
    right = left if own else np.flatnonzero(second)
    sizes = np.array([len(s) for s in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    column = np.where(count > 1, np.cumsum(count > 1) - 1, -1)[column]  # of shingles that several sets have
    owner = np.repeat(np.arange(len(sets)), sizes)[column >= 0]
    column = column[column >= 0]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    shared = np.zeros((len(left), len(right)), dtype=np.float32)
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, (at, at + COLUMNS))
        has = np.zeros((len(sets), COLUMNS), dtype=np.float32)
        has[owner[a:b], column[a:b] - at] = 1
        shared += has[left] @ has[right].T
    total = sizes[left][:, None] + sizes[right][None, :] - shared
    linked = np.zeros((len(sets), len(sets)), dtype=bool)
    linked[np.ix_(left, right)] = shared * WHOLE >= total * NEAR
    linked |= linked.T
    nodes, free, out = cell["node"].to_numpy(), np.ones(len(sets), dtype=bool), []
    for root in range(len(sets)):
        todo = [root] if free[root] else []
        free[root] = False
        while todo:
            x = todo.pop()
            found = np.flatnonzero(linked[x] & free)
            free[found] = False
            todo += found.tolist()
            out += [(nodes[x], nodes[y]) for y in found]
    return pd.DataFrame(out, columns=["lead", "node"]).astype(np.int64)


def _labelled(sets: DataFrame, labels: DataFrame) -> DataFrame:
    rows = sets.join(labels, "node", "left").select(
        "id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.coalesce("label", "node")).alias("label")
    )
    groups = rows.where("label is not null").groupBy("label").agg(
        F.min("id").alias("component"), F.count("*").alias("size")
    ).where("size > 1")
    return rows.join(groups, "label", "left").select(
        "id", "n_shingles", F.coalesce("component", "id").alias("component")
    )


def one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of the smallest id of each component, with all columns of ``df``."""
    found = jaccard_components(df, id_col, text_col)
    dropped = found.groupBy("id").agg(F.max(F.col("id").eqNullSafe(F.col("component"))).alias("stays")).where("not stays")
    dropped = dropped.select(F.col("id").alias("dropped id"))
    return df.join(dropped, F.col(id_col).eqNullSafe(F.col("dropped id")), "left_anti")
