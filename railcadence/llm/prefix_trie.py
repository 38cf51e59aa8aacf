"""Prefix trie over rebuilt conversations with composable fingerprints.

A conversation is rebuilt from the head of its group's first conversation and its own turns
after as many. No rebuilt text is put together: a turn's digest is a letter of a polynomial
fingerprint, and fingerprints form a monoid. The fingerprint of a rebuilt prefix follows from
three stored products, the head's, the own prefix's and that of the own turns left out:
``own + (head - left_out) * base ** (turns between)``. Word counts compose the same way.

A conversation may be very long. Turns are range-partitioned in order, products run within
partitions, and what reaches into a partition from the ones before is one product per
partition, composed in their order. Prefixes of equal depth and fingerprint are a group; its
turns are references to stored turns, and every group's last turns are compared in full
with that of the group's first reference. Fingerprints can be taken apart again: if prefixes and
last turns are equal, so are the prefixes one turn shorter, and hence all turns. Should
a comparison fail, the whole is done again with other letters and bases.

Sums over subtrees are sums over members: a leaf counts through its smallest member, and what
a member repeats below a node is a difference of two of its word counts.

Defined results: rows without a conversation id belong to none and are left out, ids below zero
have groups of the same size (-20 to -1), NULL roles and texts are empty, NULL turns come first, equal turns are ordered by the first
``LEAD`` characters of role and text and then by a digest, repeated rows are turns, extra
columns are ignored, an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from railcadence.llm.common import numbered, staged

GROUP = 20
HEADS = 4
LEAD = 32
PRIME = (1 << 61) - 1
#: Bytes of conversation ids that a row holds on their way to a digest.
IDS_BYTES = 1 << 20


# ---------------------------------------------------------------- fingerprints
class Monoid:
    """Two polynomial fingerprints of letter sequences modulo a prime, and word counts."""

    def __init__(self, salt: int):
        seed = hashlib.sha256(f"bases {salt}".encode()).digest()
        self.salt = salt.to_bytes(8, "little")
        self.bases = [int.from_bytes(seed[8 * k : 8 * k + 8], "little") % (PRIME - 2) + 2 for k in (0, 1)]

    def letter(self, digest: bytes) -> tuple[int, int]:
        d = hashlib.blake2b(digest, digest_size=16, key=self.salt).digest()
        return int.from_bytes(d[:8], "little") % PRIME, int.from_bytes(d[8:], "little") % PRIME

    def extended(self, x: tuple, letter: tuple, words: int) -> tuple:
        """Products are (turns, first, second, words)."""
        b, c = self.bases
        return x[0] + 1, (x[1] * b + letter[0]) % PRIME, (x[2] * c + letter[1]) % PRIME, x[3] + words

    def joined(self, x: tuple, y: tuple) -> tuple:
        """The product of a sequence followed by another."""
        n = y[0]
        first, second = ((x[k] * pow(self.bases[k - 1], n, PRIME) + y[k]) % PRIME for k in (1, 2))
        return x[0] + n, first, second, x[3] + y[3]

    def rebuilt(self, head: tuple, own: tuple, left_out: tuple) -> tuple:
        """``head`` followed by what ``own`` has after ``left_out``."""
        n = own[0] - left_out[0]
        first, second = (
            (own[k] + (head[k] - left_out[k]) * pow(self.bases[k - 1], n, PRIME)) % PRIME for k in (1, 2)
        )
        return head[0] + n, first, second, head[3] + own[3] - left_out[3]


EMPTY = (0, 0, 0, 0)


# ---------------------------------------------------------------- products along conversations
def _stored_turns(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """conv, role, text, digest, words in order; ``ref`` numbers them all."""
    rows = df.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    sized = F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    spaced = F.trim(F.regexp_replace("text", r"[\x20\x09-\x0D]+", " "))
    rows = rows.select(
        "*", F.sha2(sized.cast("binary"), 256).alias("digest"),
        F.when(spaced == "", 0).otherwise(F.length(spaced) - F.length(F.replace(spaced, F.lit(" "))) + 1).cast("long").alias("words"),
    )
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.substring("role", 1, LEAD), F.substring("text", 1, LEAD), F.col("digest")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return numbered(ordered.select("conv", "role", "text", "digest", "words"), "ref", "turns")


_PRODUCT = ("n", "p", "q", "pw")


def _products(turns: DataFrame, monoid: Monoid) -> DataFrame:
    """conv, ref, words and the product of the conversation up to the turn: n, p, q, pw."""
    schema = "conv long, ref long, words long, n long, p long, q long, pw long, part int, opens boolean"
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, conv, x, opens = TaskContext.get().partitionId(), None, EMPTY, True
        for batch in batches:
            convs, refs, words, out = *(batch.column(c).to_pylist() for c in ("conv", "ref", "words")), []
            for c, digest, w in zip(convs, batch.column("digest").to_pylist(), words, strict=True):
                if c != conv:
                    opens, conv, x = conv is None, c, EMPTY
                x = monoid.extended(x, monoid.letter(digest.encode()), w)
                out.append((*x, opens))
            if out:
                columns = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in (convs, refs, words, *columns[:4])]
                    + [pa.array([part] * len(out), pa.int32()), pa.array(columns[4])], names=names,
                )

    # rows of the staged turns in their order, however the files are dealt to tasks
    ordered = turns.select("conv", "ref", "words", "digest").repartitionByRange("ref").sortWithinPartitions("ref")
    local = staged(ordered.mapInArrow(run, schema), "products")
    # The last product of every partition, and whether its conversation opens the partition.
    last = F.max_by(F.struct("conv", *_PRODUCT, "opens"), "ref")
    reach: dict[int, tuple] = {}
    carried: tuple[int | None, tuple] = (None, EMPTY)
    ends = local.groupBy("part").agg(F.min("ref").alias("first"), F.min_by("conv", "ref").alias("conv"), last.alias("end"))
    for row in sorted(ends.collect(), key=lambda r: r["first"]):  # one row per partition
        if row["conv"] == carried[0]:
            reach[row["part"]] = carried[1]
        end, x = row["end"], tuple(row["end"][c] for c in _PRODUCT)
        carried = end["conv"], monoid.joined(carried[1], x) if end["opens"] and end["conv"] == carried[0] else x

    def carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = list(zip(*(batch.column(c).to_pylist() for c in (*_PRODUCT, "part", "opens")), strict=True))
            x = [monoid.joined(reach[r[4]], r[:4]) if r[5] and r[4] in reach else r[:4] for r in x]
            columns = list(zip(*x, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in names[:3]] + [pa.array(c, pa.int64()) for c in columns], names=names[:7]
            )

    return local.mapInArrow(carry, schema.rsplit(", ", 2)[0])


# ---------------------------------------------------------------- rebuilt conversations
def head_turns(conv: Column, heads: int = HEADS) -> Column:
    """How many turns a conversation takes over: a checksum of its id, below ``heads``."""
    return (F.crc32(conv.cast("string").cast("binary")) % heads).cast("int")


def _rebuilt(products: DataFrame, monoid: Monoid, group: int, heads: int) -> DataFrame:
    """A row per turn of each rebuilt conversation: conv, depth, p, q, pw, words, ref, size (its
    turns in all); and one of depth 0 for each conversation."""
    whole = F.struct(*_PRODUCT, "words", "ref")
    at = [F.max(F.when(F.col("n") == k, whole)).alias(f"h{k}") for k in range(1, heads)]
    convs = staged(products.groupBy("conv").agg(F.max("n").alias("own"), *at), "conversations")
    base = convs.select(F.col("conv").alias("base"), *[F.col(f"h{k}").alias(f"b{k}") for k in range(1, heads)])
    nothing = F.struct(*[F.lit(0).cast("long").alias(c) for c in (*_PRODUCT, "words")], F.lit(None).cast("long").alias("ref"))

    def nth(kind: str, n: Column) -> Column:
        """The product after ``n`` turns, of as many as there are."""
        found = nothing
        for k in range(1, heads):
            found = F.when((n >= k) & F.col(f"{kind}{k}").isNotNull(), F.col(f"{kind}{k}")).otherwise(found)
        return found

    taken = head_turns(F.col("conv"), heads)
    plans = convs.withColumn("base", F.col("conv") - F.pmod("conv", F.lit(group))).join(base, "base", "left").select(
        "conv", "own", taken.alias("taken"), nth("b", taken).alias("head"), nth("h", taken).alias("left_out"),
        F.array(*[F.when((taken >= k), F.col(f"b{k}")) for k in range(1, heads)]).alias("heads"),
    ).withColumn("size", F.col("head.n") + F.greatest(F.col("own") - F.col("taken"), F.lit(0)))
    plans = staged(plans, "plans")
    columns = ("conv", "depth", "p", "q", "pw", "words", "ref", "size")
    shared = plans.select("conv", "size", F.explode(F.filter("heads", lambda x: x.isNotNull())).alias("x")).select(
        "conv", F.col("x.n").alias("depth"), "x.p", "x.q", "x.pw", "x.words", "x.ref", "size"
    )
    roots = plans.select(
        "conv", *[F.lit(0).cast("long").alias(c) for c in ("depth", "p", "q", "pw", "words")],
        F.lit(None).cast("long").alias("ref"), "size",
    )
    # Spark splits the rows of a very long conversation in this join.
    rest = products.join(plans.select("conv", "size", "taken", "head", "left_out"), "conv").where("n > taken")

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def products_of(batch: pa.RecordBatch, prefix: str) -> Iterator[tuple]:
            return zip(*(batch.column(prefix + c).to_pylist() for c in _PRODUCT), strict=True)

        for batch in batches:
            sides = (products_of(batch, s) for s in ("head_", "own_", "left_"))
            found = list(zip(*(monoid.rebuilt(*x) for x in zip(*sides, strict=True)), strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv"), *[pa.array(c, pa.int64()) for c in found],
                 *[batch.column(c) for c in ("words", "ref", "size")]], names=list(columns),
            )

    flat = rest.select(
        "conv", "words", "ref", "size", *[F.col(c).alias(f"own_{c}") for c in _PRODUCT],
        *[F.col(f"head.{c}").alias(f"head_{c}") for c in _PRODUCT],
        *[F.col(f"left_out.{c}").alias(f"left_{c}") for c in _PRODUCT],
    )
    schema = ", ".join(f"{c} long" for c in columns)
    return roots.unionByName(shared).unionByName(flat.mapInArrow(compose, schema))


# ---------------------------------------------------------------- nodes
def _all_equal(rows: DataFrame, groups: DataFrame, turns: DataFrame) -> bool:
    """Whether the last turns of every group are equal, role and text."""
    key = ["depth", "p", "q"]
    pairs = rows.where("depth > 0").select(*key, "ref").distinct().join(
        groups.where("n_refs").select(*key, "first_ref"), key
    ).where("ref <> first_ref").select("ref", "first_ref").distinct()
    stored = turns.select("ref", "role", "text")
    other = turns.select(F.col("ref").alias("first_ref"), F.col("role").alias("role_b"), F.col("text").alias("text_b"))
    return pairs.join(stored, "ref").join(other, "first_ref").where("role <> role_b or text <> text_b").isEmpty()


def _ends_digests(rows: DataFrame) -> DataFrame:
    """node conv, depth and the digest of the ids of the conversations that end there. The ids are
    put in order and joined in ranges; one task per node only digests the pieces."""
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, first, held, size = None, None, [], 0

        def piece() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([node[0]]), pa.array([node[1]]), pa.array([first]), pa.array([",".join(held).encode()])],
                names=["rep", "depth", "first", "ids"],
            )

        for batch in batches:
            for rep, depth, conv in zip(*(batch.column(c).to_pylist() for c in ("rep", "depth", "conv")), strict=True):
                if held and ((rep, depth) != node or size >= IDS_BYTES):
                    yield piece()
                    held, size = [], 0
                if not held:
                    node, first = (rep, depth), conv
                held.append(str(conv))
                size += len(held[-1]) + 1
        if held:
            yield piece()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([node[0]]), pa.array([node[1]]), pa.array([digest.hexdigest()])], names=["rep", "depth", "ends_sha256"]
            )

        for batch in batches:
            for rep, depth, ids in zip(*(batch.column(c).to_pylist() for c in ("rep", "depth", "ids")), strict=True):
                if (rep, depth) == node:
                    digest.update(b",")
                else:
                    if node is not None:
                        yield row()
                    node, digest = (rep, depth), hashlib.sha256()
                digest.update(ids)
        if node is not None:
            yield row()

    ends = rows.where("depth = size").select("rep", "depth", "conv")
    found = ends.repartitionByRange("rep", "depth", "conv").sortWithinPartitions("rep", "depth", "conv").mapInArrow(
        pieces, "rep long, depth long, first long, ids binary"
    )
    return found.repartition("rep", "depth").sortWithinPartitions("rep", "depth", "first").mapInArrow(
        digests, "rep long, depth long, ends_sha256 string"
    )


def prefix_trie(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    group: int = GROUP, heads: int = HEADS,
) -> DataFrame:
    """One row per node: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``, ``last_ref`` (the stored
    turn its members end with there, NULL for the root)."""
    turns = _stored_turns(df, conv, turn, role, text)
    key, salt = ["depth", "p", "q"], 0
    while True:
        monoid = Monoid(salt)
        rows = staged(_rebuilt(_products(turns, monoid), monoid, group, heads), "prefixes")
        groups = staged(
            rows.groupBy(*key).agg(
                F.min("conv").alias("rep"), F.count("*").alias("n_convs"), F.max("size").alias("longest"),
                F.min("ref").alias("first_ref"), (F.min("ref") < F.max("ref")).alias("n_refs"),
                F.max("words").alias("words"), F.max("pw").alias("pw"),
            ), "groups",
        )
        if _all_equal(rows, groups, turns):
            break
        salt += 1
    rows = staged(
        rows.join(groups.select(*key, "rep", (F.col("longest") == F.col("depth")).alias("childless")), key).select(
            "conv", "depth", "size", "pw", "rep", "childless"
        ), "members",
    )
    # Below the depth at which a conversation is its node's smallest member it always is.
    other = F.col("rep") != F.col("conv")
    of_conv = rows.groupBy("conv").agg(
        F.coalesce(F.max(F.when(other, F.col("pw"))), F.lit(0)).alias("repeated"),
        F.max(F.when(other, F.col("depth"))).alias("joins_at"),
        F.max_by("rep", F.when(other, F.col("depth"))).alias("joins"),
        F.max(F.when((F.col("depth") == F.col("size")) & ~other & F.col("childless"), 1)).alias("leaf"),
    )
    of_conv = staged(of_conv, "of-conversations")
    sums = rows.join(of_conv.select("conv", "repeated", "leaf"), "conv").groupBy("rep", "depth").agg(
        F.coalesce(F.sum(F.when(other, F.col("repeated"))), F.lit(0)).alias("repeated"), F.coalesce(F.sum("leaf"), F.lit(0)).alias("n_leaves")
    )
    nodes = groups.join(of_conv.select(F.col("conv").alias("rep"), "joins_at", "joins"), "rep").withColumn(
        "parent", F.when(F.col("depth") == 0, None).when(F.col("joins_at") == F.col("depth") - 1, F.col("joins")).otherwise(F.col("rep"))
    )
    nodes = staged(nodes.select("rep", "depth", "parent", "n_convs", "words", "pw", "first_ref"), "nodes")
    children = nodes.where("depth > 0").groupBy(F.col("parent").alias("rep"), (F.col("depth") - 1).alias("depth")).agg(
        F.count("*").alias("n_children")
    )
    at = ["rep", "depth"]
    saved = F.col("repeated") - (F.col("n_convs") - 1) * (F.col("pw") - F.col("words"))
    nobody = hashlib.sha256(b"").hexdigest()
    return nodes.join(sums, at).join(children, at, "left").join(_ends_digests(rows), at, "left").select(
        F.col("rep").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs",
        F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_leaves", saved.alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(nobody)).alias("ends_sha256"), F.col("first_ref").alias("last_ref"),
    )
