"""Packing of token sequences by best-fit decreasing.

Documents are tokenised, overlong ones first cut into full windows, and the rest packed
where they are read, block by block: the longest piece first, into the open window with the
least room that still fits. A segment tree over remaining capacities finds that window.
Whatever padding is left above ``max_padding`` is removed by cutting the pieces of the
emptiest windows into the gaps of others. No row is moved between tasks, and a block
holds a bounded number of tokens.

Defined results: NULL and empty texts are the end token alone, every row is packed on its
own (repeated rows too), extra columns are ignored, an empty table gives no rows. A
sequence has ``window`` tokens at most; what it lacks is padding at its end.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

WINDOW = 2048
END_ID = 1
MAX_PADDING = 0.005
BLOCK_TOKENS = 6_000_000
CHUNK_CHARS = 1 << 20
OUT_TOKENS = 1_000_000

#: Byte-level pre-tokenisers start a new word at a space before a non-space.
_START = re.compile(r" (?=\S)")
#: Unicode's white space. Python's ``\s`` has some control characters more.
_WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: The pre-tokeniser's look-ahead keeps a state per character of such a run, up to a limit.
LONG_RUN = 100_000
_LONG_SPACE = re.compile(f"[{_WHITE}]{{{LONG_RUN},}}")


class Encoder:
    """Byte-level BPE ids of whole texts. ``path`` is a file of ranks with the vocabulary of
    the ``tokenizers`` file of the same name; the ids are the same and take a quarter of
    the time."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.ids, self.piece_ids = encoding.encode_ordinary, encoding._encode_single_piece

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids.

        A run of white space is one word of the pre-tokeniser, but for its last character if
        anything follows, which belongs to the next word. Very long runs are cut out there.
        """
        out, at = [], 0
        for m in _LONG_SPACE.finditer(text):
            out += [self.ids(chunk) for chunk in _chunks(text[at : m.start()])]
            at = m.end() if m.end() == len(text) else m.end() - 1
            out.append(self.piece_ids(text[m.start() : at]))
        out += [self.ids(chunk) for chunk in _chunks(text[at:] if at else text)]
        return b"".join([np.array(ids, dtype="<u4").tobytes() for ids in out])


def _chunks(text: str) -> Iterator[str]:
    """Bounded stretches of a text, cut where words start."""
    at = 0
    while len(text) - at > CHUNK_CHARS:
        m = _START.search(text, at + CHUNK_CHARS)
        if not m:
            break
        yield text[at : m.start()]
        at = m.start()
    if at < len(text):
        yield text[at:]


class RoomTree:
    """Segment tree over capacities 0..window: how many open windows have each."""

    def __init__(self, window: int):
        self.leaf = 1 << window.bit_length()
        self.count = [0] * (2 * self.leaf)

    def add(self, room: int, n: int) -> None:
        i = room + self.leaf
        while i:
            self.count[i] += n
            i >>= 1

    def tightest(self, length: int) -> int | None:
        """The least capacity of at least ``length`` that an open window has."""
        i, count = length + self.leaf, self.count
        if count[i]:
            return length
        while i > 1:
            if not i & 1 and count[i + 1]:
                i += 1
                while i < self.leaf:
                    i = 2 * i if count[2 * i] else 2 * i + 1
                return i - self.leaf
            i >>= 1
        return None


def best_fit_decreasing(lengths: Iterable[int], window: int) -> list[list[int]]:
    """Indices of ``lengths`` (each 1..window) by window."""
    lengths = np.asarray(lengths, dtype=np.int64)
    tree, open_at, bins = RoomTree(window), [[] for _ in range(window + 1)], []
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        room = tree.tightest(n)
        if room is None:
            b, room = len(bins), window
            bins.append([])
        else:
            b = open_at[room].pop()
            tree.add(room, -1)
        bins[b].append(i)
        if room > n:
            open_at[room - n].append(b)
            tree.add(room - n, 1)
    return bins


def pack(lengths: list[int], window: int = WINDOW, max_padding: float = MAX_PADDING) -> list[list[tuple[int, int, int]]]:
    """Sequences as lists of (index, start, length); pieces may be cut to fill gaps."""
    bins = [[(i, 0, lengths[i]) for i in b] for b in best_fit_decreasing(lengths, window)]
    used = [sum(p[2] for p in b) for b in bins]
    order = sorted(range(len(bins)), key=used.__getitem__)
    low, high, total = 0, len(order) - 1, sum(used)
    n_left = len(bins)
    while low < high and n_left * window - total > max_padding * n_left * window:
        source, target = bins[order[low]], bins[order[high]]
        room = window - used[order[high]]
        if not room:
            high -= 1
            continue
        i, start, n = source.pop()
        take = min(n, room)
        target.append((i, start + n - take, take))
        used[order[high]] += take
        used[order[low]] -= take
        if take < n:
            source.append((i, start, n - take))
        if not source:
            low, n_left = low + 1, n_left - 1
    return [b for b in bins if b]


def pack_documents(
    df: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
    end_id: int = END_ID, max_padding: float = MAX_PADDING, block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """One row per piece: ``id``, ``start``, ``length``, ``ids`` (little-endian unsigned
    32-bit), ``doc_tokens``, ``sequence_id``, ``offset``."""
    end = np.array([end_id], dtype="<u4").tobytes()
    schema = pa.schema([
        ("id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
        ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
    ])

    def packed(block: list[tuple], base: int) -> tuple[int, Iterator[pa.RecordBatch]]:
        sequences = pack([len(p[2]) // 4 for p in block], window, max_padding)

        def rows() -> Iterator[pa.RecordBatch]:
            out, n = [], 0
            for s, sequence in enumerate(sequences):
                offset = 0
                for i, start, length in sequence:
                    doc, first, data, total = block[i]
                    out.append((doc, first + start, length, data[4 * start : 4 * (start + length)], total, base + s, offset))
                    offset += length
                n += offset
                if n >= OUT_TOKENS or s + 1 == len(sequences):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema
                    )
                    out, n = [], 0

        return len(sequences), rows()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, block, held = TaskContext.get().partitionId() << 33, [], 0
        encoder = Encoder(rank_path, pattern)
        for batch in batches:
            texts = batch.column("text")
            for k, doc in enumerate(batch.column("id").to_pylist()):
                data = encoder.encode(texts[k].as_py() or "") + end
                total = len(data) // 4
                for first in range(0, total, window):
                    part = data[4 * first : 4 * (first + window)]
                    block.append((doc, first, part, total))
                    held += len(part) // 4
                if held >= block_tokens:
                    n, rows = packed(block, base)
                    yield from rows
                    base, block, held = base + n, [], 0
        if block:
            yield from packed(block, base)[1]

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(
        run, "id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    )
