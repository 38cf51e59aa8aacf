"""64-bit hashes of words and lines, computed over whole byte buffers with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

U64 = np.uint64
_RNG = np.random.default_rng(20240229)
_VALUES = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
_BASE = U64(0x9E3779B97F4A7C15)
#: Space, tab, line feed, vertical tab, form feed, carriage return.
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
BUFFER_BYTES = 1 << 21


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.full(n, _BASE, dtype=np.uint64))


_POWERS = _powers(1 << 12)


def scan(data: bytes, fold: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every word of ``data``; ``fold`` lower-cases A-Z."""
    b = np.frombuffer(data.translate(_LOWER) if fold else data, dtype=np.uint8)
    space = _SPACE[b]
    first = ~space
    first[1:] &= space[:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        return starts, np.zeros(0, dtype=np.uint64)
    place = np.arange(len(b)) - starts[np.maximum(np.cumsum(first) - 1, 0)]
    place[space] = 0
    longest = int(place.max())
    powers = _POWERS if longest < len(_POWERS) else _powers(longest + 1)
    terms = _VALUES[b] * powers[place]
    terms[space] = 0
    return starts, mix(np.add.reduceat(terms, starts))


def buffers(texts: list[str | None], limit: int = BUFFER_BYTES) -> Iterator[tuple[list[int], list[bytes]]]:
    """Texts as UTF-8 in groups of about ``limit`` bytes; their places in ``texts``."""
    at, group, size = [], [], 0
    for i, text in enumerate(texts):
        data = (text or "").encode("utf-8")
        at.append(i)
        group.append(data)
        size += len(data)
        if size >= limit:
            yield at, group
            at, group, size = [], [], 0
    if at:
        yield at, group


def _slices(data: bytes) -> Iterator[bytes]:
    """A very long text in stretches that end between words."""
    at = 0
    while len(data) - at > 2 * BUFFER_BYTES:
        tail = np.flatnonzero(_SPACE[np.frombuffer(data, np.uint8, count=BUFFER_BYTES, offset=at + BUFFER_BYTES)])
        if not len(tail):
            break
        cut = at + BUFFER_BYTES + int(tail[0])
        yield data[at:cut]
        at = cut
    yield data[at:]


def words(group: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (A-Z lower-cased) of all texts of a group, and the number of words of each.

    Unlike the sums of :func:`scan`, XXH3 has no structure that would give words of a pattern one hash.
    """
    parts, counts, digest = [], [], xxhash.xxh3_64_intdigest
    for data in group:
        n = 0
        for part in _slices(data):
            found = part.translate(_LOWER).split()
            parts.append(np.fromiter(map(digest, found), np.uint64, len(found)))
            n += len(found)
        counts.append(n)
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint64), np.array(counts, dtype=np.int64)
