"""Benchmark decontamination with one Aho-Corasick automaton.

Windows of ten words of every test item form one automaton. Each distinct word of the items has
a code of two or three letters in it, so the automaton is a fraction of the one over the texts. A
document's words are coded the same way and scanned once; matches are mapped back to
words and to character offsets of the original text. Documents need no shuffle: only
the items are sent out, after a look at their size, and a worker builds the automaton once.

Defined results: NULL and empty texts have no words and no hits, items without words
have no windows, equal items all count, repeated documents are judged one by one, extra
columns are ignored, an empty benchmark or document table gives no hits or no rows.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

WINDOW = 10
#: Larger benchmarks are refused. Items of random words, the costliest case, took about 215
#: times their bytes in each Python worker: 650 MB at this limit.
MAX_ITEM_BYTES = 3_000_000
#: Letters of one place of a code; every place has its own, so codes match at word borders only.
BASE = 256

#: A-Z becomes a-z, digits and a-z stay, other ASCII separates words.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text: str | None) -> list[str]:
    found = text.encode("utf-8").translate(_FOLD).split() if text else []
    return b" ".join(found).decode("utf-8").split(" ") if found else []


class Windows:
    """The automaton of all windows; each carries its word count and its items."""

    def __init__(self, items: list[tuple[int, str]], window: int = WINDOW):
        numbers: dict[str, int] = {}
        texts = [(item_id, [numbers.setdefault(w, len(numbers)) for w in words(text)]) for item_id, text in items]
        self.width = 1
        while BASE**self.width < len(numbers):
            self.width += 1
        self.unknown = "\0" * self.width
        self.codes = {w: self._code(k) for w, k in numbers.items()}
        letters = list(self.codes.values())
        self.automaton = ahocorasick.Automaton()
        for item_id, w in texts:
            for i in range(max(1, len(w) - window + 1) if w else 0):
                part = w[i : i + window]
                pattern = "".join([letters[k] for k in part])
                n, ids = self.automaton.get(pattern, (len(part), ()))
                if not ids or ids[-1] != item_id:
                    self.automaton.add_word(pattern, (n, (*ids, item_id)))
        if len(self.automaton):
            self.automaton.make_automaton()

    def _code(self, number: int) -> str:
        return "".join(chr(1 + j * BASE + number // BASE**j % BASE) for j in range(self.width))


#: The automaton that this worker built last, under the name of its call.
_BUILT: dict[str, Windows] = {}


def _built(name: str, items: list[tuple[int, str]], window: int) -> Windows:
    if name not in _BUILT:
        _BUILT.clear()
        _BUILT[name] = Windows(items, window)
    return _BUILT[name]


def scan(windows: Windows, text: str | None) -> tuple[int, int, list, list]:
    """Words, hit words, items found, and hit stretches as (start, end) in ``text``."""
    found = words(text)
    n = len(found)
    if not n or not len(windows.automaton):
        return n, 0, [], []
    codes, unknown = windows.codes, windows.unknown
    ends, sizes, items = [], [], set()
    for end, (size, ids) in windows.automaton.iter("".join([codes.get(w, unknown) for w in found])):
        ends.append(end)
        sizes.append(size)
        items.update(ids)
    if not ends:
        return n, 0, [], []
    after = np.array(ends) // windows.width + 1
    steps = np.zeros(n + 1, dtype=np.int64)
    np.add.at(steps, after - np.array(sizes), 1)
    np.add.at(steps, after, -1)
    hit = np.cumsum(steps[:-1]) > 0
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
    spans = [m.span() for m in _WORD.finditer(text)]
    stretches = [(spans[a][0], spans[b - 1][1]) for a, b in zip(edges[::2], edges[1::2], strict=True)]
    return n, int(hit.sum()), sorted(items, key=lambda x: (x is None, x)), stretches


def contamination(
    documents: DataFrame, benchmark: DataFrame, text_col: str = "text", into: str = "hits",
    item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
    max_item_bytes: int = MAX_ITEM_BYTES,
) -> DataFrame:
    """``documents`` with a column ``into``: ``n_words``, ``n_hit``, ``items``, ``stretches``.

    ``stretches`` are the hit parts as character offsets of the original text.
    """
    spark = documents.sparkSession
    tests = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).alias("text"))
    n_bytes = tests.select(F.sum(F.octet_length("text"))).first()[0] or 0
    if n_bytes > max_item_bytes:
        raise ValueError(f"the test items have {n_bytes} bytes; split them into tables of {max_item_bytes} bytes")
    items = spark.sparkContext.broadcast([(r[0], r[1]) for r in tests.collect()])
    name = uuid.uuid4().hex

    @F.pandas_udf(
        "n_words long, n_hit long, items array<long>, stretches array<struct<start:long,end:long>>"
    )
    def hits(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        windows = _built(name, items.value, window)
        for texts in batches:
            found = [scan(windows, t) for t in texts]
            yield pd.DataFrame({
                "n_words": np.array([x[0] for x in found], dtype=np.int64),
                "n_hit": np.array([x[1] for x in found], dtype=np.int64),
                "items": pd.Series([x[2] for x in found], dtype=object),
                "stretches": pd.Series([[{"start": a, "end": b} for a, b in x[3]] for x in found], dtype=object),
            })

    return documents.withColumn(into, hits(F.col(text_col)))
