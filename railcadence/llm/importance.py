"""Importance resampling towards a target text collection.

Texts are lower-cased (A-Z) and separators collapsed to single spaces. A regular expression
with lookarounds for word boundaries is then run with overlapping matches: one match per
word, whose groups are the runs of one, two and three words that start there. Their CRC-32
is continued from group to group, so no n-gram is put together.

The buckets of every document are staged once (two bytes per feature) and read three times:
for the bucket counts of the whole collection, which are ``n_buckets`` numbers at every size of
input, for the weights, and not at all for the draw, which orders ids and scores only. The
draw is a range-partitioned sort; a row's rank is its place in its partition plus the size of
the partitions before it.

Defined results: NULL, empty and separator-only texts have no features and weight 0, a NULL
id counts as an empty one and sorts last among ties, repeated rows are scored and ranked one
by one, extra columns are ignored, an empty target gives every bucket the gain of its own
count alone, an empty table gives no rows.
"""

from __future__ import annotations

import math
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from railcadence.llm.common import numbered, staged

N_BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 5
SEED = 42
OUT_BYTES = 1 << 22

#: A-Z becomes a-z; digits, a-z and all of UTF-8's other bytes stay; the rest separates.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
#: One word, the word after it and the word after that; texts have a space at both ends.
_GRAMS = regex.compile(rb"(?<= )([^ ]++)(?:( [^ ]++)( [^ ]++)?)?(?= )")


def collapsed(text: bytes) -> bytes:
    """Words with one space before each and one at the end; empty without words."""
    words = text.translate(_FOLD).split()
    return b" %s " % b" ".join(words) if words else b""


def ngram_spans(joined: bytes) -> Iterator[tuple[int, int]]:
    """(start, end) in a collapsed text of every run of one to three words."""
    for m in _GRAMS.finditer(joined, overlapped=True):
        start = m.start()
        for k in (1, 2, 3):
            if m.end(k) > 0:
                yield start, m.end(k)


def feature_buckets(joined: bytes, n_buckets: int = N_BUCKETS) -> tuple[int, array]:
    """Number of words, and the bucket of every feature of a collapsed text."""
    out, words, crc = array("H" if n_buckets <= 1 << 16 else "I"), 0, zlib.crc32
    add = out.append
    for m in _GRAMS.finditer(joined, overlapped=True):
        one, two, three = m.group(1, 2, 3)
        words += 1
        value = crc(one)
        add(value % n_buckets)
        if two:
            value = crc(two, value)
            add(value % n_buckets)
            if three:
                add(crc(three, value) % n_buckets)
    return words, out


def _features(df: DataFrame, id_col: Column, text_col: str, n_buckets: int) -> DataFrame:
    """id, n_words, n_features, buckets (binary) of every row."""
    schema = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("n_features", pa.int64()), ("buckets", pa.binary())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ids, at, held, rows = batch.column("text"), batch.column("id"), 0, 0, []
            for i in range(batch.num_rows):
                words, found = feature_buckets(collapsed(texts[i].as_py() or b""), n_buckets)
                rows.append((words, len(found), found.tobytes()))
                held += len(rows[-1][2])
                if held >= OUT_BYTES or i + 1 == batch.num_rows:
                    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), list(schema)[1:], strict=True)]
                    yield pa.RecordBatch.from_arrays([ids.slice(at, len(rows)), *columns], schema=schema)
                    at, held, rows = i + 1, 0, []

    rows = df.select(id_col.cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(scan, "id long, n_words long, n_features long, buckets binary")


def _dtype(n_buckets: int) -> str:
    return "<u2" if n_buckets <= 1 << 16 else "<u4"


def bucket_counts(features: DataFrame, n_buckets: int = N_BUCKETS) -> np.ndarray:
    """Features per bucket over all rows; tasks send ``n_buckets`` rows each at most."""
    kind = _dtype(n_buckets)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_buckets, dtype=np.int64)
        for batch in batches:
            for b in batch.column("buckets"):
                total += np.bincount(np.frombuffer(b.as_buffer(), dtype=kind), minlength=n_buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    found = features.select("buckets").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n"))
    counts = np.zeros(n_buckets, dtype=np.int64)
    for bucket, n in found.collect():
        counts[bucket] = n
    return counts


def bucket_gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of add-one smoothed bucket shares, rounded down."""
    n, big, small = len(raw), float(raw.sum()), float(target.sum())
    return np.array([
        math.floor(1000 * math.log((float(t) + 1) * (big + n) / ((float(s) + 1) * (small + n))))
        for s, t in zip(raw.tolist(), target.tolist(), strict=True)
    ], dtype=np.int64)


def _weights(features: DataFrame, gains: np.ndarray) -> DataFrame:
    kind = _dtype(len(gains))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [int(gains[np.frombuffer(b.as_buffer(), dtype=kind)].sum()) for b in batch.column("buckets")]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("id", "n_words", "n_features")], pa.array(found, pa.int64())],
                names=["id", "n_words", "n_features", "weight"],
            )

    return features.mapInArrow(weigh, "id long, n_words long, n_features long, weight long")


def gumbel(id_col: Column, seed: int = SEED) -> Column:
    """Thousandths of a Gumbel variate that depends on the id alone, rounded down."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / F.lit(4294967296.0))))


def _ranked(scored: DataFrame, drawable: Column, percent: int) -> DataFrame:
    """``rank`` of the drawn rows: those that may be drawn come first, by falling score."""
    keys = [F.col("_out"), F.col("score").desc(), F.col("id").asc_nulls_last()]
    rows = scored.withColumn("_out", ~drawable).repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = numbered(rows, "_place", "ranked")
    n_drawn = placed.where("not _out").count() * percent // 100
    return placed.withColumn("rank", F.when(F.col("_place") < n_drawn, F.col("_place") + 1)).drop("_out", "_place")


def resampled(
    documents: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    target_text_col: str = "text", n_buckets: int = N_BUCKETS, min_words: int = MIN_WORDS, percent: int = PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """One row per input row: ``id``, ``n_words``, ``n_features``, ``weight``, ``score``,
    ``rank`` (1 for the highest score of the drawn ``percent`` of documents of at least
    ``min_words`` words, NULL for the others)."""
    features = staged(_features(documents, F.col(id_col), text_col, n_buckets), "features")
    wanted = bucket_counts(_features(target, F.lit(None), target_text_col, n_buckets), n_buckets)
    weighed = _weights(features, bucket_gains(bucket_counts(features, n_buckets), wanted))
    scored = weighed.withColumn("score", F.col("weight") + gumbel(F.col("id"), seed))
    return _ranked(scored, F.col("n_words") >= min_words, percent)
