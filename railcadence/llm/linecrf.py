"""Document quality by a linear-chain conditional random field over lines.

Every line is labelled good or bad. Its features are binned counts of the line itself and
of its two neighbours (words, case, digits, symbols, repetition, ends of sentences); a
transition weight ties neighbouring labels. Forward-backward gives each line's marginal;
their mean, weighted by line length, is mapped to the score by a logistic curve.

Lines have no labels of their own: in training each takes its document's. Training uses
the ``max_labelled`` labelled documents that come first by a hash of their id, and of these
the ones of at most ``max_lines`` lines; of several such rows with one id it uses the one
whose text comes first by a digest. Only their bins reach the driver: ``max_labelled`` rows
at most. Scoring covers whole texts of all rows and reads the text column alone.

Defined results: NULL and empty texts are one empty line; of several labels of a document
the larger share decides, labels other than 0 and 1 are ignored; without both kinds of
labels every score is their smoothed share; repeated rows get equal scores; columns of any
name are kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from railcadence.llm import wordhash

MAX_LABELLED = 4000
MAX_LINES = 300
STEPS = 150

#: Upper edges of the bins of each feature.
EDGES = {
    "words": [0, 1, 3, 8, 20, 60],
    "word_length": [1, 2.5, 4, 5.5, 7, 9],
    "upper": [0, 0.02, 0.06, 0.15, 0.4, 0.7],
    "digits": [0, 0.01, 0.05, 0.15, 0.4],
    "symbols": [0, 0.01, 0.03, 0.08, 0.15, 0.25],
    "marks": [0, 0.01, 0.03, 0.06, 0.12],
    "new_words": [0.05, 0.2, 0.4, 0.6, 0.8, 0.95],
    "spaces": [0, 0.08, 0.13, 0.18, 0.25],
    "other": [0, 0.01, 0.05, 0.15, 0.4],
    "ended": [0],
    "begun": [0],
    "repeated": [0],
}
N_BINS = 1 + max(map(len, EDGES.values()))
N_FEATURES = len(EDGES)

_CLASS = np.zeros(256, dtype=np.uint8)
_CLASS[ord("A") : ord("Z") + 1] = 1
_CLASS[ord("0") : ord("9") + 1] = 2
_CLASS[[ord(c) for c in "#$%&*+/<=>@\\^_`{|}~[]!"]] = 3
_CLASS[[ord(c) for c in ".,;:?'\"()-"]] = 4
_CLASS[[0x20, *range(0x09, 0x0E)]] = 5
_CLASS[128:] = 6


def line_bins(group: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bins of every line's features, line lengths, and the number of lines of each text."""
    data = b"\n".join(group) + b"\n"
    b = np.frombuffer(data, dtype=np.uint8)
    ends = np.flatnonzero(b == 10)
    starts = np.concatenate(([0], ends[:-1] + 1))
    per_text = np.array([g.count(b"\n") + 1 for g in group])
    length = ends - starts
    kinds = _CLASS[b]
    count = {k: np.add.reduceat((kinds == k).astype(np.int32), starts) for k in range(1, 7)}
    size = np.maximum(length, 1)
    at, hashes = wordhash.scan(data)
    line = np.searchsorted(starts, at, side="right") - 1
    n_words = np.bincount(line, minlength=len(starts))
    text_of = np.repeat(np.arange(len(group)), per_text)
    # Words of a line that its text hasn't had before, by sorting (text, word).
    words = (hashes >> np.uint64(24)) | (text_of[line].astype(np.uint64) << np.uint64(40))
    order = np.argsort(words, kind="stable")
    fresh = np.ones(len(words), dtype=bool)
    fresh[order[1:]] = words[order[1:]] != words[order[:-1]]
    new = np.bincount(line, weights=fresh, minlength=len(starts))
    # Lines that come again in their text.
    line_hash = np.zeros(len(starts), dtype=np.uint64)
    if len(at):
        first = np.flatnonzero(np.concatenate(([True], line[1:] != line[:-1])))
        line_hash[line[first]] = np.add.reduceat(wordhash.mix(hashes + np.arange(len(at), dtype=np.uint64) - np.repeat(first, np.diff(first, append=len(at))).astype(np.uint64)), first)
    key = wordhash.mix(line_hash + text_of.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, inverse, copies = np.unique(key, return_inverse=True, return_counts=True)
    last = b[np.maximum(ends - 1, 0)]
    values = {
        "words": n_words, "word_length": (length - count[5] + 1) / np.maximum(n_words, 1),
        "upper": count[1] / size, "digits": count[2] / size, "symbols": count[3] / size, "marks": count[4] / size,
        "new_words": new / np.maximum(n_words, 1), "spaces": (count[5] - 1) / size, "other": count[6] / size,
        "ended": ((last == 46) | (last == 33) | (last == 63)) & (length > 0),
        "begun": (kinds[starts] == 1) | (kinds[starts] == 6),
        "repeated": (copies[inverse] > 1) & (n_words > 0),
    }
    bins = np.stack([np.searchsorted(EDGES[f], values[f].astype(np.float64)) for f in EDGES], axis=1)
    return bins.astype(np.uint8), np.maximum(length, 1), per_text


@dataclass
class Model:
    """``weights``: neighbour offset x feature x bin; ``tie``: gain of equal neighbours."""

    weights: np.ndarray
    tie: float
    slope: float
    shift: float

    def evidence(self, bins: np.ndarray, per_text: np.ndarray) -> np.ndarray:
        """Log-odds of each line by its features and its neighbours' ones."""
        rows = np.arange(N_FEATURES)
        ends = np.cumsum(per_text)
        before, after = np.arange(len(bins)) - 1, np.arange(len(bins)) + 1
        before[ends - per_text] = -1
        after[ends - 1] = -1
        out = self.weights[0][rows, bins].sum(axis=1)
        for k, near in ((1, before), (2, after)):
            out += np.where(near >= 0, self.weights[k][rows, bins[near]].sum(axis=1), 0.0)
        return out


def _pass(x: np.ndarray, tie: float) -> np.ndarray:
    """Message from one line's log-odds to its neighbour."""
    return np.logaddexp(x + tie, 0.0) - np.logaddexp(x, tie)


def _grid(per_text: np.ndarray) -> list[np.ndarray]:
    """For each place in a text, the lines there: the texts with most lines come first."""
    first = np.cumsum(per_text) - per_text
    order = np.argsort(-per_text, kind="stable")
    sizes = per_text[order]
    alive = np.searchsorted(-sizes, -np.arange(int(sizes[0]) if len(sizes) else 0), side="left")
    return [first[order[:n]] + t for t, n in enumerate(alive)]


def marginals(evidence: np.ndarray, per_text: np.ndarray, tie: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log-odds of each line given its whole text, with the forward and backward messages."""
    ahead, back = evidence.copy(), np.zeros(len(evidence))
    places = _grid(per_text)
    for now, then in zip(places[1:], places, strict=False):
        ahead[now] += _pass(ahead[then[: len(now)]], tie)
    for then, now in zip(places[:0:-1], places[-2::-1], strict=True):
        back[now[: len(then)]] = _pass(evidence[then] + back[then], tie)
    return ahead + back, ahead, back


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def good_share(model: Model, bins: np.ndarray, length: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """Length-weighted mean of the lines' marginals, as log-odds."""
    p = _sigmoid(marginals(model.evidence(bins, per_text), per_text, model.tie)[0])
    starts = np.cumsum(per_text) - per_text
    share = np.add.reduceat(p * length, starts) / np.add.reduceat(length.astype(float), starts)
    share = np.clip(share, 1e-9, 1 - 1e-9)
    return np.log(share) - np.log1p(-share)


def fit(bins: np.ndarray, length: np.ndarray, per_text: np.ndarray, good: np.ndarray, steps: int = STEPS) -> Model:
    """Maximum likelihood with a quadratic penalty, by Adam over all texts at once."""
    if not 0 < good.sum() < len(good):
        share = (good.sum() + 1) / (len(good) + 2)
        return Model(np.zeros((3, N_FEATURES, N_BINS)), 0.0, 0.0, float(np.log(share / (1 - share))))
    n_cells = N_FEATURES * N_BINS
    cells = bins.astype(np.int64) + np.arange(N_FEATURES) * N_BINS
    ends = np.cumsum(per_text)
    no_before, no_after = ends - per_text, ends - 1
    target = np.repeat(good, per_text).astype(float)
    inner = np.ones(len(bins), dtype=bool)
    inner[no_after] = False
    link = np.flatnonzero(inner)
    weight = 1.0 / len(bins)
    model = Model(np.zeros((3, N_FEATURES, N_BINS)), 0.5, 1.0, 0.0)
    m = v = np.zeros(3 * n_cells + 1)
    for step in range(1, steps + 1):
        e = model.evidence(bins, per_text)
        odds, ahead, back = marginals(e, per_text, model.tie)
        off = _sigmoid(odds) - target
        into = []
        for k in range(3):
            d = off if k == 0 else np.concatenate((off[1:], [0.0])) if k == 1 else np.concatenate(([0.0], off[:-1]))
            d = d.copy()
            if k == 1:
                d[no_after] = 0.0  # this line is nobody's neighbour before
            if k == 2:
                d[no_before] = 0.0
            into.append(np.bincount(cells.ravel(), weights=np.repeat(d, N_FEATURES), minlength=n_cells))
        a, z = ahead[link], (e + back)[link + 1]
        same = np.logaddexp(a + z, 0.0) + model.tie
        tie = (_sigmoid(same - np.logaddexp(a, z)) - 1.0).sum()
        flat = np.concatenate((model.weights.ravel(), [model.tie]))
        grad = np.concatenate((*into, [tie])) * weight + 1e-3 * flat
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        flat = flat - 0.08 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
        model.weights, model.tie = flat[:-1].reshape(3, N_FEATURES, N_BINS), float(np.clip(flat[-1], 0, 3))
    x, y = good_share(model, bins, length, per_text), good.astype(float)
    for _ in range(30):  # Newton steps for the logistic curve
        p = _sigmoid(model.slope * x + model.shift)
        g = np.array([((p - y) * x).sum() + 1e-2 * model.slope, (p - y).sum()])
        w = p * (1 - p) + 1e-6
        h = np.array([[(w * x * x).sum() + 1e-2, (w * x).sum()], [(w * x).sum(), w.sum()]])
        step_by = np.clip(np.linalg.solve(h, g), -1, 1)
        model.slope, model.shift = float(model.slope - step_by[0]), float(model.shift - step_by[1])
    return model


def score_texts(model: Model, texts: list[str | None]) -> np.ndarray:
    out = [np.zeros(0)]
    for _, group in wordhash.buffers(texts):
        share = good_share(model, *line_bins(group))
        out.append(_sigmoid(model.slope * share + model.shift))
    return np.concatenate(out)


def train(
    documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality", usable: Column | None = None, max_labelled: int = MAX_LABELLED,
    max_lines: int = MAX_LINES,
) -> Model:
    """Fit on labelled documents; ``usable`` (of the id column) says which labels may be learnt."""
    known = labels.where(usable if usable is not None else F.lit(True)).where(F.col(label_col).isin(0, 1))
    known = known.groupBy(F.col(id_col).alias("id")).agg((F.avg(label_col) > 0.5).cast("int").alias("good"))
    ids = documents.select(F.col(id_col).alias("id")).distinct()
    chosen = known.join(ids, "id", "left_semi").orderBy(F.xxhash64("id"), "id").limit(max_labelled)
    # At most max_labelled rows of two numbers.
    rows = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id")

    schema = pa.schema([("id", pa.int64()), ("key", pa.binary()), ("good", pa.int32()), ("bins", pa.binary()), ("length", pa.binary())])

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first: dict[int, tuple] = {}  # one row per chosen id
        for batch in batches:
            ids, good = batch.column("id").to_pylist(), batch.column("good").to_pylist()
            for at, group in wordhash.buffers(batch.column("text").to_pylist()):
                better: dict[int, tuple] = {}
                for i, text in zip(at, group, strict=True):
                    if text.count(b"\n") < max_lines:
                        key = hashlib.blake2b(text, digest_size=16).digest()
                        held = better.get(ids[i]) or first.get(ids[i])
                        if held is None or key < held[0]:
                            better[ids[i]] = (key, good[i], text)
                if not better:
                    continue
                bins, length, per_text = line_bins([text for _, _, text in better.values()])
                ends = np.cumsum(per_text)
                for (doc, (key, label, _)), n, end in zip(better.items(), per_text.tolist(), ends.tolist(), strict=True):
                    first[doc] = (key, label, bins[end - n : end].tobytes(), length[end - n : end].astype("<i8").tobytes())
        columns = list(zip(*((doc, *row) for doc, row in first.items()), strict=True)) or [[]] * len(schema)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    found = rows.mapInArrow(binned, "id long, key binary, good int, bins binary, length binary")
    # One row per id of each task, then one per id.
    found = found.groupBy("id").agg(F.min_by(F.struct("good", "bins", "length"), "key").alias("row")).select("id", "row.*").toPandas()
    found = found.sort_values("id", kind="stable")
    if not len(found):
        return fit(np.zeros((0, N_FEATURES), np.uint8), np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64))
    bins = np.frombuffer(b"".join(found["bins"]), dtype=np.uint8).reshape(-1, N_FEATURES)
    length = np.frombuffer(b"".join(found["length"]), dtype="<i8")
    per_text = np.array([len(x) // N_FEATURES for x in found["bins"]])
    return fit(bins, length, per_text, found["good"].to_numpy())


def scored(documents: DataFrame, model: Model, text_col: str = "text", into: str = "score") -> DataFrame:
    """``documents`` with the score of each whole text."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(score_texts(model, texts.tolist()))

    return documents.withColumn(into, score(F.col(text_col)))
