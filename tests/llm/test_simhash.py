"""SimHash fingerprints and their index against plain Python, odd rows included."""

from __future__ import annotations

import os
import re

import numpy as np
import pytest
import xxhash

from railcadence.llm import queries, simhash

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
DOCS = "doc_id long, text string, id string, fp int, label int, a string, no int"


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    width = min(3, len(w))
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i : i + width]).encode(), 42) for i in range(len(w) - width + 1)]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def plain_labels(fps, most=2):
    """Smallest place linked with each place."""
    u = np.asarray(fps, dtype=np.uint64)
    label = list(range(len(u)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(u)):
        for j in np.flatnonzero(np.bitwise_count(u[i + 1 :] ^ u[i]) <= most) + i + 1:
            a, b = root(i), root(int(j))
            label[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(u))]


def grouped(edges, n):
    label = list(range(n))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in edges:
        a, b = root(int(a)), root(int(b))
        label[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def dense(rng, n, clusters=5, flips=9):
    """Distinct fingerprints, most of them a few bits from one of several centres."""
    centres, out = rng.integers(0, 1 << 63, clusters, dtype=np.uint64), {0, (1 << 64) - 1, 1 << 63}
    while len(out) < n:
        x = int(centres[rng.integers(clusters)])
        for k in rng.integers(0, 12, rng.integers(flips)):
            x ^= 1 << int(5 * k)
        out.add(x if rng.random() < 0.8 else int(rng.integers(0, 1 << 63)) * 2)
    return np.array(sorted(out), dtype=np.uint64)


def test_fingerprints():
    for text in ("", "  \n", "a", "A b", "a b c", "a b c d", "É x\x0by z " * 50, "w " * 70_000, "x" * 100_000):
        if len(text) < 10_000:
            assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)
    assert simhash.fingerprint(b"w " * 70_000) == xxhash.xxh64_intdigest(b"w w w", 42)


@pytest.mark.parametrize("size", [1, 7, 8, 65, 700])
def test_leaf_search(size):
    rng = np.random.default_rng(size)
    fps, others = dense(rng, size + 3), dense(rng, 200)
    order = np.argsort(rng.random(len(fps)))  # right in any order, quick in Gray order
    for most in (0, 2, 5):
        q, found = simhash.LeafIndex(fps[order]).search(others, most)
        wanted = np.argwhere(np.bitwise_count(others[:, None] ^ fps[order][None, :]) <= most)
        assert sorted(zip(q.tolist(), found.tolist())) == sorted(map(tuple, wanted.tolist()))


def test_index_finds_all_links(spark):
    fps = dense(np.random.default_rng(3), 900)
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    at = {int(x): i for i, x in enumerate(fps.view(np.int64))}
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for leaf, most in ((4, 2), (64, 2), (4096, 2), (16, 4)):
            found = simhash.links(df, most, leaf).collect()
            assert grouped([(at[r["a"]], at[r["b"]]) for r in found], len(fps)) == plain_labels(fps, most)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


def test_components_of_odd_rows(spark):
    base = [f"word{k}" for k in range(400)]
    texts = [(1, None), (2, ""), (3, " \n"), (4, "one"), (5, "ONE"), (6, "one two"), (20, "x" * 100_000)]
    texts += [(30 + k, " ".join(base[:k] + ["other"] + base[k + 1 :])) for k in range(0, 400, 40)]
    texts += [(None, "one"), (7, " ".join(base)), (7, " ".join(base)), (8, "quite another text of its own kind")]
    rows = [(i, t, "x", 1, 2, "y", 3) for i, t in texts]
    got = simhash.simhash_components(spark.createDataFrame(rows, DOCS)).collect()
    fps = [plain_fingerprint(t) for _, t in texts]
    labels = plain_labels(fps)
    members = {}
    for (i, _), label in zip(texts, labels):
        members.setdefault(label, []).append(i)
    wanted = [(i, fp, min(x for x in members[label] if x is not None)) for (i, _), fp, label in zip(texts, fps, labels)]
    assert sorted((str(r["id"]), r["fp"] % (1 << 64), r["component"]) for r in got) == sorted((str(i), fp, c) for i, fp, c in wanted)
    assert simhash.simhash_components(spark.createDataFrame([], DOCS)).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no tables")
def test_query_against_brute_force(spark):
    got = queries.op12_simhash_near_dedup(spark, SF_DIR).collect()
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    fps = [plain_fingerprint(r["text"]) for r in rows]
    wanted = sorted((r["doc_id"], f"{fp:016x}", rows[at]["doc_id"]) for r, fp, at in zip(rows, fps, plain_labels(fps)))
    assert sorted(tuple(r) for r in got) == wanted
