"""Importance resampling against plain Python, odd rows included."""

from __future__ import annotations

import hashlib
import math
import re
import zlib

from railcadence.llm import importance

DOCS = "doc_id long, text string, id string, rank int, buckets int, score string, _place int"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, 2, "y", 3) for i, t in rows], DOCS)


def grams(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return len(w), [" ".join(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def expected(rows, target, n=10_000, percent=5, min_words=20):
    def buckets(text):
        return [zlib.crc32(g.encode()) % n for g in grams(text)[1]]

    raw, wanted = [0] * n, [0] * n
    for _, text in rows:
        for b in buckets(text):
            raw[b] += 1
    for text in target:
        for b in buckets(text):
            wanted[b] += 1
    big, small, out = sum(raw), sum(wanted), []
    for i, text in rows:
        found = buckets(text)
        weight = sum(math.floor(1000 * math.log((wanted[b] + 1) * (big + n) / ((raw[b] + 1) * (small + n)))) for b in found)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, grams(text)[0], len(found), weight, score])
    drawable = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    ranks = {id(r): k + 1 for k, r in enumerate(drawable[: percent * len(drawable) // 100])}
    return sorted((str((r[0], *r[1:], ranks.get(id(r)))) for r in out))


def rows_of(df):
    return sorted(str((r["id"], r["n_words"], r["n_features"], r["weight"], r["score"], r["rank"])) for r in df.collect())


def test_spans_are_the_ngrams():
    for text in ("", " ,;", "One", "one, two", "A-b c\n\nd E", "é ü ß x1 9", "a" * 5000 + " b " * 400):
        joined = importance.collapsed(text.encode())
        assert sorted(joined[a:b].decode() for a, b in importance.ngram_spans(joined)) == sorted(grams(text)[1])
        words, found = importance.feature_buckets(joined, 1 << 20)
        assert words == grams(text)[0]
        assert sorted(found) == sorted(zlib.crc32(g.encode()) % (1 << 20) for g in grams(text)[1])


def test_weights_and_draw(spark):
    rows = [(k, " ".join(f"w{(k * j) % 37}" for j in range(k % 60))) for k in range(300)]
    rows += [(None, None), (None, "w1 " * 25), (7, ""), (8, " \t\n"), (9, "Ünï çode " * 30), (9, "Ünï çode " * 30), (10, "x" * 100_000)]
    target = ["w1 w2 w3 w4", "", None, "Ünï çode"]
    wanted = spark.createDataFrame([(t, 1) for t in target], "text string, id int")
    for percent in (5, 50, 100):
        got = importance.resampled(docs(spark, rows), wanted, percent=percent)
        assert rows_of(got) == expected(rows, target, percent=percent)
    assert got.columns == ["id", "n_words", "n_features", "weight", "score", "rank"]


def test_ties_have_distinct_ranks(spark):
    rows = [(5, "a b " * 20)] * 40
    got = importance.resampled(docs(spark, rows), spark.createDataFrame([("a",)], "text string"), percent=50)
    assert sorted(r["rank"] for r in got.collect() if r["rank"]) == list(range(1, 21))


def test_empty_tables(spark):
    target = spark.createDataFrame([], "text string")
    assert importance.resampled(docs(spark, []), target).count() == 0
    rows = [(k, "a b c " * 10) for k in range(30)]
    assert rows_of(importance.resampled(docs(spark, rows), target)) == expected(rows, [])


def test_ranks_over_many_partitions(spark):
    rows = [(k, " ".join(f"t{(k * j) % 101}" for j in range(30))) for k in range(500)]
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = importance.resampled(docs(spark, rows), spark.createDataFrame([("t1 t2",)], "text string"), percent=100)
        assert rows_of(got) == expected(rows, ["t1 t2"], percent=100)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
