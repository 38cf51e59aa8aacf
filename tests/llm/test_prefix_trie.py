"""The conversation trie against plain Python, odd rows included."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from railcadence.llm import prefix_trie
from railcadence.llm.prefix_trie import EMPTY, Monoid

TURNS = "conv_id long, turn long, role string, text string, conv int, depth string, ref int, rep int"


def turns(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], TURNS)


def expected(rows):
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, r or "", x or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in own.items()}
    rebuilt, members, below = {}, defaultdict(list), defaultdict(list)
    for c, seq in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = tuple(own.get(c - c % 20, [])[:h] + seq[h:])
        for k in range(len(rebuilt[c]) + 1):
            members[rebuilt[c][:k]].append(c)
    for n in members:
        if n:
            below[n[:-1]].append(n)
    out, leaves, saved = set(), {}, {}
    for n in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) if n else 0
        leaves[n] = sum(leaves[k] for k in below[n]) or 1
        saved[n] = (len(members[n]) - 1) * words + sum(saved[k] for k in below[n])
        ends = ",".join(str(c) for c in sorted(members[n]) if len(rebuilt[c]) == len(n))
        out.add((
            min(members[n]), len(n), min(members[n[:-1]]) if n else None, len(members[n]), len(below[n]), leaves[n],
            saved[n], hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return out


def nodes(df):
    found = [tuple(r)[:8] for r in df.collect()]
    assert len(found) == len(set(found))
    return set(found)


def made(seed, n=120, words=3):
    """Conversations that often begin alike; a long one; gaps among the groups' first ones."""
    rng, rows = random.Random(seed), []
    for c in rng.sample(range(400), n):
        for t in range(rng.randrange(7)):
            rows.append((c, t, rng.choice(["user", "assistant"]), " ".join(rng.choice("ab") for _ in range(rng.randrange(words)))))
    return rows + [(45, t, "user", f"a {t % 3}\n b") for t in range(500)]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_plain_python(spark, seed):
    rows = made(seed)
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled"), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the long one lies in several partitions
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        assert nodes(prefix_trie.prefix_trie(turns(spark, rows).repartition(3))) == expected(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old[0])
        spark.conf.set("spark.sql.shuffle.partitions", old[1])


def test_odd_rows(spark):
    rows = [
        (None, 0, "user", "in no conversation"), (1, None, None, None), (1, 0, "user", " \t\n"), (2, 1, "user", "x" * 100_000),
        (2, 1, "user", "x" * 100_000), (3, 0, "a", "b"), (4, 0, "", "ab"), (5, 0, "ab", ""), (6, 0, "a\nb", "é ü"), (0, 0, "s", "h1"),
        (0, 1, "s", "h2"), (0, 5, "s", "h3"), (7, 3, "user", "own"), (-3, 0, "user", "below zero"), (21, 0, "u", "no first one"),
    ] + [(c, t, "u", "same") for c in range(60, 90) for t in range(5)]
    assert nodes(prefix_trie.prefix_trie(turns(spark, rows))) == expected(rows)
    assert prefix_trie.prefix_trie(turns(spark, [])).count() == 0


def test_many_ids_end_at_one_node(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "IDS_BYTES", 40)
    rows = [(c, 0, "u", "same") for c in range(1, 200)]
    assert nodes(prefix_trie.prefix_trie(turns(spark, rows))) == expected(rows)


def test_products_compose():
    m, rng = Monoid(5), random.Random(1)
    letters = [(m.letter(bytes([rng.randrange(3)])), rng.randrange(9)) for _ in range(40)]

    def product(seq):
        x = EMPTY
        for letter, words in seq:
            x = m.extended(x, letter, words)
        return x

    for _ in range(50):
        a, b = sorted(rng.choices(range(41), k=2))
        assert m.joined(product(letters[:a]), product(letters[a:])) == product(letters)
        head = product(letters[a:b])
        assert m.rebuilt(head, product(letters[:b]), product(letters[:a])) == product(letters[a:b] + letters[a:b])


def test_a_collision_is_found_and_done_again(spark, monkeypatch):
    """With bases of 1 under the first salt, prefixes of the same turns in another order meet."""
    tried, begin, same = [], Monoid.__init__, prefix_trie._all_equal

    def weak(self, salt):
        begin(self, salt)
        if salt == 0:
            self.bases = [1, 1]

    monkeypatch.setattr(Monoid, "__init__", weak)
    monkeypatch.setattr(prefix_trie, "_all_equal", lambda *a: tried.append(same(*a)) or tried[-1])
    rows = [(c, t, "u", "xyzw"[(c * t + c // 2) % 4]) for c in range(1, 30) for t in range(5)]
    assert nodes(prefix_trie.prefix_trie(turns(spark, rows))) == expected(rows)
    assert tried == [False, True]
