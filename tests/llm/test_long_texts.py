"""Texts whose words or gaps are very long or have a pattern."""

from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np
import pytest

from railcadence.llm import packing, partenum, queries

DOCS = "doc_id long, text string"


@pytest.fixture(scope="module")
def plain():
    tokenizers, public = pytest.importorskip("tokenizers"), pytest.importorskip("public_tokenizers")
    found = tokenizers.Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    found.encode_special_tokens = True
    return lambda text: np.array(found.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


@pytest.mark.parametrize("unit", [" ", "\n", " \n\t", "a", "　\xa0", "!"])
def test_ids_of_two_million_characters(plain, unit):
    encoder = packing.Encoder(*queries.tokenizer())
    run = unit * (2_000_000 // len(unit))
    for text in (f"one {run}two", f"{run}\n", f"x\x1c{run} y  z{run}"):
        assert encoder.encode(text) == plain(text)


def test_runs_are_cut_where_no_id_changes(plain, monkeypatch):
    """The same cuts at runs of three, on many short texts."""
    monkeypatch.setattr(packing, "_LONG_SPACE", re.compile(f"[{packing._WHITE}]{{3,}}"))
    encoder, rng = packing.Encoder(*queries.tokenizer()), random.Random(11)
    parts = [" ", " ", "\n", "\t", "\x0b", "\x1c", "\x85", "\xa0", " ", "a", "It's", "7", "!?", "é", "日本", "\x00", "'s"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) * rng.choice([1, 1, 2, 5]) for _ in range(rng.randrange(12)))
        assert encoder.encode(text) == plain(text), text


def test_a_long_run_is_packed(spark, plain):
    text = "a" + "\n" * 1_200_000 + "b"
    rows = packing.pack_documents(spark.createDataFrame([(1, text)], DOCS), *queries.tokenizer()).orderBy("start").collect()
    assert b"".join(bytes(r["ids"]) for r in rows)[:-4] == plain(text)


def thue_morse(bits):
    word = [0]
    for _ in range(bits):
        word += [1 - x for x in word]
    return "".join("ab"[x] for x in word), "".join("ba"[x] for x in word)


def test_words_of_a_pattern_stay_apart(spark):
    """Sums of letters times powers of any base give these two one value modulo 2^64."""
    a, b = thue_morse(10)
    assert len(a) == 1024 and a != b
    rows = [(1, a), (2, b), (3, a.upper()), (4, f"w x y z {a}"), (5, f"w x y z {b}"), (6, f" w  x\ny z {b}")]
    got = defaultdict(set)
    for r in partenum.jaccard_components(spark.createDataFrame(rows, DOCS)).collect():
        got[r["component"]].add(r["id"])
    assert dict(got) == {1: {1, 3}, 2: {2}, 4: {4}, 5: {5, 6}}
