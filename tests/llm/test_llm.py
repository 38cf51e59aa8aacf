"""The operators against plain Python on small tables, odd rows included."""

from __future__ import annotations

import hashlib
import os
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from compare import compare, duck
from railcadence.llm import (
    aho, archive, chat, content_sort, htmltext, linecrf, oracles, packing, partenum, queries, shards, url_templates,
)

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no tables")
DOCS = "doc_id long, text string, id string, score int, digest int, lead int, row string"


def docs(spark, texts):
    """Rows with extra columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "x", 1, 2, 3, "y") for i, t in texts], DOCS)


@needs_tables
@pytest.mark.parametrize("name", sorted(oracles.all_oracles()))
def test_against_sql(spark, name):
    ok, note = compare(spark, duck(SF_DIR), queries.all_queries()[name], oracles.all_oracles()[name], SF_DIR)
    assert ok, note


# ---------------------------------------------------------------- chat
def turns(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, part int, loss string")


def test_chat_round_trip(spark):
    odd = ["", "a<|im_end|>\nb", "<\\|im_end|>", "<\\\\|x", "<", "|<|", "\n", "x" * 200_000, "é<|"]
    rows = [(1, k, "assistant" if k % 2 else "a\\n<|\nb", t, 1, "z") for k, t in enumerate(odd)]
    rows += [(None, None, None, None, 1, "z"), (2, 0, "user", "hi", 1, "z"), (2, 0, "user", "hi", 1, "z")]
    got = {r["conv_id"]: r for r in chat.read_conversations(chat.format_conversations(turns(spark, rows))).collect()}
    assert set(got) == {"1", "2", None}
    said = "".join(f"{r[2]}\n{r[3]}\n" for r in rows[: len(odd)])
    loss = "".join(t for k, t in enumerate(odd) if k % 2)
    assert got["1"]["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
    assert (got["1"]["loss_chars"], got["1"]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert got["2"]["n_turns"] == 2 and got[None]["n_turns"] == 1
    assert chat.format_conversations(turns(spark, [])).count() == 0


def test_chat_templates():
    def render(source, **names):
        return "".join(t for t, _ in chat.compile_template(source)([{"role": "u", "text": "T"}, {"role": "v", "text": None}], names))

    assert render("{% for m in messages %}{{ loop.index ~ m.role }}{% if not loop.last %},{% endif %}{% endfor %}") == "1u,2v"
    assert render("{{ 'a' if 1 < 2 and not false else 'b' }}{# no #}{% set x = 2 + 3 %}{{ x }}{{ y|upper }}", y="q") == "a5Q"
    assert chat.fold(chat.parse("a{{ 'b' ~ 1 }}{% if false %}x{% else %}c{% endif %}")) == (chat.Out(chat.Const("ab1c")),)
    for bad in ("{% for x in messages %}", "{{ a.b( }}", "{{ 'x' | open }}", "{% endif %}", "{{ __class__ }}", "{% foo %}"):
        with pytest.raises(chat.TemplateError):
            chat.parse(bad)
    with pytest.raises(chat.TemplateError):
        render("{{ y.upper }}", y="text has no fields")


# ---------------------------------------------------------------- packing
def test_packing(spark):
    tokenizers = pytest.importorskip("tokenizers")
    public_tokenizers = pytest.importorskip("public_tokenizers")
    plain = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    plain.encode_special_tokens = True
    rng = np.random.default_rng(5)
    words = ["the", "Word,", "x1", "  two", "\nline.", "naïve", "日本", "don't", "<|endoftext|>", "a.\nB", "\t", "!!", ""]
    texts = [" ".join(rng.choice(words, n)) for n in (1, 5, 40, 700, 4000, 3, 9, 300, 300, 90)] + [None, "", " ", "x" * 9000]
    rows = list(enumerate(texts)) + [(3, texts[3])]
    got = packing.pack_documents(docs(spark, rows), *queries.tokenizer()).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r["id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    for i, text in enumerate(texts):
        ids = np.array([*plain.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        found = sorted(by_doc[i], key=lambda r: r["start"])
        assert Counter(bytes(r["ids"]) for r in found) == Counter(
            ids[r["start"] : r["start"] + r["length"]].tobytes() for r in found)
        assert sum(r["length"] for r in found) == len(ids) * (2 if i == 3 else 1)
        assert {r["doc_tokens"] for r in found} == {len(ids)}
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
    assert packing.pack_documents(docs(spark, []), *queries.tokenizer()).count() == 0


def test_best_fit_uses_the_tightest_window():
    assert [sorted(b) for b in packing.best_fit_decreasing([6, 5, 4, 3, 2], 10)] == [[0, 2], [1, 3, 4]]
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 2049, 3000).tolist()
    sequences = packing.pack(lengths)
    total = sum(lengths)
    assert len(sequences) * 2048 - total <= max(2048, 0.005 * len(sequences) * 2048)
    assert sum(n for s in sequences for _, _, n in s) == total
    covered = sorted((i, a, a + n) for s in sequences for i, a, n in s)
    at = {}
    for i, a, b in covered:
        assert at.get(i, 0) == a
        at[i] = b
    assert at == dict(enumerate(lengths))


# ---------------------------------------------------------------- shards
def test_shards(spark):
    rows = [(i, None if i % 7 else "t") for i in range(1003)] + [(None, "n"), (5, None)]
    got = shards.uniform_shards(docs(spark, rows).repartition(5), 24, seed=3, block_rows=10).select("row.*", "shard", "slot").collect()
    sizes = Counter(r["shard"] for r in got)
    assert set(sizes) == set(range(24)) and max(sizes.values()) - min(sizes.values()) <= 1
    assert all(sorted(r["slot"] for r in got if r["shard"] == s) == list(range(n)) for s, n in sizes.items())
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _ in rows)
    assert shards.uniform_shards(docs(spark, []), 24).count() == 0


def test_communication_matrix_is_hypergeometric():
    rng = np.random.default_rng(0)
    got = np.array([shards.draw(rng, 30, 70, 20) for _ in range(4000)])
    assert abs(got.mean() - 6) < 0.15 and abs(got.var() - 20 * 0.3 * 0.7 * 80 / 99) < 0.3
    assert shards.draw(rng, 5, 0, 3) == 3 and shards.draw(rng, 0, 5, 3) == 0
    big = shards.draw(rng, 10**12, 3 * 10**12, 10**10)
    assert abs(big - 25 * 10**8) < 10**6
    m = np.array(shards.communication_matrix([10, 0, 25, 7], [14, 14, 14], 1))
    assert m.sum(1).tolist() == [10, 0, 25, 7] and m.sum(0).tolist() == [14, 14, 14]


# ---------------------------------------------------------------- quality
def test_marginals_equal_enumeration():
    e, tie = np.array([0.3, -1.2, 0.8, 2.0, -0.5]), 0.7
    per_text = np.array([2, 3])
    got = linecrf.marginals(e, per_text, tie)[0]
    at = 0
    for n in per_text:
        weight = np.zeros((n, 2))
        for labels in np.ndindex(*[2] * n):
            w = np.exp(sum(e[at + k] for k in range(n) if labels[k]) + tie * sum(a == b for a, b in zip(labels, labels[1:])))
            for k in range(n):
                weight[k, labels[k]] += w
        assert np.allclose(got[at : at + n], np.log(weight[:, 1] / weight[:, 0]))
        at += n


def test_quality(spark):
    rng = np.random.default_rng(2)
    def text(good):
        w = ["".join(rng.choice(list("abcdefgh"), rng.integers(2, 8))) for _ in range(60)]
        return (" ".join(w[:30]).capitalize() + ".\n" + " ".join(w[30:]).capitalize() + ".") if good else "Fine line here.\n" + " ".join(f"{x}###" for x in w)
    rows = [(i, text(i % 3 > 0)) for i in range(300)] + [(900, None), (901, ""), (902, "a " * 100_000), (3, None), (None, "x")]
    d = docs(spark, rows)
    labels = spark.createDataFrame([(i, int(i % 3 > 0), "k") for i in range(200)] + [(1, None, "k"), (900, 7, "k"), (None, 1, "k")], "doc_id long, quality int, id string")
    model = linecrf.train(d, labels)
    got = [(r["doc_id"], r["quality"]) for r in linecrf.scored(d, model, into="quality").collect()]
    assert len(got) == len(rows) and all(0 <= s <= 1 for _, s in got)
    assert all((s >= 0.5) == (i % 3 > 0) for i, s in got if i is not None and 200 <= i < 300)
    one_kind = linecrf.train(d, labels.where("quality = 1"))
    assert all(r["score"] > 0.9 for r in linecrf.scored(d, one_kind).collect())
    nothing = linecrf.train(docs(spark, []), labels)
    assert linecrf.score_texts(nothing, ["a", None]).tolist() == [0.5, 0.5]


def test_quality_training_rows_are_bounded(spark, monkeypatch):
    rows = [(i % 40, f"Fine line {i}.\nAnother one.") for i in range(80)] + [(41, f"### {k}\n" * (k % 3 + 1)) for k in range(500)]
    rows += [(42, "a\n" * 1000), (42, "b"), (43, "a\n" * 1000), (44, None), (44, None)]
    labels = spark.createDataFrame([(i, int(i < 41)) for i in range(45)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(linecrf, "fit", lambda bins, length, per_text, good: seen.append((bins.tobytes(), length.tolist(), per_text.tolist(), good.tolist())))
    for n_tasks in (1, 7):
        linecrf.train(docs(spark, rows).repartition(n_tasks), labels)
    linecrf.train(docs(spark, rows[::-1]).repartition(3), labels, max_labelled=10)
    # Ids 0 to 39, 41, 42 and 44; 40 has no row and 43 no text short enough.
    assert seen[0] == seen[1] and len(seen[0][2]) == 43 and sum(seen[0][3]) == 40
    assert sum(seen[0][2]) == len(seen[0][1]) and len(seen[2][2]) <= 10
    linecrf.train(docs(spark, [(42, "a\n" * 1000), (42, "b")]), labels)
    assert seen[3][1:] == ([1], [1], [0])


@needs_tables
def test_quality_held_out(spark):
    d = SF_DIR.replace("sf0.001", "sf0.01")
    rows = queries.op4_quality_classifier(spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").where("held_out").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.95


# ---------------------------------------------------------------- similarity
def brute_components(rows, width=5):
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(fold))
        sets[i] = {tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()
    label = {i: i for i in sets}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                label[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("seed", [1, 2])
def test_similarity_components(spark, seed):
    rng = np.random.default_rng(seed)
    vocabulary = np.array([f"w{k}" for k in range(500)])
    shared = list(rng.choice(vocabulary, 30))
    texts = [None, "", " \n", "one two", "ONE two", "a b c d e", "a b c d e f", "A B c d e f g"]
    for size in (8, 12, 20, 33, 60, 90, 150, 260):
        for _ in range(3):
            base = list(rng.choice(vocabulary, size))
            for _ in range(int(rng.integers(2, 14))):
                new = list(base)
                for _ in range(int(rng.integers(0, 1 + size // 18))):
                    new[rng.integers(len(new))] = str(rng.choice(vocabulary))
                cut = int(rng.integers(0, 1 + size // 6))
                texts.append(" ".join((shared if rng.random() < 0.3 else []) + new[cut:]))
    rows = list(enumerate(texts))
    got = {r["id"]: (r["n_shingles"], r["component"]) for r in partenum.jaccard_components(docs(spark, rows)).collect()}
    assert got == brute_components(rows)
    crowded = {r["id"]: (r["n_shingles"], r["component"]) for r in partenum.jaccard_components(docs(spark, rows), crowd=2).collect()}
    assert crowded == got
    # 2 of 64 bits name at most four sets; the others are named by both digests
    clashing = {r["id"]: (r["n_shingles"], r["component"]) for r in partenum.jaccard_components(docs(spark, rows), digest_bits=2).collect()}
    assert clashing == got


def test_names_of_sets_with_one_digest():
    sets = [np.arange(k, k + 9, dtype=np.uint64) for k in range(300)] + [np.zeros(0, dtype=np.uint64)]
    names = partenum.Names(bits=1)
    first = names.of(sets)[1]
    assert len(set(first.tolist())) == 2
    names = names.and_clashes(sorted(set(first.tolist())))
    _, again, check = names.of(sets)
    assert len(set(again[:300].tolist())) == 300 and (check == partenum.digests(sets)[2]).all()
    assert (again != names.and_clashes([]).of(sets)[1]).all()
    assert (partenum.Names().of(sets)[1] == partenum.digests(sets)[1]).all()


def test_similarity_odd_rows(spark):
    long = " ".join(f"v{k % 997}" for k in range(60_000))
    rows = [(1, "a b c d e f"), (1, "q r s t u v"), (None, "a b c d e f"), (4, long), (5, long + " end"), (1, "a b c d e f")]
    got = Counter((r["id"], r["component"]) for r in partenum.jaccard_components(docs(spark, rows)).collect())
    assert got == Counter({(1, 1): 3, (None, 1): 1, (4, 4): 1, (5, 4): 1})
    kept = partenum.one_of_each(docs(spark, rows))
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 1, 1, 4]
    assert kept.columns == docs(spark, []).columns
    assert partenum.jaccard_components(docs(spark, [])).count() == 0


def test_shared_rows_keep_every_common_signature():
    rng = np.random.default_rng(5)
    for _ in range(200):
        rows = sorted((int(rng.integers(0, 12)), int(rng.integers(0, 4))) for _ in range(rng.integers(0, 40)))
        sets: dict[int, set] = {}
        for sig, node in rows:
            sets.setdefault(sig, set()).add(node)
        # Equal rows are in one partition; partitions and batches end anywhere else.
        cuts = [i for i in range(1, len(rows)) if rows[i] != rows[i - 1] and rng.random() < 0.2]
        found = []
        for a, b in zip([0, *cuts], [*cuts, len(rows)], strict=True):
            edges = sorted({a, b, *(int(x) for x in rng.integers(a, b + 1, 3))})
            batches = [
                pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows[x:y]], pa.int64()), pa.array([r[1] for r in rows[x:y]], pa.int64()),
                     pa.array([7] * (y - x), pa.int64())], names=["sig", "node", "info"],
                ) for x, y in zip(edges, edges[1:], strict=False)
            ]
            part = [r for out in partenum._shared_rows(iter(batches)) for r in zip(*(c.to_pylist() for c in out.columns))]
            inner = {r[0] for r in part[1:-1]}
            assert all(len(sets[sig]) > 1 for sig in inner)
            found += part
        assert len(found) == len(set(found))
        common = {(sig, node, 7) for sig, nodes in sets.items() if len(nodes) > 1 for node in nodes}
        assert common <= set(found) <= {(sig, node, 7) for sig, nodes in sets.items() for node in nodes}


def test_signatures_lose_no_pair():
    rng = np.random.default_rng(8)
    for size in [3, 4, 7, 10, 20, 28, 40, 55, 56, 57, 100, 300, 1200]:
        for _ in range(20):
            base = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
            n_out = int(rng.integers(0, max(1, len(base) // 7) + 1))
            n_in = int(rng.integers(0, max(1, len(base) // 7) + 1))
            other = np.unique(np.concatenate((rng.permutation(base)[n_out:], rng.integers(0, 1 << 63, n_in, dtype=np.uint64))))
            both = len(np.intersect1d(base, other))
            total = len(base) + len(other) - both
            if 100 * both >= 75 * total and total > both:
                (a, ia), (b, ib) = partenum.signatures(base), partenum.signatures(other)
                slack = min(int(ia.min() & 4095), int(ib.min() & 4095)) - 1
                assert len(np.intersect1d(a, b)) >= max(1, slack + 1)


# ---------------------------------------------------------------- pages
def test_main_text():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
    <header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a><li><a href=/x>More</a></ul></nav>
    <div id=cookie-notice>We use cookies on this site, please agree to all of them.</div>
    <article><header><h1>A &amp; B</h1></header><p>First   paragraph of the
    story, <b>long enough.<p>Second one&nbsp;with <a href=q>a link</a> in it.<div class="ad">Buy this now</div>
    <ul><li>point one is here<li>point two</ul><form><p>Mail<input></form><script>var x = "<p>no</p>";</script></article>
    <section class="comments"><p>I am a reader and this is a rather long comment of mine.</p></section>
    <aside>Other stories</aside><footer>&copy; site"""
    assert htmltext.main_text(page) == (
        "A & B\nFirst paragraph of the story, long enough.\nSecond one with a link in it.\npoint one is here\npoint two")
    assert htmltext.main_text(None) == htmltext.main_text("") == htmltext.main_text("<p></p>") == ""
    assert htmltext.main_text("just text") == "just text"
    deep = "<div>" * 20_000 + "x" * 50 + "</div>" * 20_000
    assert htmltext.main_text(deep) == "x" * 50
    assert htmltext.main_text("</b></p>< <<p>a<td>b") != ""


class Written:
    """A random page and its blocks, written along with it."""

    def __init__(self, seed):
        self.rng, self.n, self.html, self.blocks, self.line = np.random.default_rng(seed), 0, [], [], []

    def border(self):
        if self.line:
            self.blocks.append(" ".join(self.line))
        self.line = []

    def words(self):
        self.n += 1
        text = " ".join(f"w{self.n}x{k}" for k in range(int(self.rng.choice([1, 2, 9, 60]))))
        self.html.append(f" {text} ")
        self.line.append(text)

    def node(self, tag, depth):
        self.border()
        self.html.append(f"<{tag}>")
        inner = {"ul": ["li"], "table": ["tr"], "tr": ["td"]}.get(tag, ["p", "p", "h2", "div", "section", "ul", "table", "text"])
        for _ in range(int(self.rng.integers(1, 6))):
            here = str(self.rng.choice(inner))
            if tag in ("p", "h2") or here == "text" or depth <= 0 and tag not in ("ul", "table", "tr"):
                self.words()
            else:
                self.node(here, depth - 1)
            if self.rng.random() < 0.1 and tag in ("div", "section"):
                self.html.append('<div class="ad">Buy this now</div><nav><a href=/>Home</a></nav>')
        self.html.append(f"</{tag}>")
        self.border()


@pytest.mark.parametrize("top", ["article", "main", "div", "body"])
def test_main_text_keeps_every_part(top):
    for seed in range(60):
        page = Written(seed)
        page.node(top, 4)
        got = htmltext.main_text("<nav><a href=/>Home</a></nav>" + "".join(page.html) + "<footer>site</footer>")
        assert got.split("\n") == page.blocks, (seed, "".join(page.html))


def test_main_text_keeps_parts_below_the_centre():
    long = "<p>" + "word " * 60 + "</p>"
    for parts in (
        ["<h1>Title of it</h1>", "<div>" + long * 10 + "</div>"], ["Bare text. ", "<div>" + long * 10 + "</div>", "Tail."],
        ["<section>" + long * k + "</section>" for k in (1, 9, 2)], ["<table><tr><td>1</table>", "<ul><li>b</ul>", "<div>" + long * 9 + "</div>"],
        ["<div>" + long * 9 + "</div>", "<p><a href=q>One link</a></p>", "<ul><li><a href=1>a</a><li><a href=2>b</a><li><a href=3>c</a></ul>"],
    ):
        for page in ("<article>" + "".join(parts) + "</article>", "<body><div><main>" + "".join(parts) + "</main></div></body>"):
            got = htmltext.main_text(page)
            assert "".join(got.split()) == "".join(re.sub("<[^>]*>", "", page).split())
    two = htmltext.main_text("<body><article><h2>A</h2><div>" + long * 9 + "</div></article><article><p>B</p></article></body>late")
    assert two.split("\n")[0] == "A" and two.split("\n")[-2:] == ["B", "late"]


def test_main_text_leaves_unmarked_menus_out():
    menu = "<div><ul>" + "".join(f"<li><a href=/{k}>Part {k}</a></li>" for k in range(6)) + "</ul></div>"
    text = "<p>" + "word " * 60 + "</p>"
    page = "<body>" + menu + "<div><h1>T</h1>" + text * 5 + "</div><p><a href=q><b>One</b><i>single</i><u>link</u></a></p></body>"
    got = htmltext.main_text(page)
    assert "Part" not in got and got.startswith("T\nword") and got.endswith("Onesinglelink")
    assert htmltext.main_text(menu + menu).count("Part") == 12


def test_main_text_names_alone_cut_no_article_text():
    text = "<p>" + "word " * 60 + "</p>"
    price = f'<article><h1>T</h1>{text * 3}<div class="share-price"><p>It rose by two.</p></div></article>'
    assert htmltext.main_text(price).endswith("\nIt rose by two.")
    assert htmltext.main_text(f'<body><section id="search-for-life"><h1>Search</h1>{text}</section></body>').startswith("Search\nword")
    links = "<ul><li><a href=1>One</a><li><a href=2>Two</a><li><a href=3>Three</a></ul>"
    for page in (f"<body><div>{text * 4}</div>{links}</body>", f"<div><article>{text * 4}</article>{links}</div>"):
        assert htmltext.main_text(page).endswith("\nOne\nTwo\nThree")
    for name in ("ad-slot-2", "site-footer", "comments", "post-comments", "cookie-notice", "related articles"):
        assert htmltext.main_text(f'<article>{text}<div class="{name}"><p>Gone.</p></div></article>') == ("word " * 60).strip()


def test_density_cuts_unnamed_blocks_beside_an_article(monkeypatch):
    text = "<p>" + "word " * 60 + "</p>"
    page = f"<body><div>Buy this now</div><h1>T</h1><article>{text * 4}<div>Short.</div></article><div><p>Sign up</p></div></body>"
    kept = ["T", *["word " * 59 + "word"] * 4, "Short."]
    assert htmltext.main_text(page).split("\n") == kept
    monkeypatch.setattr(htmltext, "_cut_sparse", lambda nodes, top: None)
    assert htmltext.main_text(page).split("\n") == ["Buy this now", *kept, "Sign up"]


def test_densities():
    """Characters a tag, adjusted by links, and their sums, for a page worked out by hand."""
    builder = htmltext._Builder()
    builder.feed("<body><div><p>" + "x" * 100 + "</p><p>" + "y" * 50 + "</p></div><ul><li><a>" + "z" * 10 + "</a></ul></body>")
    builder.close()
    htmltext._measure(builder.nodes, builder.root)
    found = {(n.tag, n.chars): n for n in builder.nodes}
    assert found["p", 100].density == pytest.approx(100 * np.log(100))
    # 150 of 160 characters without links, two paragraphs below the node, no link tag
    assert found["div", 150].density == pytest.approx(75 * np.log(150 * 2))
    assert found["div", 150].sum == pytest.approx(100 * np.log(100) + 50 * np.log(50))
    li, base = found["li", 10], np.log(10 / 1 * 10 + 10 / 160 * 10 + np.e)
    assert li.density == pytest.approx(10 * np.log(max(10 / 10 * 1 / 1, 1)) / np.log(base)) == 0
    assert builder.root.best is found["div", 150] or builder.root.best is found["body", 160]


def test_extracted_rows(spark):
    pages = spark.createDataFrame([(1, "<article><p>a b</p></article>", "k"), (1, None, "k"), (None, "<p>q", "k")], "page_id long, html string, text string")
    got = htmltext.extracted(pages, into="main").collect()
    assert sorted((str(r["page_id"]), r["main"], r["text"]) for r in got) == [("1", "", "k"), ("1", "a b", "k"), ("None", "q", "k")]
    assert htmltext.extracted(pages.limit(0)).count() == 0


# ---------------------------------------------------------------- decontamination
def test_contamination(spark):
    items = spark.createDataFrame([(1, "Alpha beta, gamma!", "k"), (2, " ".join(f"q{k}" for k in range(12)), "k"), (3, None, "k"), (4, "--", "k"), (5, "alpha BETA gamma", "k"), (None, "nul", "k")], "item_id long, text string, hits string")
    long = "zz " * 50_000 + "alpha-beta: GAMMA."
    rows = [(1, "x ALPHA beta gamma alpha beta"), (2, " ".join(f"q{k}" for k in range(1, 11))), (3, " ".join(f"q{k}" for k in range(9))), (4, None), (5, ""), (6, long), (6, long), (7, "alphabeta gamma nul")]
    got = aho.contamination(docs(spark, rows), items, into="found").select("doc_id", "found.*").collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == len(rows)
    assert (by[1]["n_words"], by[1]["n_hit"], by[1]["items"]) == (6, 3, [1, 5])
    assert rows[0][1][by[1]["stretches"][0]["start"] : by[1]["stretches"][0]["end"]] == "ALPHA beta gamma"
    assert (by[2]["n_hit"], by[2]["items"], by[3]["n_hit"], by[4]["n_words"], by[5]["n_words"]) == (10, [2], 0, 0, 0)
    s = by[6]["stretches"][0]
    assert long[s["start"] : s["end"]] == "alpha-beta: GAMMA" and by[6]["n_words"] == 50_003
    assert by[7]["items"] == [None] and by[7]["n_hit"] == 1
    assert aho.contamination(docs(spark, rows), items.limit(0)).where("hits.n_hit > 0").count() == 0
    assert aho.contamination(docs(spark, []), items).count() == 0
    with pytest.raises(ValueError):
        aho.contamination(docs(spark, rows), items, max_item_bytes=10)


@pytest.mark.parametrize("base", [2, 3, 256])
def test_scan_against_brute_force(monkeypatch, base):
    """Codes of one to five letters a word; few words, so that windows overlap and repeat."""
    monkeypatch.setattr(aho, "BASE", base)
    rng = np.random.default_rng(base)
    for n_words in (1, 3, 9, 12):
        for _ in range(40):
            def text(most):
                return " ".join(f"w{k}" for k in rng.integers(0, n_words, int(rng.integers(0, most))))
            items = [(k // 2, text(6)) for k in range(5)]
            got = aho.scan(aho.Windows(items, 3), doc := text(30) + " other " + text(9))
            words, hit, found = doc.split(), set(), set()
            for item, t in items:
                w = t.split()
                for i in range(max(1, len(w) - 2) if w else 0):
                    part = w[i : i + 3]
                    for j in range(len(words) - len(part) + 1):
                        if words[j : j + len(part)] == part:
                            hit |= set(range(j, j + len(part)))
                            found.add(item)
            assert got[:3] == (len(words), len(hit), sorted(found)), (items, doc)


# ---------------------------------------------------------------- exact duplicates
def test_content_groups(spark):
    texts = ["a b", "ab", " a  b ", None, "", "\n", "c" * 100_000, "c" * 99_999 + "C", "c" * 100_000, "é", "e\u0301"]
    rows = [(10 + i, t) for i, t in enumerate(texts)] + [(10, "a b"), (None, "ab")] + [(i, "hot text") for i in range(200, 400)]
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = content_sort.content_groups(docs(spark, rows)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(got) == len(rows)
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i is None, i))
    by = {hashlib.sha256(k.encode()).hexdigest(): (min(v)[2], len(v)) for k, v in groups.items()}
    assert all((r["keep_id"], r["group_size"]) == by[r["digest"]] for r in got)
    assert sum(r["kept"] for r in got) == len(groups) and all(r["id"] == r["keep_id"] for r in got if r["kept"])
    assert content_sort.content_groups(docs(spark, [])).count() == 0


# ---------------------------------------------------------------- URLs
def test_url_rules(spark):
    urls = [None, "no scheme", "HTTP://WWW.Example.NET/en/1?q#f", "http://example.net", "x://a.net/", "http://example.com/de/1", "http://badexample.com/de/1", "https://b.org/fr/x", "http://b.org/FR/x", "a://b.net?x://c", "http://h.org:80/fr/"]
    pages = spark.createDataFrame([(i, u, "k") for i, u in enumerate(urls)], "page_id long, url string, host string")
    got = {r["id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_templates.judge(pages, queries.URL_RULES).collect()}
    assert got[0] == got[1] == ("", "", None, "allow")
    assert got[2] == ("www.example.net", "/en/1", "example.net/en/", "allow")
    assert got[3] == ("example.net", "", None, "allow") and got[4] == ("a.net", "/", "net/", "block")
    assert got[5][2:] == ("example.com/de/", "block") and got[6][2:] == (None, "allow")
    assert got[7][2:] == ("org/fr/", "allow") and got[8][2:] == (None, "allow") and got[9][:2] == ("b.net", "")
    assert got[10] == ("h.org:80", "/fr/", None, "allow")
    assert url_templates.judge(pages.limit(0), queries.URL_RULES).count() == 0


def test_url_templates(spark):
    rows = [("h", f"/shop/item{k}", "block" if k < 30 else None) for k in range(40)]
    rows += [("h", f"/blog/p{k}/x", "allow" if k < 20 else None) for k in range(40)]
    rows += [("h", f"/{w}/{k}", "block") for w in ("red", "blue") for k in range(10)] + [("h", f"/new/{k}", None) for k in range(5)]
    rows += [("g", "/" + "/".join("abcdefghijkl"), None), ("h", "", None)]
    judged = spark.createDataFrame(rows, "host string, path string, label string").withColumn("segments", url_templates.segments_of(F.col("path")))
    tree = {(r["host"], r["template"]): (r["n_labelled"], r["n_blocked"], r["rejected"]) for r in url_templates.template_tree(judged).collect()}
    assert tree["h", "/shop/item#"] == (30, 30, True)
    assert tree["h", "/blog/p#/x"] == (20, 0, False)
    assert tree["h", "/new/#"] == (0, 0, False)
    assert tree["g", "/a/b/c/d/e/f/g/h/**"] == (0, 0, False)


def test_url_templates_of_any_depth(spark):
    deep = "/" + "/".join("abcdefghijkl")
    rows = [(k, f"http://h.org{deep}/spam/{k}" + "/e" * 30) for k in range(100, 200)]
    rows += [(k, f"http://h.org{deep}/good/{k}") for k in range(300, 400)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    rules = [("h.org", f"{deep}/spam/1{d}", "block") for d in range(9)] + [("h.org", f"{deep}/good/3{d}", "allow") for d in range(9)]
    got = {r["id"]: (r["rule"], r["verdict"], r["template"]) for r in url_templates.judge(pages, rules).collect()}
    assert len(got) == 200
    for k in range(190, 200):
        assert got[k][:2] == (None, "block")
        assert got[k + 200] == (None, "allow", None)
    assert got[191][2] == f"{deep}/spam/#" + "/e" * 30
    capped = url_templates.judge(pages, rules, depth=8).where("id in (191, 391)").collect()
    assert {(r["verdict"], r["template"]) for r in capped} == {("allow", None)}


# ---------------------------------------------------------------- archive
def test_archive(spark, tmp_path):
    big, small = "é" * 60, "s" * 99
    rows = [(5, "http://a/%\r\nX-Page: 9", big, "k"), (3, None, big, "k"), (3, "u", big, "k"), (None, "n", big, "k"), (7, "v", small, "k"), (6, "w", small, "k"), (8, "x", None, "k"), (9, "y", "", "k"), (10, "z", "L" * 500_000, "k")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string")
    path = str(tmp_path / "archive")
    archive.write_archive(pages, path)
    got = archive.read_captures(spark, path).collect()
    assert len(got) == len(rows)
    assert Counter((r["page"], r["url"], r["payload_bytes"]) for r in got) == Counter(
        (None if i is None else str(i), u, len((h or "").encode())) for i, u, h, _ in rows)
    copies = [r for r in got if r["payload_bytes"] == 120]
    assert Counter(r["record_type"] for r in copies) == {"response": 1, "revisit": 3}
    assert all(r["refers_to"] == "3" for r in copies if r["record_type"] == "revisit")
    assert next(r["page"] for r in copies if r["record_type"] == "response") == "3"
    assert all(r["record_type"] == "response" for r in got if r["payload_bytes"] < 100)
    whole = archive.reconstruct(spark, path).where("page = '10'").first()
    head, _, body = bytes(whole["record"]).partition(b"\r\n\r\n")
    assert head.startswith(b"WARC/1.1\r\nWARC-Type: response") and body == b"L" * 500_000 + b"\r\n\r\n"
    assert archive.read_payloads(spark, path).count() == len({h or "" for _, _, h, _ in rows})
    empty = str(tmp_path / "empty")
    archive.write_archive(pages.limit(0), empty)
    assert archive.read_captures(spark, empty).count() == 0


def test_archive_records(spark, tmp_path):
    texts = ["é" * 60] * 3 + ["s" * 99] * 2 + [None, "", "L" * 5000, "a\r\n\r\nb" * 30]
    rows = [(i, f"http://é/{i}\r\n", t, "k") for i, t in enumerate(texts)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string")
    path = str(tmp_path / "archive")
    archive.write_archive(pages, path)
    whole = {int(r["page"]): r for r in archive.reconstruct(spark, path).collect()}
    read = {int(r["page"]): r for r in archive.read_records(spark, path).collect()}
    assert set(whole) == set(read) == set(range(len(texts)))
    for i, text in enumerate(texts):
        payload = (text or "").encode()
        digest = hashlib.sha256(payload).hexdigest()
        revisit = i in (1, 2)
        head, _, body = bytes(whole[i]["record"]).partition(b"\r\n\r\n")
        fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
        assert body == (b"" if revisit else payload) + b"\r\n\r\n" and bytes(whole[i]["payload"]) == payload
        assert fields[b"WARC-Type"] == (b"revisit" if revisit else b"response")
        assert fields[b"Content-Length"] == (b"0" if revisit else str(len(payload)).encode())
        assert fields[b"WARC-Payload-Digest"] == f"sha256:{digest}".encode()
        assert fields[b"WARC-Target-URI"] == f"http://é/{i}%0D%0A".encode() and fields.get(b"X-Refers-To-Page") == (b"0" if revisit else None)
        assert (read[i]["digest"], read[i]["payload_bytes"]) == (digest, len(payload))
    lost = str(tmp_path / "lost")
    spark.read.parquet(f"{path}/headers").write.parquet(f"{lost}/headers")
    spark.read.parquet(f"{path}/payloads").where("length(payload) <> 5000").write.parquet(f"{lost}/payloads")
    for reader in (archive.read_captures, archive.reconstruct, archive.read_records):
        with pytest.raises(Exception, match="missing payload"):
            reader(spark, lost).collect()
    cut = str(tmp_path / "cut")
    spark.read.parquet(f"{path}/payloads").write.parquet(f"{cut}/payloads")
    spark.read.parquet(f"{path}/headers").select(
        F.replace("header", F.lit("Content-Length: 5000"), F.lit("Content-Length: 4999")).alias("header")
    ).write.parquet(f"{cut}/headers")
    with pytest.raises(Exception, match="damaged record"):
        archive.read_records(spark, cut).collect()


def parsed_warc(data):
    """(fields, block) of every record, by the lengths that the headers state."""
    at, out = 0, []
    while at < len(data):
        end = data.index(b"\r\n\r\n", at) + 4
        first, *lines = data[at : end - 4].decode().split("\r\n")
        assert first == "WARC/1.1"
        fields = dict(line.split(": ", 1) for line in lines)
        assert len(fields) == len(lines)
        n = int(fields["Content-Length"])
        out.append((fields, data[end : end + n]))
        at = end + n + 4
        assert data[at - 4 : at] == b"\r\n\r\n"
    return out


def test_archive_for_other_readers(spark, tmp_path):
    texts = ["x" * 200, "x" * 200, "a\r\n\r\nWARC/1.1\r\n", None]
    rows = [(i, f"http://a/b%20c/{i}?q=%25", t, at) for (i, t), at in zip(enumerate(texts), ["2026-01-02 03:04:05+00:00", None, None, None])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, at string")
    ids = set()
    for name in ("one", "two"):
        path = str(tmp_path / name)
        archive.write_archive(pages, path, date_col="at")
        records = parsed_warc(b"".join(bytes(r["record"]) for r in archive.reconstruct(spark, path).select("record").collect()))
        by = {int(f["X-Page"]): (f, block) for f, block in records}
        assert set(by) == {0, 1, 2, 3}
        for i, text in enumerate(texts):
            fields, block = by[i]
            assert fields["WARC-Target-URI"] == rows[i][1] and block == (b"" if i == 1 else (text or "").encode())
            assert re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ", fields["WARC-Date"])
            assert re.fullmatch(r"<urn:uuid:[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}>", fields["WARC-Record-ID"])
            ids.add(fields["WARC-Record-ID"])
        assert by[0][0]["WARC-Date"] == "2026-01-02T03:04:05Z"
        assert by[1][0]["WARC-Refers-To"] == by[0][0]["WARC-Record-ID"] and by[1][0]["WARC-Type"] == "revisit"
        assert {r["url"] for r in archive.read_records(spark, path).collect()} == {r[1] for r in rows}
    assert len(ids) == 8  # no two archives share one


# ---------------------------------------------------------------- pipeline
@needs_tables
def test_pipeline_stages(spark):
    import corpus_pipeline

    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    at = documents.unionByName(documents.limit(3)).withColumn("kept", F.lit(1))
    ids = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, at, SF_DIR).cache()
        assert out.columns == at.columns
        ids[name], at = [r["doc_id"] for r in out.select("doc_id").collect()], out
    assert len(ids["exact dedup"]) == len(set(ids["exact dedup"]))
    before = at.sparkSession.createDataFrame([(i,) for i in ids["exact dedup"]], "doc_id long")
    texts = [(r["doc_id"], r["text"]) for r in documents.join(before, "doc_id").collect()]
    assert sorted(ids["n-gram Jaccard join"]) == sorted({c for _, c in brute_components(texts).values()})
    packed = corpus_pipeline.STAGES[-1][1](spark, at, SF_DIR)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == set(ids["benchmark decontamination"])


def test_crc_of_ids(spark):
    data = np.array([5, 50256, 1], dtype="<u4").tobytes()
    row = spark.createDataFrame([(bytearray(data),)], "ids binary").select(F.crc32("ids").alias("c")).first()
    assert row["c"] == zlib.crc32(data)
