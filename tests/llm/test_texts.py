"""Operators that work on each document alone: token counts, HTML text, BPE, toxicity, chats."""

import hashlib
import re
import struct
import subprocess
import sys
from pathlib import Path

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tickflow.llm import bpe, chat, html_text, token_counts, toxicity

VOCAB, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
TEXTS = [None, "", " ", "it's  \n ok", "a" * 3000, "é日本 👩‍👩‍👧 ñ", "x \t\r\n y", "word " * 4000, "ab\x1c\x85cd", "same", "same", "1234 5,6", "'ll 're"]


@pytest.fixture(scope="module")
def encoder():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe._ranks(VOCAB), special_tokens={})


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i if i else None, t, "en", 7) for i, t in enumerate(TEXTS)], "doc_id bigint, text string, lang string, n_tokens int")


def test_bpe_equals_the_library(docs, encoder):
    got = bpe.digests(docs, VOCAB, PATTERN).collect()
    assert len(got) == len(TEXTS) and set(got[0].asDict()) == {"doc_id", "text", "lang", "n_tokens", "ids_sha256", "decoded_sha256"}
    for r in got:
        ids = encoder.encode_ordinary(r.text or "")
        assert r.n_tokens == len(ids), r.text
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()


def test_bpe_round_trip_and_empty_table(docs, encoder):
    got = bpe.decode(bpe.encode(docs, VOCAB, PATTERN), VOCAB, PATTERN).collect()
    assert all(bytes(r.decoded) == (r.text or "").encode() and list(r.ids) == encoder.encode_ordinary(r.text or "") for r in got)
    assert bpe.digests(docs.limit(0), VOCAB, PATTERN).count() == 0


def test_bpe_query_on_whole_table(spark, encoder):
    from tickflow.llm.queries import op8_byte_bpe
    text = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    got = op8_byte_bpe(spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id for r in got} == set(text) and all(r.n_tokens == len(encoder.encode_ordinary(text[r.doc_id])) for r in got)


_PEAK = """
import random, sys, threading, time
from pathlib import Path
import pyarrow
from tickflow.llm import bpe

def held():
    return int(re.search(r"RssAnon:\\s+(\\d+)", Path("/proc/self/status").read_text())[1]) / 1024

import re
rng, words = random.Random(7), set()
while len(words) < 60_000:
    words.add(" " + "".join(rng.choices("abcdefghiklmnoprstuvwzé", k=rng.randint(5, 12))))
codec = bpe._Codec(*sys.argv[1:])
before, most = held(), [0]

def watch():
    while True:
        most[0] = max(most[0], held())
        time.sleep(0.02)

threading.Thread(target=watch, daemon=True).start()
codec.units(words)
print("MB", most[0] - before)
"""


@pytest.mark.skipif(sys.platform != "linux", reason="reads /proc")
def test_bpe_memory_of_a_worker():
    root = Path(bpe.__file__).resolve().parents[2]
    done = subprocess.run([sys.executable, "-c", _PEAK, VOCAB, PATTERN], cwd=root, capture_output=True, text=True, timeout=300)
    assert float(re.search(r"MB (\S+)", done.stdout)[1]) < 100, done.stderr  # 136 MB with 60,000 pre-tokens in a run, 64 with 10,000


def test_bpe_rows_sent_and_returned(spark, docs):
    before = spark.conf.get(bpe.SENT)
    try:
        spark.conf.set(bpe.SENT, "64m")
        whole, thin = bpe.digests(docs, VOCAB, PATTERN), bpe.digests(docs, VOCAB, PATTERN, keep_text=False)
        assert spark.conf.get(bpe.SENT) == str(bpe.BYTES_SENT)
        assert thin.columns == [c for c in whole.columns if c != "text"]
        assert sorted(map(str, thin.collect())) == sorted(map(str, whole.drop("text").collect()))
        spark.conf.set(bpe.SENT, "1k")
        assert sorted(map(str, bpe.digests(docs, VOCAB, PATTERN, keep_text=False).collect())) == sorted(map(str, thin.collect()))
        assert spark.conf.get(bpe.SENT) == "1k"  # a lower setting stays
    finally:
        spark.conf.set(bpe.SENT, before)


def test_edited_trees_equal_a_full_count(encoder):
    counter, rng = token_counts.Counter(VOCAB, PATTERN), np.random.default_rng(3)
    inserts = ["", "'s", "  ", "\n\n", " x", "ab'll re 12", "'", "é日"]
    for text in [t or "" for t in TEXTS] + ["The quick brown fox's 12 jumps,  over\n\nthe lazy dog. " * 40]:
        tree, now = token_counts.Tree(text, counter), text
        for _ in range(40):
            a = int(rng.integers(0, len(now) + 1))
            b, s = min(len(now), a + int(rng.integers(0, 9))), inserts[rng.integers(0, len(inserts))]
            tree.edit(a, b, s)
            now = now[:a] + s + now[b:]
            assert tree.text() == now and tree.tokens[1] == len(encoder.encode_ordinary(now))


def test_edits_as_rows_and_query(spark, docs, encoder):
    edits = spark.createDataFrame([(3, 1, 0, 2, "was"), (3, 2, 100, 200, None), (5, 1, 2, 1, "Q"), (12, 1, -4, 0, "z ")], "doc_id bigint, seq int, start int, stop int, insert string")
    got = {(r.doc_id, r.text): r for r in token_counts.count_edits(token_counts.attach_edits(docs, edits), VOCAB, PATTERN).collect()}
    assert got[3, TEXTS[3]].n_tokens_after == len(encoder.encode_ordinary("was" + TEXTS[3][2:]))
    assert got[12, TEXTS[12]].n_tokens_after == len(encoder.encode_ordinary("z " + TEXTS[12]))
    assert got[None, None].n_tokens == 0 and got[9, "same"].n_edits == 0
    assert token_counts.count_edits(token_counts.redaction_edits(docs.limit(0)), VOCAB, PATTERN).count() == 0
    whole = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for r in token_counts.op3_token_counts(spark, "/root/testdata/sf0.001").collect():
        assert r.n_tokens == len(encoder.encode_ordinary(whole[r.doc_id]))
        assert r.n_tokens_after == len(encoder.encode_ordinary(token_counts.PERSONAL.sub(token_counts.REDACTED, whole[r.doc_id])))


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("<p hidden>x</p>", ""), ("a<br>b", "a\nb"), ("<p>one<p>two", "one\n\ntwo"), ("plain &amp; simple", "plain & simple"),
    ("<ul><li>a<li>b<ol start=3><li>c</ol></ul>", "- a\n- b\n  3. c"), ("<div>a</div><div>b  \n c</div>", "a\nb c"),
    ("<table><tr><th>Name<th>Qty<tr><td>fig<td>3</table>", "Name | Qty\nfig  | 3"), ("<table><td>x<td>日本<tr><td>longer<td>y</table>", "x      | 日本\nlonger | y"),
    ("<pre> a\n  b</pre>", " a\n  b"), ("a<!-- b", "a"), ("a<script>if (b < c) {}</script>d", "ad"), ("<span style='display: none'>x</span>y", "y"), ("</div></p>z", "z"),
])
def test_html(page, text):
    assert html_text.page_text(page) == text


@pytest.mark.parametrize("page,text", [
    ("<html><head><title>T</title><p>Hello", "Hello"), ("<head><meta charset=utf-8>\n<title>T</title>\nHello <b>you</b>", "Hello you"),
    ("<head><noscript><img src=x></noscript><style>p {}</style><title>T</title><link rel=x><body>Hello", "Hello"), ("<head><head><div>Hello</div>", "Hello"),
    ("<head><title>T</title></head>Hello", "Hello"), ("<head> <title>T</title> ", ""),
    ("<div style='backface-visibility:hidden'>x</div>y", "x\ny"), ("<p style='-webkit-backface-visibility: hidden; color: red'>x", "x"),
    ("<p style='/* display: none */ color: red'>x", "x"), ("<p style='color: red; VISIBILITY : hidden'>x", ""), ("<p style='/* a */display:none!important'>x", ""),
])
def test_html_implied_head_and_whole_properties(page, text):
    assert html_text.page_text(page) == text


@pytest.mark.parametrize("page,text", [
    ("<b>x<p>y</b>z</p>q", "x\n\nyz\n\nq"), ("<div>a<table><td>b</div>c</table>d</div>e", "a\n\nbc\n\nd\ne"), ("<ul><li>a<ul></li><li>b</ul></ul>", "- a\n  - b"),
    ("<div style='visibility:hidden'>a <span style='visibility:visible'>b</span> c</div>d", "b\nd"),
    ("<ul style='visibility:hidden'><li>a<li style='visibility:visible'>b</ul>", "- b"),
    ("<details><summary>s</summary>body<details open>x</details></details>y", "s\ny"), ("<details open><summary>s</summary>body</details>", "s\nbody"), ("<details>body</details>y", "y"),
    ("<p style='display:none;display:block'>x", "x"), ("<p style='display:none;display:bogus'>x", ""), ("<p style='display:none!important;display:block'>x", ""),
    ("<p hidden style='display:block'>x", "x"), ("<p style='background:url(\"a;display:none\")'>x", "x"), ("<p style='display:none' style='display:block'>x", ""),
    ("<pre>\n a\n</pre>", " a"), ("<pre>\r\n\n a</pre>", "\n a"), ("x<pre>\n\n a</pre>", "x\n\n\n a"),
    ("<table><tr><td colspan=2>wide cell<td>z<tr><td>a<td>b<td>c</table>", "wide cell | z\na | b     | c"),
    ("<table><tr><td rowspan=2>r<td>a<tr><td>b<tr><td>c<td>d</table>", "r | a\n  | b\nc | d"),
    ("<table><tr><td colspan=1000>a<td>b<tr><td>c</table>", "a | b\nc"), ("<table><tr><td rowspan=0>r<td>a<tr><td>b<tr><td>c</table>", "r | a\n  | b\n  | c"),
    ("<table><tr><td colspan=x rowspan=-1>a<td colspan=0>b</table>", "a | b"), ("<table><tr><td rowspan=99999999999>a<td>b<tr><td>c</table>", "a | b\n  | c"),
])
def test_html_visibility_spans_and_end_tags(page, text):
    assert html_text.page_text(page) == text


def grid_of(rows):
    """Cells laid out one grid square after the other: the text that starts in each square, or None where a cell reaches."""
    taken, columns = {}, 0
    for r, row in enumerate(rows):
        c = 0
        for text, across, down in row:
            while (r, c) in taken:
                c += 1
            for i in range(r, min(len(rows), r + down)):
                for j in range(c, c + across):
                    taken.setdefault((i, j), (text if (i, j) == (r, c) else None, (r, c)))
            c += across
            columns = max(columns, c)
    return taken, columns


def test_html_tables_equal_a_grid_walk():
    """Random spans: every text of a row starts where the texts of its column start."""
    rng = np.random.default_rng(11)
    for _ in range(300):
        rows, n = [], 0
        for _ in range(int(rng.integers(1, 5))):
            row = []
            for _ in range(int(rng.integers(1, 4))):
                row.append((f"t{n:02}" + "x" * int(rng.integers(0, 6)), 1 if rng.random() < 0.6 else int(rng.integers(2, 4)), 1))
                n += 1
            rows.append(row)
        rows[0] = [(t, a, int(rng.integers(1, 3))) for t, a, _ in rows[0]]
        page = "<table>" + "".join("<tr>" + "".join(f"<td colspan={a} rowspan={d}>{t}" for t, a, d in row) for row in rows) + "</table>"
        lines = html_text.page_text(page).split("\n")
        assert len(lines) == len(rows)
        taken, _ = grid_of(rows)
        starts = {}
        for (r, c), (text, _) in taken.items():
            if text is not None:
                starts.setdefault(c, set()).add(lines[r].index(text))
        assert all(len(x) == 1 for x in starts.values()), page
        places = [next(iter(starts[c])) for c in sorted(starts)]
        assert places == sorted(set(places)), page
        assert re.findall(r"t\d\dx*", "\n".join(lines)) == [t for row in rows for t, _, _ in row]


def test_html_frame(spark):
    pages = spark.createDataFrame([(1, None, "k"), (2, "<p>x", "k"), (2, "<p>x", "k"), (3, "<div>" * 5000 + "deep", "k"), (4, "<table><tr><td>" * 40 + "deep", "k")], "page_id bigint, html string, text string")
    got = [(r.page_id, r.text.replace(" ", "")) for r in html_text.extract(pages).orderBy("page_id").collect()]
    assert got == [(1, ""), (2, "x"), (2, "x"), (3, "deep"), (4, "deep")]
    assert html_text.extract(pages.limit(0)).count() == 0


def test_chats(spark):
    rows = [(1, 0, "user", "hi"), (2, 0, "user", "hi"), (2, 1, "assistant", "yo"), (3, 0, "user", "hi"), (3, 1, "assistant", "yo"), (4, 0, "user", None),
            (5, 0, None, ""), (6, 1, "b", "2"), (6, 1, "a", "1"), (7, 0, "user", "hi"), (7, 1, "assistant", "no")]
    got = {r.conv_id: r for r in chat.format_chats(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("turns", F.lit(1))).collect()}
    assert set(got) == {2, 4, 5, 6, 7} and got[2].n_equal == 2 and got[4].rendered == "<|im_start|>user\n<|im_end|>\n"
    assert got[5].rendered == "<|im_start|>unknown\n<|im_end|>\n" and got[6].rendered.index("1") < got[6].rendered.index("2")
    assert chat.format_chats(spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")).count() == 0


def test_chats_of_many_turns(spark):
    """The hash list in blocks equals a plain loop; a long conversation collapses its snapshots at every block's end."""
    sizes = {1: 1, 2: 127, 3: 128, 4: 129, 5: 256, 6: 400, 7: 400}
    rows = [(c, t, None if t % 5 == 0 else "user", f"t{t}" if c < 7 or t < 399 else None) for c, n in sizes.items() for t in range(n)] + [(None, 0, "user", "w" * 200_000)] * 2
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    for r in chat.snapshots(turns).collect():
        before, want = "", []
        for t in r.turns:
            told = ["-" if x is None else f"{len(x.encode())}:{x}" for x in (t.role, t.text)]
            before = hashlib.sha256("|".join([before, *told]).encode()).hexdigest()
            want.append(before)
        assert r.prefix_hashes == want
    got = {r.conv_id: r.n_turns for r in chat.format_chats(turns).collect()}
    assert got == {6: 400, 7: 400, None: 2}


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"), toxicity.label_table(spark, sf)
    chain = toxicity.fit(docs, labels.filter("doc_id % 3 <> 0"), toxicity.CATEGORIES)
    got = toxicity.score(docs, chain, toxicity.CATEGORIES).join(labels, "doc_id").filter("doc_id % 3 = 0").toPandas()
    assert got[got.toxic == 1].flagged.mean() > 0.8 and got[got.toxic == 0].flagged.mean() < 0.02
    edge = spark.createDataFrame([(None, None, 1.0), (1, "", 2.0), (1, "", 2.0)], "doc_id bigint, text string, p_toxic double")
    assert [r.flagged for r in toxicity.score(edge, chain, toxicity.CATEGORIES).collect()] == [False] * 3
    assert toxicity.score(edge.limit(0), chain, toxicity.CATEGORIES).count() == 0


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id bigint, text string")
    labels = spark.createDataFrame([], "doc_id bigint, low_quality int, toxic int")
    chain = toxicity.fit(docs, labels, toxicity.CATEGORIES)
    assert toxicity.score(docs, chain, toxicity.CATEGORIES).count() == 2


def test_toxicity_trains_on_one_row_per_doc_id(spark):
    docs = spark.createDataFrame([(1, f"text {i % 7}") for i in range(40)] + [(2, "a b"), (3, None), (None, "x")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 0, 1), (1, 0, 1), (2, 1, 0), (3, 0, 0)], "doc_id bigint, low_quality int, toxic int")
    got = {}
    for order in (docs, docs.repartition(5)):
        rows = toxicity.training_rows(order, labels, toxicity.CATEGORIES).orderBy("doc_id").collect()
        assert [r.doc_id for r in rows] == [1, 2, 3]
        got.setdefault(tuple(tuple(r.features) for r in rows), rows)
    assert len(got) == 1
    assert toxicity.training_rows(docs, labels, toxicity.CATEGORIES, 2).count() == 2


def test_toxicity_fit_gives_its_memory_back(spark, docs, monkeypatch):
    labels, gone = docs.selectExpr("doc_id", "cast(doc_id % 2 as int) AS a"), []
    fitted = toxicity._fitted
    monkeypatch.setattr(toxicity, "_fitted", lambda *args: (fitted(*args), gone.append("fitted"))[0])
    monkeypatch.setattr(toxicity, "give_back", lambda: gone.append("given back"))
    assert len(toxicity.fit(docs, labels, ["a"])) == 1 and gone == ["fitted", "given back"]


def test_out_of_fold_chain():
    rng = np.random.default_rng(0)
    rows = [np.unique(rng.integers(0, 500, 20)) for _ in range(600)]
    first = np.array([int(3 in r or 7 in r) for r in rows])
    chain = toxicity.fit_chain(rows, np.column_stack((first, first)), np.arange(600) % 3)
    assert chain[1].dense.shape == (1,) and pd.Series(toxicity.chain_predict(chain, rows)[:, 1]).between(0, 1).all()
