"""Token alignment against an independent brute force."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tickflow.llm import token_align

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
EDGE = [(1, None), (2, ""), (3, " "), (4, "a" * 5000), (5, "é日本 👩‍👩‍👧 ñ \x1c\x85cd"), (6, "x  \t\r\n y"), (7, "<|endoftext|> <s> </s> <unk>"), (8, "a▁b"),
        (9, "same"), (9, "same"), (None, "ﬁ ½   　x"), (11, "it's 'll 12345 +=  \n\n  a"), (12, "word " * 4000), (13, "\0a​ b"), (14, "﻿" * 9 + "日" * 700)]


def _ends(pieces):
    return np.cumsum([len(p) for p in pieces]).tolist()


def brute_force(rows):
    """Result rows by a merge of both tokens' ends, without chunks."""
    tokenizer, model = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    tokenizer.encode_special_tokens = True
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in plain}
    byte |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
    entry = {i: w for w, i in tokenizer.get_vocab().items()}
    found, docs = [], Counter()
    for doc_id, text in rows:
        whole = (" " + (text or "")).encode()
        a = tokenizer.encode(whole.decode(), add_special_tokens=False).ids if text else []
        b = model.encode(text) if text else []
        pa = [bytes(byte[c] for c in entry[i]) for i in a]
        pb = [bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or b"".join(pa) != whole or b"".join(pb) != whole:
            found.append((doc_id, 0, 0, [], []))
            continue
        ea, eb, groups, links, i, j = _ends(pa), _ends(pb), [], [], 0, 0
        for cut in sorted({*ea} & {*eb}):
            ni, nj = ea.index(cut, i) + 1, eb.index(cut, j) + 1
            groups.append((a[i:ni], b[j:nj]))
            links += [(a[x], b[y]) for x in range(i, ni) for y in range(j, nj)
                      if ea[x] - len(pa[x]) < eb[y] and eb[y] - len(pb[y]) < ea[x]]
            i, j = ni, nj
        docs.update(set(links))
        found.append((doc_id, len(a), len(b), groups, links))
    most = {}
    for (x, _), n in docs.items():
        most[x] = max(most.get(x, 0), n)
    out = []
    for doc_id, n_a, n_b, groups, links in found:
        line = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((doc_id, n_a, n_b, len(groups), len(links), sum(docs[p] == most[p[0]] for p in links), sum(docs[p] for p in links),
                    hashlib.sha256(line.encode()).hexdigest() if line else ""))
    return sorted(out, key=str)


def rows(df):
    return sorted(((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect()), key=str)


@pytest.mark.parametrize("chunk_bytes", [1, 3000, 4_000_000])
def test_edge_cases(spark, monkeypatch, chunk_bytes):
    monkeypatch.setattr(token_align, "CHUNK_BYTES", chunk_bytes)
    docs = spark.createDataFrame([(*r, "kept", 7, 8, "x") for r in EDGE], "doc_id bigint, text string, chunk string, place int, n_a int, `of` string")
    got = token_align.align(docs, A, B)
    assert set(got.columns) == {"doc_id", "chunk", "place", "of", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"}
    assert rows(got) == brute_force(EDGE)
    assert {(r.chunk, r.place, r.of) for r in got.collect()} == {("kept", 7, "x")}
    assert token_align.align(docs.limit(0), A, B).count() == 0


def test_query_on_a_whole_table(spark):
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    assert rows(token_align.op13_token_alignment(spark, "/root/testdata/sf0.001")) == brute_force(docs)


def test_groups_cover_the_text(spark):
    docs = spark.createDataFrame(EDGE, "doc_id bigint, text string")
    for r in token_align.token_groups(docs, A, B).collect():
        assert sum(g.n_a for g in r.groups) == len(r.a_ids) and sum(g.n_b for g in r.groups) == len(r.b_ids)
        assert not r.groups or r.groups[-1].end == len((" " + r.text).encode())


def test_cuts_equal_the_intersection():
    rng = np.random.default_rng(5)
    for _ in range(200):
        a, b, starts, base = [], [], [[0], [0]], 0
        for _ in range(rng.integers(1, 5)):
            size = int(rng.integers(1, 60))
            for side, out in enumerate((a, b)):
                own = np.flatnonzero(rng.random(size) < rng.random()) + 1 if size > 1 else np.empty(0, int)
                ends = sorted({*own.tolist(), size}) if rng.random() < 0.9 else [size]
                out += [base + e for e in ends]
                starts[side].append(len(out))
            base += size
        ea, eb = np.array(a), np.array(b)
        cut_a, cut_b = token_align.shared_cuts(ea, np.array(starts[0]), eb, np.array(starts[1]))
        both = np.intersect1d(ea, eb)
        assert ea[cut_a].tolist() == both.tolist() == eb[cut_b].tolist()


def test_units_are_encoded_once_and_equal_whole_texts():
    pair, rng = token_align.Pair(A, B), np.random.default_rng(11)
    parts = ["a", "b", " ", " ", "\n", "▁", "é", "\u3000", "\x1c", "\x85", "'s", "日本", "<s>", "<|endoftext|>", "\0", "ing", "12", ".", "\t", "\u0308", "<0x0A>"]
    texts = [t for _, t in EDGE] + ["".join(rng.choice(parts, rng.integers(1, 30))) for _ in range(600)] + ["same words of a text " * 50]
    asked = []
    encode = pair.b.encode
    pair.b = type("Counted", (), {"encode": lambda _, xs, **more: asked.extend(xs) or encode(xs, **more)})()
    got = token_align.Aligned(pair, texts)
    model = sentencepiece.SentencePieceProcessor(model_file=B)
    for text, n_b in zip(texts, got.n_b):
        whole = model.encode(text) if text else []
        spelled = b"".join(map(pair.b_bytes.__getitem__, whole)) == b" " + (text or "").encode()
        assert n_b == (len(whole) if spelled else 0), text
    assert got.digests()[-1] == token_align.Aligned(pair, texts[-1:]).digests()[0]
    # encoded whole before: 22,000 characters
    asked.clear()
    token_align.Aligned(pair, ["other words of a text " * 1000])
    assert sum(map(len, asked)) < 100
