"""Aligned tokens against both libraries and plain loops."""

import hashlib
import random
from collections import Counter

import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from vidpipe.llm import registry, token_alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
PARTS = [
    "a", "b ", " ", "  ", "\n", "\t", " ", " ", "　", "▁", "é", "字", "ñ ", "\U0001f600", "'s", "1", "23", " .", "<s>", "<|endoftext|>", "</s>", "<0x41>", "\x85", "​", "é",
    "\x00", "\x1c", "﻿", "Ω", "ﬁ", "\r\n", "x" * 50, " the", " of",
]


def plain(texts):
    own = Tokenizer.from_file(A)
    own.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=B)
    sizes = [s.spelled for s in token_alignment._sides(A, B)]
    groups = []
    for t in texts:
        ids = (own.encode(" " + t, add_special_tokens=False).ids, model.encode(t)) if t else ([], [])
        if not t or any(b"".join(s[i] for i in x) != (" " + t).encode() for s, x in zip(sizes, ids, strict=True)):
            groups.append([])
            continue
        ends = []
        for s, x in zip(sizes, ids, strict=True):
            at, own_ends = 0, []
            for i in x:
                at += len(s[i])
                own_ends.append(at)
            ends.append(own_ends)
        found, i, j = [], 0, 0
        for e in sorted(set(ends[0]) & set(ends[1])):
            x, y = [], []
            while i < len(ids[0]) and ends[0][i] <= e:
                x.append(ids[0][i])
                i += 1
            while j < len(ids[1]) and ends[1][j] <= e:
                y.append(ids[1][j])
                j += 1
            found.append((x, y))
        groups.append(found)
    count = Counter()
    for g in groups:
        count.update({(x, y) for u, v in g for x in u for y in v})
    most = Counter()
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    out = []
    for g in groups:
        links = [(x, y) for u, v in g for x in u for y in v]
        shown = ";".join(",".join(map(str, u)) + "|" + ",".join(map(str, v)) for u, v in g)
        out.append((sum(len(u) for u, _ in g), sum(len(v) for _, v in g), len(g), len(links), sum(count[p] == most[p[0]] for p in links), sum(count[p] for p in links), shown))
    return out, count, most


@pytest.fixture(scope="module")
def texts():
    r = random.Random(1)
    odd = ["".join(r.choice(PARTS) for _ in range(r.randrange(20))) for _ in range(1500)]
    return odd + [None, "", " ", "  ", "   ", "\n", "a ", " a", "a  ", "same text", "same text", "字" * 3000, "long words " * 4000, "y" * 20000]


@pytest.mark.parametrize("bounds", [(4 << 20, 1 << 22), (200, 50)])
def test_alignment_against_plain_loops(spark, texts, monkeypatch, bounds):
    size, pairs = bounds
    rows = [(i, t, 1, 2, "c", 3) for i, t in enumerate(texts)] + [(None, "of null", 1, 2, "c", 3), (3, texts[3], 1, 2, "c", 3)]
    want, count, most = plain([r[1] for r in rows])
    docs = spark.createDataFrame(rows, "doc_id long, text string, chunk int, piece int, pair string, docs int").repartition(3)
    if size < 1000:  # the same chunk by chunk, without Spark: bounds are read where the work is done
        monkeypatch.setattr(token_alignment, "PAIRS", pairs)
        part = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows])], names=["doc_id", "text"])
        got = token_alignment._chunk(part, 0, token_alignment._sides(A, B)).to_pylist()[0]
        assert dict(zip(got["pair"], got["docs"], strict=True)) == {(x << 32) + y: n for (x, y), n in count.items()}
        return
    got = sorted((tuple(r) for r in token_alignment.align(docs, A, B).collect()), key=str)
    assert got == sorted(((r[0], *w) for r, w in zip(rows, want, strict=True)), key=str)
    assert sum(w[2] > 0 for w in want) > 800 and sum(w[2] == 0 for w in want) > 50
    monkeypatch.setattr(token_alignment, "SENT", 0)  # counts that are too many to be sent are joined
    joined = token_alignment.align(docs, A, B)
    assert "CoGroup" in joined._jdf.queryExecution().toString() and sorted((tuple(r) for r in joined.collect()), key=str) == got
    pairs = token_alignment.pair_counts(docs, A, B).collect()
    assert {(r.a, r.b): (r.docs, r.best) for r in pairs} == {p: (n, most[p[0]] == n) for p, n in count.items()}


def test_nothing_to_align(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert token_alignment.align(none, A, B).count() == token_alignment.pair_counts(none, A, B).count() == 0
    only = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert sorted(map(tuple, token_alignment.align(only, A, B).collect())) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_a_model_whose_pieces_reach_over_spaces_is_refused(monkeypatch):
    class Model:
        def __init__(self, model_file):
            pass

        def get_piece_size(self):
            return 2

        def id_to_piece(self, i):
            return ["▁", "a▁b"][i]

    monkeypatch.setattr(sentencepiece, "SentencePieceProcessor", Model)
    with pytest.raises(ValueError):
        token_alignment._pieced("x")


def test_alignment_query(spark):
    sf = "/root/testdata/sf0.001"
    given = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    got = registry.op11_token_alignment(spark, sf).collect()
    want, _, _ = plain([given[r.doc_id] for r in got])
    for r, w in zip(got, want, strict=True):
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum) == w[:6]
        assert r.groups_sha256 == (hashlib.sha256(w[6].encode()).hexdigest() if w[2] else "")
