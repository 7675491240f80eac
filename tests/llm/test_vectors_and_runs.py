"""Near-duplicate vectors and runs of repeated words against brute force, with the awkward cases."""

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from vidpipe.llm import embedding_dedup, oracles, periodic_runs, registry

WORD = re.compile(r"[^\x20\x09-\x0D]+")
VECTORS = "vec_id long, embedding array<double>, label string, rep int, tile string, least int, grp int"


# 12 -----------------------------------------------------------------------------------------------------------------


def vectors(spark, rows):
    """Further columns have names that the operator uses itself."""
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], l, 1, "t", 2, 3) for i, v, l in rows], VECTORS)


def plain(rows, threshold):
    """Links by all pairs; the least id by following them."""
    ok = lambda v: v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)
    scaled = [(i, np.array(v, float) / np.abs(v).max(), l) for i, v, l in rows if i is not None and l is not None and ok(v)]
    good = [(i, v / np.linalg.norm(v), l) for i, v, l in scaled]
    near = {i: set() for i, _, _ in rows if i is not None}
    for a, (i, v, l) in enumerate(good):
        for j, w, m in good[:a]:
            if l == m and len(v) == len(w) and v @ w >= threshold:
                near[i].add(j)
                near[j].add(i)
    least = {}
    for i in sorted(near):
        todo = [i] if i not in least else []
        while todo:
            x = todo.pop()
            if x not in least:
                least[x] = i
                todo += near[x]
    return {i: (len(near[i]), least[i]) for i in near}


@pytest.fixture(scope="module")
def many_vectors():
    r = np.random.default_rng(4)
    rows = []
    for label in ("a", "b"):
        centres = r.normal(size=(6, 24)) * np.linspace(3, 0.2, 24)
        for c in centres:
            rows += [(None, c + r.normal(size=24) * s, label) for s in (0.02, 0.05, 0.1, 0.15, 0.2, 0.3) for _ in range(12)]
        chain = [np.eye(24)[0] * np.cos(t) + np.eye(24)[1] * np.sin(t) for t in np.arange(0, 1.5, 0.15)]  # a long path of links
        rows += [(None, v * 7, label) for v in chain]
        rows += [(None, centres[0], label)] * 40 + [(None, centres[0] * 1e-200, label), (None, centres[0] * 1e200, label)]
    order = r.permutation(len(rows))
    rows = [(int(k), v.tolist(), l) for k, (_, v, l) in zip(order, rows, strict=True)]
    odd = [None, [], [0.0] * 24, [1.0, None] + [0.0] * 22, [float("nan")] * 24, [float("inf")] + [1.0] * 23, [1.0] * 23]
    rows += [(10000 + k, v, "a") for k, v in enumerate(odd)]
    return rows + [(20000, rows[0][1], None), (20001, rows[0][1], "c"), (20002, [1.0] * 23, "a"), (20003, [-x for x in rows[0][1]], rows[0][2])]


@pytest.mark.parametrize("tile", [8, 2048])
def test_vectors_against_all_pairs(spark, many_vectors, monkeypatch, tile):
    monkeypatch.setattr(embedding_dedup, "TILE", tile)
    got = embedding_dedup.near_vectors(vectors(spark, many_vectors)).collect()
    want = plain(many_vectors, 0.98)
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == want and len(got) == len(want)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    assert sum(n for n, _ in want.values()) > 5000


def test_vectors_with_null_and_repeated_ids(spark):
    rows = [(None, [1, 0], "a"), (1, [1, 0], "a"), (1, [1, 0], "a"), (2, [1, 0.01], "a"), (2, [0, 1], "a"), (3, [0.01, 1], "a")]
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_vectors(vectors(spark, rows)).collect()), key=str)
    assert got == sorted([(None, 0, None, True), (1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (2, 1, 2, True), (3, 1, 2, False)], key=str)
    assert embedding_dedup.near_vectors(vectors(spark, [])).count() == 0
    assert embedding_dedup.near_vectors(vectors(spark, [(7, None, "a")])).collect()[0][:] == (7, 0, 7, True)


def test_pairs_are_dropped_early_and_none_that_link():
    r = np.random.default_rng(1)
    x = r.normal(size=(700, 64))
    x[350:] = x[:350] + r.normal(size=(350, 64)) * 0.1
    y = x[::-1].copy()
    u, v = (t / np.linalg.norm(t, axis=1, keepdims=True) for t in (x, y))
    _, turn = np.linalg.eigh(u.T @ u)
    found = set(zip(*map(np.ndarray.tolist, embedding_dedup.linked(x, y, turn[:, ::-1], 0.98)), strict=True))
    assert found == set(zip(*map(np.ndarray.tolist, np.nonzero(u @ v.T >= 0.98)), strict=True)) and len(found) > 700


def test_tiles_are_bounded_and_rows_follow_the_vectors(spark, monkeypatch):
    """A third of all vectors close together: no tile of more than some TILE vectors, and no row for each pair."""
    monkeypatch.setattr(embedding_dedup, "TILE", 64)
    seen = {}

    def keep(df, what, real=embedding_dedup.written):
        seen[what] = real(df, what)
        return seen[what]

    monkeypatch.setattr(embedding_dedup, "written", keep)
    r = np.random.default_rng(2)
    near = r.normal(size=16) + r.normal(size=(400, 16)) * 0.05
    rows = [(k, v.tolist(), "a") for k, v in enumerate(np.concatenate([near, r.normal(size=(800, 16))]))]
    got = embedding_dedup.near_vectors(vectors(spark, rows)).collect()
    assert {x.vec_id: (x.n_links, x.component_id) for x in got} == plain(rows, 0.98)
    assert seen["tiles"].select(F.max(F.length("reps") / 8)).first()[0] < 3 * 64
    tiles = seen["tiles"].count()
    assert seen["links"].count() <= 2 * 64 * tiles * tiles / 2 and seen["links"].count() < sum(x.n_links for x in got) / 2


def test_vector_query_equals_its_sql(spark):
    got = registry.op12_embedding_near_dedup(spark, "/root/testdata/sf0.001")
    con = duckdb.connect()
    con.execute("CREATE VIEW embeddings AS SELECT * FROM '/root/testdata/sf0.001/embeddings.parquet'")
    want = con.execute(oracles.EMBEDDINGS)
    names = [d[0] for d in want.description]
    assert sorted(map(tuple, got.select(names).collect())) == sorted(want.fetchall())


# 13 -----------------------------------------------------------------------------------------------------------------


def lyndon(codes):
    n = len(codes)
    return [max(m for m in range(1, n - i + 1) if all(codes[i : i + m] < codes[i + k : i + m] for k in range(1, m))) for i in range(n)]


def all_runs(words, exponent=4, least=6):
    known, out = {}, []
    c = np.array([known.setdefault(w, len(known)) for w in words])
    for p in range(1, len(c) // exponent + 1):
        edge = np.diff(np.concatenate([[0], (c[:-p] == c[p:]).astype(int), [0]]))
        for i, j in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True):
            size = j - i + p
            if size >= max(least, exponent * p) and not any((c[i : i + size - q] == c[i + q : i + size]).all() for q in range(1, p)):
                out.append((i, size, p))
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_lyndon_lengths_and_runs():
    r = random.Random(1)
    for _ in range(600):
        c = [r.randrange(r.randrange(1, 5)) for _ in range(r.randrange(1, 25))]
        if r.random() < 0.6:
            p = r.randrange(1, 5)
            c = c[:5] + [c[i % min(p, len(c))] for i in range(r.randrange(4, 25))] + c[5:]
        used = sorted(set(c))
        c = [used.index(x) for x in c]
        assert periodic_runs.lyndon_lengths(c) == lyndon(c)
        for exponent, least in ((4, 6), (2, 2), (3, 1)):
            assert periodic_runs.runs_in(np.array(c), exponent, least) == all_runs(c, exponent, least)
    assert periodic_runs.lyndon_lengths([]) == []


def tailed(i, text):
    w, h = WORD.findall(text or ""), zlib.crc32(str(i).encode())
    if h % 10 == 0 and w:
        g = h // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = [x if k < a else w[a + (k - a) % p] for k, x in enumerate(w)]
    return w


@pytest.fixture(scope="module")
def texts():
    r = random.Random(9)
    out = [(None, "a a a a a a"), (1, None), (2, ""), (3, " \n"), (4, "one"), (5, "x " * 6), (6, "x " * 5), (7, "a b " * 4), (8, "a b " * 3 + "a"), (9, "A a " * 9), (5, "y y y y y y y")]
    for i in range(10, 150):
        w = [f"w{r.randrange(30)}" for _ in range(r.randrange(0, 120))]
        for _ in range(r.randrange(3)):
            at, p = r.randrange(len(w) + 1), r.randrange(1, 9)
            w[at:at] = [f"v{k % p}" for k in range(r.randrange(3 * p, 7 * p))]
        out.append((i, (" " if i % 3 else "\n\t ").join(w) + " " * (i % 2)))
    return out + [(500, "é ü é " * 50), (501, "long " * 9000), (502, " ".join(f"u{k % 700}" for k in range(6000))), (503, "x" * 30000 + " y" * 40)]


def test_runs_against_brute_force(spark, texts):
    docs = spark.createDataFrame([(i, t, 1, "r", 2) for i, t in texts], "doc_id long, text string, start int, runs string, period int")
    for edit in (False, True):
        given = docs.withColumn("text", periodic_runs.with_tails(F.col("text"), F.col("doc_id"))) if edit else docs
        got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs.find_runs(given).collect()), key=str)
        want = []
        for i, t in texts:
            w = tailed(i, t) if edit and i is not None else WORD.findall(t or "")
            runs = all_runs(w)
            gone = {k for s, n, p in runs for k in range(s + p, s + n)}
            want.append((i, len(w), runs, " ".join(x for k, x in enumerate(w) if k not in gone)))
        assert got == sorted(want, key=str)
        assert sum(len(x[2]) for x in want) > 60
    assert periodic_runs.find_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic_runs.find_runs(docs, exponent=1)


def test_other_exponents(spark, texts):
    docs = spark.createDataFrame(texts[:80], "doc_id long, text string")
    for exponent, least in ((2, 1), (3, 12)):
        got = periodic_runs.find_runs(docs, exponent=exponent, least=least).collect()
        assert sorted((str(r.doc_id), [tuple(x) for x in r.runs]) for r in got) == sorted((str(i), all_runs(WORD.findall(t or ""), exponent, least)) for i, t in texts[:80])


def test_run_query(spark):
    sf = "/root/testdata/sf0.001"
    given = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    checked = 0
    for r in registry.op13_periodic_runs(spark, sf).collect():
        w = tailed(r.doc_id, given[r.doc_id])
        if len(w) > 1500:
            continue
        runs = all_runs(w)
        best = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2])) if runs else (None, None, None)
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (len(runs), *best, best[1] * 1000 // best[2] if runs else None)
        gone = {k for s, n, p in runs for k in range(s + p, s + n)}
        assert r.runs_sha256 == sha("".join("{},{},{}\n".format(*x) for x in runs)) and r.collapsed_sha256 == sha(" ".join(x for k, x in enumerate(w) if k not in gone))
        checked += bool(runs)
    assert checked > 10
