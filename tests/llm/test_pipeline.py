"""The pipeline's stages on a small corpus with planted cases, and the registered queries on the smallest tables."""

import hashlib
import os
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import test_operators as plain
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from vidpipe.llm import registry
from vidpipe.scratch import shared_dir, written

SF = "/root/testdata/sf0.001"


def test_planted_cases(spark, tmp_path):
    r = random.Random(1)
    say = lambda n: ". ".join(" ".join(f"w{r.randrange(3000)}" for _ in range(8)) for _ in range(n))
    clean = {k: say(r.randrange(5, 15)) for k in range(200)}
    rows = dict(clean)
    junk = {300 + k: " ".join(f"w{r.randrange(3000)}###" for _ in range(60)) for k in range(60)}
    rows |= junk | {400: clean[3], 401: clean[4] + " tail"}
    passage = " ".join(f"p{k}" for k in range(60))
    rows |= {500: say(6) + " " + passage, 501: say(6) + " " + passage + " " + say(2)}
    item = " ".join(f"b{k}" for k in range(14))
    rows |= {600: say(4) + " " + item + " " + say(4), 700: None}
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows.items()], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i not in junk), 0) for i in [*clean, *junk] if i % 2], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    steps = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, str(tmp_path)), "stage")
        steps[name] = {x.doc_id: x for x in docs.collect()}
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == corpus_pipeline.COLUMNS
            assert all(x.n_chars == len(x.text or "") for x in steps[name].values())
    assert not set(junk) & set(steps["quality classifier"]) and len(set(clean) - set(steps["quality classifier"])) <= 2
    assert not {400, 401} & set(steps["minhash near-dedup"]) and {3, 4} <= set(steps["minhash near-dedup"])
    texts = {i: x.text for i, x in steps["substring dedup"].items()}
    assert "p30" in texts[500] and "p30" not in texts[501]
    assert 600 not in steps["benchmark decontamination"] and set(steps["substring dedup"]) - set(steps["benchmark decontamination"]) == {600}
    last = steps["byte-level bpe"]
    assert set(last) == set(steps["benchmark decontamination"]) and all(x.n_tokens > 0 for i, x in last.items() if i != 700)


def _write(spark, path, rows, labels=(), items=()):
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(list(items), "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")


def test_pipeline_against_plain_versions(spark, tmp_path):
    r = random.Random(3)
    say = lambda n: " ".join(f"w{r.randrange(900)}" for _ in range(n))
    rows = [(k, say(r.randrange(60, 120))) for k in range(60)]
    passage = say(70)
    for k in range(60):
        w = rows[r.randrange(60)][1].split()
        w[r.randrange(len(w))] = "other"
        rows += [(100 + k, " ".join(w)), (200 + k, say(20) + " " + (passage if k % 3 else say(9)) + " " + say(20)), (300 + k, f"junk{k} ### " * 30)]
    rows += [(500, None), (501, ""), (502, " \n"), (None, rows[0][1]), (0, rows[0][1]), (503, passage)]
    item = say(30)
    rows += [(600, say(30) + " " + " ".join(item.split()[4:16]).upper() + ". " + say(30))]
    _write(spark, tmp_path, rows, [(i, int(i < 300), 0) for i, _ in rows if i is not None and i % 2], [(7, item)])
    steps = []
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, str(tmp_path)), "stage")
        steps.append([tuple(x) for x in docs.collect()])
    good, apart, cut, clean, last = steps
    assert Counter(good) <= Counter((i, t, "en", "s", len(t or "")) for i, t in rows)

    named = {i: t for i, t, *_ in good if i is not None}
    least = plain._components(list(named.items()), 5, 80)
    assert Counter(apart) == Counter(x for x in good if x[0] is None or least[x[0]][1] == x[0])

    n, first = corpus_pipeline.PASSAGE, {}
    for i, t, *_ in apart:
        w = plain.split(t)
        for j in range(len(w) - n + 1 if i is not None else 0):
            first[tuple(w[j : j + n])] = min(first.get(tuple(w[j : j + n]), i), i)
    expected = []
    for i, t, *_ in apart:
        w = plain.split(t)
        gone = [False] * len(w)
        for j in range(len(w) - n + 1 if i is not None else 0):
            if first[tuple(w[j : j + n])] < i:
                gone[j : j + n] = [True] * n
        left = [x for x, g in zip(w, gone, strict=True) if not g]
        if left or not any(gone):
            expected.append((str(i), tuple(left)))
    assert Counter(expected) == Counter((str(i), tuple(plain.split(t))) for i, t, *_ in cut)
    assert all(x[4] == len(x[1] or "") for x in cut)

    bad = {i for i, _, hit, _ in plain._hits([(x[0], x[1]) for x in cut], [(7, item)]) if hit and i is not None}
    assert bad == {600} and Counter(clean) == Counter(x for x in cut if x[0] not in bad)

    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=plain.byte_bpe.read_ranks(plain.RANKS), special_tokens={})
    ids = [np.array(enc.encode_ordinary(t or ""), "<u4").tobytes() for _, t, *_ in clean]
    digest = lambda x: hashlib.sha256(x).hexdigest()
    assert Counter((i, len(x) // 4, digest(x), digest((t or "").encode()), x) for (i, t, *_), x in zip(clean, ids, strict=True)) == Counter((*x[:4], bytes(x[4])) for x in last)
    assert Counter((*tuple(x)[:4], bytes(x[4])) for x in corpus_pipeline.run(spark, str(tmp_path)).collect()) == Counter((*x[:4], bytes(x[4])) for x in last)


def test_pipeline_of_nothing(spark, tmp_path):
    _write(spark, tmp_path, [])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_pipeline_leaves_no_tables_behind(spark, tmp_path):
    _write(spark, tmp_path, [(1, "a b c"), (2, None)])
    folder = os.path.join(shared_dir(spark).removeprefix("file:").replace("//", "/"), "vidpipe")
    os.makedirs(folder, exist_ok=True)
    before = set(os.listdir(folder))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 2
    assert len(set(os.listdir(folder)) - before) == 1  # what the last stage reads


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_registered(spark, name):
    got = registry.QUERIES[name](spark, SF)
    table = "pages" if "op10" in name else "conversations" if "op3" in name else "embeddings" if "op12" in name else "documents"
    rows = spark.read.parquet(f"{SF}/{table}.parquet")
    assert got.count() == (rows.agg(F.count_distinct("conv_id")).first()[0] + 1 if "op3" in name else rows.count())


@pytest.mark.parametrize("name", ["op1_cws_fingerprint", "op2_decontamination", "op10_url_filter"])
def test_native(spark, name):
    plan = registry.QUERIES[name](spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan and "Pandas" not in plan
