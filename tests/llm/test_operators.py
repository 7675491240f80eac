"""Each operator against a brute-force version on small tables with the awkward cases: nulls, empty and very long
texts, ties, repeated rows, no rows, and further columns with clashing names."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from vidpipe.llm import byte_bpe, chat_format, decontaminate, fingerprint, language_id, near_dedup, quality, recompression, substring_dedup, url_filter
from vidpipe.llm.common import hash_bounds, hashed, runs_of, words
from vidpipe.llm.common import id_hash as hash_of

SCHEMA = "doc_id long, text string, lang string, row long, seg string, w string, h int, component string, bucket int"
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def docs(spark, texts, langs=None):
    """``texts``: id and text pairs; further columns have names that the operators use themselves."""
    return spark.createDataFrame([(i, t, (langs or {}).get(i, "en"), 1, "s", "w", 2, "c", 3) for i, t in texts], SCHEMA)


def sentence(r, n, vocabulary=400):
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    r = random.Random(5)
    base = [sentence(r, r.randrange(1, 200)) for _ in range(40)]
    out = [(0, None), (1, ""), (2, " \n\t"), (3, "one"), (4, "one"), (5, "one two three"), (6, "ONE two Three")]
    for i, b in enumerate(base):
        w = b.split()
        out.append((100 + 3 * i, b))
        if len(w) > 5:
            near = list(w)
            near[r.randrange(len(w))] = "changed"
            out.append((101 + 3 * i, " ".join(near)))
            out.append((102 + 3 * i, " ".join(w[len(w) // 3 :] + sentence(r, 30).split())))
    passage = sentence(r, 70)
    out += [(500 + k, sentence(r, 20) + "\n" + passage + " " + sentence(r, 20)) for k in range(6)]
    out += [(600, "again " * 3000), (601, "again " * 2500), (602, "x" * 20000), (603, passage), (604, "é ü ß ñ " * 20), (605, base[0]), (606, base[0].upper())]
    return out


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# helpers ------------------------------------------------------------------------------------------------------------


def test_words_are_those_of_the_pattern(corpus):
    texts = [t or "" for _, t in corpus]
    hashes, first = words(pa.array(texts), lower=False)
    own = [split(t) for t in texts]
    assert np.diff(first).tolist() == [len(o) for o in own]
    flat = [w for o in own for w in o]
    assert len(dict(zip(flat, hashes.tolist(), strict=True))) == len(set(hashes.tolist())) == len(set(flat))


def test_equal_windows_hold_equal_symbols():
    r = np.random.default_rng(1)
    for _ in range(30):
        core = r.integers(0, 6, 60).astype(np.uint64)
        a, b = (np.concatenate([r.integers(0, 6, 20), core, r.integers(0, 6, 20)]).astype(np.uint64) for _ in range(2))
        inner = []
        for x in (a, b):
            names, lo, hi = recompression.parse(x, np.array([0, len(x)]), 3)
            inner.append([(int(n), int(p)) for n, p, q in zip(names, lo, hi, strict=True) if p >= 20 and q <= 80])
        assert inner[0] == inner[1] and inner[0]


# 1 ------------------------------------------------------------------------------------------------------------------


def test_fingerprints(spark, corpus):
    got = fingerprint.compare_with_edits(docs(spark, corpus)).collect()
    rows = sorted((i, t or "") for i, t in corpus)
    following = {rows[k][0]: rows[(k + 1) % len(rows)][1] for k in range(len(rows))}
    own, edited, by_text, off = dict(rows), {}, {}, []
    assert len(got) == len(rows)

    def weights(text):
        out = Counter()
        for p in re.split(r"\s+", text.lower()):
            if 0 < len(p) <= fingerprint.LONGEST:
                out[p] += len(p)
            else:
                out.update(p[j : j + fingerprint.GRAM] for j in range(len(p) - fingerprint.GRAM + 1))
        return out

    for r in got:
        t = own[r.doc_id]
        k = len(t) // 4
        edited[r.doc_id] = t[: len(t) - k] + following[r.doc_id][:k]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited[r.doc_id].encode()).hexdigest())
        assert by_text.setdefault(t, r.fingerprint) == r.fingerprint
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        a, b = weights(t), weights(edited[r.doc_id])
        if a or b:
            off.append(r.near_edited - sum((a & b).values()) / sum((a | b).values()))
    # the noise of 64 samples, and no bias
    assert len(off) > 100 and abs(np.mean(off)) < 0.02 and np.sqrt(np.mean(np.square(off))) < 1 / math.sqrt(64)


def test_collision_rate_is_generalised_jaccard(spark):
    r = random.Random(3)
    pairs, truth = [], []
    for k in range(60):
        a = Counter({f"t{r.randrange(300)}e": r.randrange(1, 5) for _ in range(80)})
        b = Counter({t: r.randrange(1, 5) if r.random() < 0.3 else n for t, n in a.items() if r.random() < 0.8})
        weigh = lambda c: {t: n * len(t) for t, n in c.items()}
        wa, wb = weigh(a), weigh(b)
        truth.append(sum(min(wa[t], wb.get(t, 0)) for t in wa) / sum(max(wa.get(t, 0), wb.get(t, 0)) for t in wa | wb))
        pairs.append((k, " ".join(a.elements()), " ".join(b.elements())))
    found = fingerprint.fingerprints(spark.createDataFrame(pairs, "k long, a string, b string"), ["k"], ["a", "b"])
    got = {x.k: x.s for x in found.select("k", fingerprint.likeness(F.col("a"), F.col("b")).alias("s")).collect()}
    assert abs(np.mean([got[k] - truth[k] for k in range(60)])) < 0.03


def _likeness(spark, pairs):
    rows = spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(pairs)], "k long, a string, b string")
    found = fingerprint.fingerprints(rows, ["k"], ["a", "b"]).select("k", fingerprint.likeness(F.col("a"), F.col("b")).alias("s"))
    got = {x.k: x.s for x in found.collect()}
    return [got[k] for k in range(len(pairs))]


def test_collision_rate_with_skewed_weights_and_short_texts(spark):
    heavy, short, truth = [], [], []
    for k in range(40):
        other = lambda side: [f"{side}{k}n{j}e" for j in range(30)]  # noqa: B023, E731
        a, b = other("p"), other("q")
        heavy.append((" ".join([f"h{k}e"] * 100 + a), " ".join([f"h{k}e"] * 100 + b)))
        same = 100 * len(f"h{k}e")
        truth.append(same / (same + sum(map(len, a + b))))
        short.append((f"s{k}e t{k}e u{k}e", f"s{k}e t{k}e v{k}e"))
    got = np.array(_likeness(spark, heavy))
    assert abs(np.mean(got - truth)) < 0.03 and np.abs(got - truth).max() < 0.3
    got = np.array(_likeness(spark, short))
    assert abs(got.mean() - 0.5) < 0.05 and np.abs(got - 0.5).max() < 0.3


def test_edits_show_in_every_script(spark):
    r = random.Random(11)
    scripts = {
        "consonants": (" ", lambda: "".join(r.choices("bdfgklmnprst", k=5))),
        "numbers": (" ", lambda: str(r.randrange(10**5))),
        "cyrillic": (" ", lambda: "".join(r.choices("абвгдежзик", k=6))),
        "chinese": ("", lambda: "".join(chr(r.randrange(0x4E00, 0x5E00)) for _ in range(2))),
        "rare chinese": ("", lambda: "".join(chr(r.randrange(0x20000, 0x21000)) for _ in range(2))),
        "thai": ("", lambda: "".join(chr(r.randrange(0x0E01, 0x0E2F)) for _ in range(4))),
        "one long word": ("", lambda: "".join(r.choices("abcdefghijklmnopqrst", k=6))),
    }
    pairs = []
    for space, word in scripts.values():
        own = [word() for _ in range(200)]
        pairs.append((space.join(own), space.join([*own[:160], *(word() for _ in range(40))])))
    pairs += [("again " * 400, "again " * 300), ("x" * 2000, "x" * 1500), ("中文", "中文"), ("中", "文")]
    got = dict(zip([*scripts, "repeated word", "repeated character", "equal", "apart"], _likeness(spark, pairs), strict=True))
    assert all(0.42 < got[k] < 0.95 for k in got if k not in ("equal", "apart")), got
    assert got["equal"] == 1 and got["apart"] == 0


def test_next_rows_whatever_the_ids(spark):
    for ids in ([*range(3000), 10**12], [7] * 3000, [None] * 1500 + [5] * 1500, [*range(-(10**15), -(10**15) + 1500), *range(1500)], [1]):
        rows = [(i, f"t{k % 1000:05d}") for k, i in enumerate(ids)]
        got = fingerprint.with_next(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        assert Counter({(x.doc_id, x.text): 0 for x in got}).keys() == set(rows)
        counts = Counter()
        for x in got:
            counts[x.doc_id, x.text] += x.times
        assert counts == Counter(rows)
        on = {(x.h1, x.h2): x for x in got if x.v == 0}
        assert len(on) == len(set(rows)) and all((x.nh1, x.nh2) == (x.h1, x.h2) for x in got if x.v == 1)
        assert all(x.head == on[x.nh1, x.nh2].text[: x.n_chars // 4] for x in got)
        at, walk = min(on, key=lambda k: (on[k].doc_id is not None, on[k].doc_id or 0, k)), []
        first = at
        while not walk or at != first:
            walk.append(on[at].doc_id)
            at = (on[at].nh1, on[at].nh2)
        assert len(walk) == len(on) and walk == sorted(walk, key=lambda i: (i is not None, i or 0))


def test_repeated_rows_are_given_back(spark):
    rows = [(1, "one two three four")] * 5000 + [(2, "two"), (2, "two"), (None, None)]
    got = fingerprint.compare_with_edits(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter(x.doc_id for x in got) == Counter(i for i, _ in rows)
    assert Counter(x.near_next for x in got if x.doc_id == 1)[1.0] == 4999 and len({x.fingerprint for x in got if x.doc_id == 1}) == 1


# 2 ------------------------------------------------------------------------------------------------------------------


def _hits(corpus, items, n=10):
    own = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(t))
    windows = {}
    for i, t in items:
        w = own(t)
        for j in range(max(1, len(w) - n + 1)) if w and i is not None else []:
            windows.setdefault(tuple(w[j : j + n]), set()).add(str(i))
    out = []
    for i, t in corpus:
        w, hit, found = own(t), set(), set()
        for size in {len(k) for k in windows}:
            for j in range(len(w) - size + 1):
                if (k := tuple(w[j : j + size])) in windows:
                    hit |= set(range(j, j + size))
                    found |= windows[k]
        out.append((i, len(w), len(hit), sorted(found)))
    return sorted(out, key=str)


@pytest.mark.parametrize("bits", [1 << 26, 64])
def test_decontamination(spark, corpus, bits, monkeypatch):
    monkeypatch.setattr(decontaminate, "MOST_BITS", bits)  # a bitmap that is full lets every position through to the join
    texts = dict(corpus)
    items = [(7, texts[500].upper()), (10, "W1, w2"), (11, None), (12, "..."), (9, " ".join(split(texts[103])[:12])), (None, texts[100]), (13, "one")]
    mine = [*corpus, (3, "one"), (None, texts[100]), (700, texts[500].replace(" ", ", "))]
    got = decontaminate.find_hits(docs(spark, mine), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, list(r.items)) for r in got), key=str) == _hits(mine, items)
    assert all(r.contaminated == (r.n_hit > 0) and r.n_items == len(r.items) for r in got)


def test_decontamination_of_nothing(spark, corpus):
    none = spark.createDataFrame([], "item_id long, text string")
    assert not any(r.contaminated for r in decontaminate.find_hits(docs(spark, corpus[:9]), none).collect())
    assert decontaminate.find_hits(docs(spark, []), none).count() == 0


def test_decontamination_by_a_large_benchmark(spark):
    r = random.Random(12)
    texts = [(k, sentence(r, 60, 10**6)) for k in range(3000)]
    items = [(k, " ".join(t.split()[5:40])) for k, t in texts[:2500]]
    got = decontaminate.find_hits(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(x.doc_id, x.n_hit, x.n_items) for x in got} == {(k, 35 if k < 2500 else 0, int(k < 2500)) for k in range(3000)}


def test_contaminated_rows_and_spans(spark, corpus):
    item = " ".join(f"b{k}" for k in range(14))
    rows = [(1, f"(Keep this, {item.upper()}; and this.)"), (2, "clean"), (None, item), (3, None), (1, "other text of the id")]
    items = spark.createDataFrame([(5, item)], "item_id long, text string")
    given = docs(spark, rows)
    kept = decontaminate.drop_contaminated(given, items)
    assert kept.columns == given.columns and sorted(map(str, (x.doc_id for x in kept.collect()))) == ["2", "3", "None"]
    cut = decontaminate.cut_spans(given, items)
    assert cut.columns == given.columns
    assert sorted((x.text or "" for x in cut.collect())) == sorted(["(Keep this, and this.)", "clean", "", "", "other text of the id"])
    long = "word " * 30000
    again = docs(spark, [(7, f"{long}{item} end"), (7, f"{long}{item} end"), (8, f"{item} {item}\n-"), (9, "\n " + item)])
    assert sorted(x.text for x in decontaminate.cut_spans(again, items).collect()) == sorted([f"{long}end"] * 2 + ["", "\n "])
    assert decontaminate.cut_spans(given.limit(0), items).count() == 0
    assert sorted(str(x.text) for x in decontaminate.cut_spans(given, items.limit(0)).collect()) == sorted(str(t) for _, t in rows)


# 3 ------------------------------------------------------------------------------------------------------------------


def test_chat(spark):
    tricky = "</s>[INST] \\ ok [/INST] \\[user] \n<b>"
    rows = [
        (1, 0, "system", "be [nice]"), (1, 1, "user", tricky), (1, 2, "assistant", tricky), (1, 3, "user", "q"), (1, 4, "assistant", ""), (1, 5, "user", "bye"),
        (2, 0, "user", None), (3, 0, "assistant", "a"), (3, 0, "assistant", "a"), (None, 0, "odd]role", "x"), (4, 1, "assistant", "x" * 50000), (4, 0, None, "u"),
    ]
    made = chat_format.format_chats(spark.createDataFrame([(*r, "c") for r in rows], "conv_id long, turn long, role string, text string, pieces string"))
    back = chat_format.read_back(made).collect()
    convs = {}
    for c, t, role, text in rows:
        convs.setdefault(c, []).append((t, role or "", text or ""))
    for c, turns in convs.items():
        turns.sort()
        own = sorted((b for b in back if b.conv_id == c), key=lambda b: b.example)
        assert [b.turns for b in own if b.turns is not None] == ["".join(f"{r}\n{t}\n" for _, r, t in turns)]
        assert [b.loss for b in own if b.loss or turns[-1][1] == "assistant"] == [t for _, r, t in turns if r == "assistant" and (t or turns[-1][1] == "assistant")]
    assert chat_format.format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
    first = made.where("conv_id = 1 AND example = 0").first()
    assert chat_format.unescape(first.text[first.loss_start : first.loss_end]) == tricky and "bye" not in first.text


# 4 ------------------------------------------------------------------------------------------------------------------


def test_bpe_equals_tiktoken(spark, corpus):
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})
    r = random.Random(2)
    odd = [(1000 + k, "".join(r.choice("ab é\n\t\x1c\u0085 'sS1²½一二😀̀ß<|endoftext|>") for _ in range(r.randrange(80)))) for k in range(300)]
    mine = [*corpus, *odd, (3, "one"), (None, "id"), (2000, "ab" * 30000), (2001, "ererstanthe" * 500)]
    got = byte_bpe.encode_decode(docs(spark, mine), RANKS, public_tokenizers.PATTERN).collect()
    expected = sorted(((i, np.array(enc.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for i, t in mine), key=str)
    assert sorted(((x.doc_id, bytes(x.ids), bytes(x.decoded)) for x in got), key=str) == expected
    assert all(x.n_tokens == len(x.ids) // 4 for x in got)


def test_both_queues_agree():
    ranks = byte_bpe.read_ranks(RANKS)
    pairs, longest = byte_bpe._Pairs(ranks), max(map(len, ranks))
    r = random.Random(4)
    pieces = ["".join(r.choice("aehinorst é") for _ in range(r.randrange(1, 40))).encode() for _ in range(2000)]
    plain = [np.array(byte_bpe.merge(p, {**ranks, p: ranks.get(p)} if p in ranks else ranks, longest), "<u4").tobytes() for p in pieces if p not in ranks]
    assert byte_bpe.merge_many([p for p in pieces if p not in ranks], pairs) == plain


def test_rank_queue_order():
    q, r = byte_bpe.RankQueue(), random.Random(1)
    items = [(r.randrange(60000), k) for k in range(500)] + [(7, 3), (7, 1), (7, 2)]
    for rank, at in items:
        q.push(rank, at)
    assert [q.pop() for _ in items] == sorted(items) and not q.root


# 6 and 9 --------------------------------------------------------------------------------------------------------------


def _held(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


def test_quality(spark):
    r = random.Random(6)
    good = [(k, ". ".join(sentence(r, 9) for _ in range(r.randrange(1, 8)))) for k in range(400)]
    bad = [(1000 + k, " ".join(f"w{r.randrange(400)}{r.choice(['###', '$$$'])}" for _ in range(30))) for k in range(80)]
    bad += [(2000 + k, f"w{r.randrange(400)} " * 60) for k in range(60)]
    mine = [*good, *bad, (5000, None), (5001, ""), (None, "w1"), (5002, "w1 " * 50000), (0, "w1 w2")]
    labels = spark.createDataFrame([(i, int(i < 1000), 0) for i, _ in [*good, *bad]] + [(None, 1, 0), (9, None, 0), (10, 7, 0)], "doc_id long, quality int, toxic int")
    got = quality.classify(docs(spark, mine), labels).collect()
    assert len(got) == len(mine)
    assert all(0 <= x.score <= 1 and x.predicted == int(x.score >= 0.5) and x.held_out == (x.doc_id is not None and _held(x.doc_id)) for x in got)
    judged = [x for x in got if x.held_out and x.doc_id is not None and 0 < x.doc_id < 5000]
    assert np.mean([x.predicted == int(x.doc_id < 1000) for x in judged]) > 0.95
    kept = {x.doc_id for x in quality.keep_good(docs(spark, [*good, *bad]), labels).collect()}
    assert len(kept & {i for i, _ in good}) > 390 and len(kept & {i for i, _ in bad}) < 10


def test_quality_features_step_and_score():
    texts = ["Ab é ab", "", "ñandú  x", "日本語 ab ab"]
    data, offsets = np.frombuffer("".join(texts).encode(), np.uint8), np.cumsum([0, *(len(t.encode()) for t in texts)])
    got = [Counter() for _ in texts]
    for row, feature in quality.features(data, offsets):
        for i, f in zip(row.tolist(), feature.tolist(), strict=True):
            got[i][f] += 1
    for i, t in enumerate(texts):
        own = t.split()
        chars = " " + t + " "
        grams = [chars[j : j + n] for n in quality.LENGTHS for j in range(len(chars) - n + 1) if " " not in chars[j + 1 : j + n - 1]]
        assert sum(got[i].values()) == len(own) + max(0, len(own) - 1) + len(grams)  # words, pairs of words, n-grams over characters
    assert got[3].most_common(1)[0][1] >= 2  # "ab" twice
    r = np.random.default_rng(5)
    vectors, softmax, bias = (r.normal(size=s) for s in ((50, quality.DIMENSIONS), (2, quality.DIMENSIONS), (2,)))
    feature, share = np.array([3, 7, 9]), np.array([0.5, 0.25, 0.25])

    def loss(v, s, b):
        logits = s @ (share @ v[feature]) + b
        return np.log(np.exp(logits).sum()) - logits[1]

    after = [x.copy() for x in (vectors, softmax, bias)]
    quality.descend(*after, feature, share, 1, 1.0)
    for which, factor in ((0, 50), (1, 1), (2, 0.1)):
        before = (vectors, softmax, bias)
        for at in [(3, 0), (9, 4)] if which == 0 else [(0, 1), (1, 2)] if which == 1 else [(0,), (1,)]:
            bumped = [x.copy() for x in before]
            bumped[which][at] += 1e-6
            slope = (loss(*bumped) - loss(*before)) / 1e-6
            assert abs((before[which][at] - after[which][at]) - factor * slope) < 1e-3 * max(1, abs(factor * slope))
    model = quality.Model(r.normal(size=quality.BUCKETS), 0.3, -0.1)
    for i, s in enumerate(model.scores(data, offsets)):
        total = 0.3 + sum(model.weights[f] * n for f, n in got[i].items())
        assert abs(s - 1 / (1 + math.exp(-(total / (1 + sum(got[i].values())) - 0.1)))) < 1e-9


def test_quality_features_are_those_of_a_plain_version():
    text = "Ab  cé ab ab\tcé Ab"
    data, offsets = np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())])
    words_, pairs, *grams = [f.tolist() for _, f in quality.features(data, offsets)]
    spelled = text.split()
    ids = {w: int(hashed(np.frombuffer(w.encode(), np.uint8), np.array([0]), np.array([len(w.encode())]))[0]) for w in spelled}
    assert words_ == [ids[w] % quality.BUCKETS for w in spelled]
    whole = lambda x: int(quality.mix(np.array([x], np.uint64))[0]) % quality.BUCKETS
    assert pairs == [whole(ids[a] ^ ids[b]) for a, b in zip(spelled, spelled[1:])]
    assert pairs[2] == whole(0) and pairs[1] == pairs[3]  # a word beside itself, and two words in either order
    line, cap = " " + text.replace("\t", " ") + " ", (1 << 32) - 1
    for n, got in zip(quality.LENGTHS, grams, strict=True):
        want = []
        for i in range(len(line) - n + 1):
            if " " not in line[i + 1 : i + n - 1]:
                h = n
                for c in line[i : i + n]:
                    h = ((h ^ int.from_bytes(c.encode(), "little")) * 2654435761) & cap
                    h ^= h >> 15
                want.append(h % quality.BUCKETS)
        assert got == want


def test_language_training_is_bounded_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(language_id, "TRAIN_BYTES", 2000)
    seen = []
    monkeypatch.setattr(language_id, "count_grams", lambda rows, real=language_id.count_grams: seen.append(rows.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("n")).collect()) or real(rows))
    rows = spark.range(400).selectExpr("id doc_id", "CASE WHEN id = 7 THEN 'c' WHEN id % 2 = 0 THEN 'a' ELSE 'b' END lang", "CASE WHEN id = 7 THEN repeat('long ', 900) WHEN id % 10 = 0 THEN repeat('x', 5000) ELSE concat('text of ', id, repeat(' more', 10)) END text")
    model = language_id.train(rows)
    sizes = {r.lang: r.n for r in seen[0]}
    assert set(model.langs) == {"a", "b", "c"} and sizes["c"] == 4500  # its only text
    assert 500 < sizes["a"] <= 666 and 500 < sizes["b"] <= 666


def test_training_rows_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(quality, "TRAIN_ROWS", 100)
    seen = []
    monkeypatch.setattr(quality, "fit", lambda texts, y: seen.append(len(texts)) or quality.Model(np.zeros(quality.BUCKETS), 0.0, 0.0))
    rows = spark.range(6000).selectExpr("CASE WHEN id % 2 = 0 THEN 7 ELSE id END doc_id", "concat('t', id) text")
    quality.train(rows, spark.range(6000).selectExpr("id doc_id", "int(id % 2) quality"))
    assert 90 <= seen[0] <= 100


def test_hash_bounds_of_large_and_small_groups(spark):
    rows = spark.range(200000).selectExpr("CASE WHEN id < 150000 THEN 'hot' WHEN id < 199990 THEN 'mid' ELSE 'few' END grp", "id").select("grp", hash_of(F.col("id")).alias("h"))
    rows = rows.union(spark.createDataFrame([(None, 1)], "grp string, h long")).union(spark.sql("SELECT 'one' grp, 5L h FROM range(5000)"))
    bounds = {r.grp: r.bound for r in hash_bounds(rows, 20).collect()}
    got = {r.grp: r.n for r in rows.join(hash_bounds(rows, 20), "grp").where("h < bound").groupBy("grp").agg(F.count_distinct("h").alias("n")).collect()}
    assert set(bounds) == {"hot", "mid", "few", "one"} and got["few"] == 10 and got["one"] == 1
    assert 18 <= got["hot"] <= 20 and 18 <= got["mid"] <= 20
    assert hash_bounds(rows.limit(0), 20).count() == 0


def test_carried_columns_may_be_called_anything(spark):
    names = ["doc_id", "text", "score", "_text", "lang_pred", "h", "bound"]
    rows = spark.createDataFrame([(1, "w1 w2", 3.5, "a", "b", 1, 2), (None, None, None, None, None, None, None)], "doc_id long, text string, score double, _text string, lang_pred string, h int, bound int")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    kept = quality.keep_good(rows, none)
    assert kept.columns == names and sorted(map(str, kept.collect())) == sorted(map(str, rows.collect()))
    got = language_id.predict(rows, language_id.Model([], np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)), carry=("text", "score", "h"))
    assert got.columns == ["doc_id", "lang_pred", "score", "text", "given_score", "h"] and got.count() == 2


def test_quality_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {x.score for x in quality.classify(docs(spark, [(1, "a b"), (2, None)]), none).collect()} == {0.5}
    assert quality.classify(docs(spark, []), none).count() == 0


def test_language(spark):
    r = random.Random(7)
    parts = {"aa": ["ba", "lo", "mi"], "bb": ["sch", "ung", "ei"], "cc": ["é", "que", "ña"]}
    mine, langs = [], {}
    for k in range(300):
        lang = r.choice(list(parts))
        langs[k] = lang
        mine.append((k, " ".join("".join(r.choices(parts[lang], k=3)) for _ in range(r.randrange(3, 60)))))
    mine += [(900, None), (901, ""), (902, "12 34 !?"), (None, "balomi"), (903, "schung " * 30000), (0, mine[0][1])]
    langs |= {900: None, 901: "aa", 902: "bb"}
    got = language_id.identify(docs(spark, mine, langs)).collect()
    assert len(got) == len(mine)
    assert all(x.lang_pred == "und" and x.score == 0 for x in got if x.doc_id in (900, 901, 902))
    assert all(0 <= x.score <= 1 and x.held_out == (x.doc_id is not None and _held(x.doc_id)) for x in got)
    assert np.mean([x.lang_pred == langs[x.doc_id] for x in got if x.held_out and x.doc_id < 300]) > 0.97
    assert [x.lang_pred for x in got if x.doc_id == 903] == ["bb"]


def test_code_lengths_are_those_of_ppm():
    texts = ["abracadabra", "abrabra", "cad"]
    grams = Counter()
    for t in texts:
        padded = b"\0" * 3 + t.encode()
        grams.update((b"", padded[i - 3 : i + 1]) for i in range(3, len(padded)))
    packed = [sum(g[3 - k] << 8 * k for k in range(4)) for _, g in grams]
    model = language_id.Model(["x"], np.zeros(len(packed), np.int64), np.array(packed), np.array(list(grams.values()), float))
    counts = Counter()
    for (_, g), n in grams.items():
        for k in range(4):
            counts[g[3 - k : 3], g[3]] += n

    def cost(context, symbol):
        own = {s: n for (c, s), n in counts.items() if c == context}
        shorter = cost(context[1:], symbol) if context else 8.0
        if not own:
            return shorter
        total = sum(own.values()) + len(own)
        return math.log2(total / own[symbol]) if symbol in own else math.log2(total / len(own)) + shorter

    for t in ("abracadabra", "zab", "cabbr"):
        padded = b"\0" * 3 + t.encode()
        expected = sum(cost(padded[i - 3 : i], padded[i]) for i in range(3, len(padded)))
        got = model.bits(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t)]))[0, 0]
        assert abs(got - expected) < 1e-3


def test_many_languages_keep_every_context(monkeypatch):
    r = np.random.default_rng(4)
    gram = np.unique(r.integers(97, 103, (900, 4)) @ (1 << 8 * np.arange(4)))
    gram, lang = np.tile(gram, 3), np.repeat(np.arange(3), len(gram))
    some = r.random(len(gram)) < 0.5
    given = ["x", "y", "z"], lang[some], gram[some], r.integers(1, 9, some.sum()).astype(float)
    texts = ["".join(map(chr, r.integers(96, 105, n))) for n in (1, 2, 0, 3, 500, 40)] + ["", "ABCé"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *(len(x.encode()) for x in texts)])
    whole = language_id.Model(*given).bits(data, offsets)
    monkeypatch.setattr(language_id, "CELLS", 100)
    assert np.abs(language_id.Model(*given).bits(data, offsets) - whole).max() < 1e-2


def test_language_of_few_rows_stays(spark, monkeypatch):
    monkeypatch.setattr(language_id, "GRAMS", 12, raising=False)  # the former limit over all languages
    rows = spark.createDataFrame([(k, "aa", "the cat sat on the mat") for k in range(50)] + [(99, "zz", "quux vyv")], "doc_id long, lang string, text string")
    assert language_id.train(rows).langs == ["aa", "zz"]


def test_language_without_training(spark):
    got = language_id.identify(docs(spark, [(1, "abc"), (2, None)], {1: None, 2: None})).collect()
    assert {(x.lang_pred, x.score) for x in got} == {("und", 0.0)}
    assert language_id.identify(docs(spark, [])).count() == 0


# 7 and 8 ----------------------------------------------------------------------------------------------------------------


def _components(rows, width, percent):
    sets = {}
    for i, t in rows:
        w = split(lowered(t))
        sets[i] = {tuple(w[j : j + width]) for j in range(max(1, len(w) - width + 1))} if w else set()
    to = {i: i for i in sets}

    def find(x):
        while to[x] != x:
            x = to[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                to[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize(("width", "long"), [(4, 64), (5, 64), (4, 0), (4, 10**6)])
def test_near_duplicates(spark, corpus, width, long, monkeypatch):
    monkeypatch.setattr(near_dedup, "LONG", long)  # 0: all links but those of centres take the exact way; else none does
    r = random.Random(9)
    base = sentence(r, 120).split()
    group = []
    for k in range(60):  # a group whose members are about as alike as the threshold asks
        w = list(base)
        for _ in range(r.randrange(0, 6)):
            w[r.randrange(len(w))] = f"new{r.randrange(10**6)}"
        group.append((2000 + k, " ".join(w)))
    mine = [*corpus, *group]
    got = near_dedup.near_duplicates(docs(spark, mine), width=width).collect()
    expected = _components(mine, width, 80)
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in got} == expected
    assert all(x.kept == (x.doc_id == x.component_id) for x in got) and len(got) == len(mine)


@pytest.mark.parametrize("long", [64, 0])
def test_recall_against_all_pairs(spark, long, monkeypatch):
    monkeypatch.setattr(near_dedup, "LONG", long)
    r = random.Random(21)
    rows = []
    for g in range(150):  # small groups around the threshold, whose links few centres show
        base = [f"g{g}w{r.randrange(90)}" for _ in range(r.randrange(20, 90))]
        for k in range(4):
            w = list(base)
            for _ in range(r.randrange(0, 3)):
                w[r.randrange(len(w))] = f"n{r.randrange(10**6)}"
            rows.append((10 * g + k, " ".join(w)))
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=4).collect()}
    assert got == _components(rows, 4, 80)


def _set_rows(spark, sets):
    rows = [(i, i, len(x), np.sort(np.array(list(x), np.uint64)).tobytes()) for i, x in enumerate(sets)]
    return spark.createDataFrame(rows, "rep long, root long, n long, shingles binary")


@pytest.mark.parametrize("percent", [80, 60])
def test_exact_way_against_all_pairs(spark, percent):
    r = random.Random(31)
    passages = [r.sample(range(10**9), 120) for _ in range(3)]
    sets = []
    for _ in range(240):  # mostly one of three passages, cut and filled up to sizes that differ
        own = set(r.choice(passages)[: r.randrange(1, 121)])
        sets.append(own | {r.randrange(10**9) for _ in range(r.randrange(0, 1 + len(own) // 2))})
    rows = _set_rows(spark, sets)
    found = near_dedup._confirmed(near_dedup._overlapping(rows, percent), rows.drop("root"), percent, ("root_a", "root_b")).collect()
    expected = {(a, b) for a, x in enumerate(sets) for b, y in enumerate(sets[:a]) if 100 * len(x & y) >= percent * len(x | y)}
    assert {(x.a, x.b) for x in found} == expected and len(found) == len(expected) > 50
    assert all((x.root_a, x.root_b) == (x.a, x.b) for x in found)


def test_shared_passages_make_no_pairs(spark):
    passage = set(range(81))  # of texts of 95 shingles, all as large: too little to be alike, yet more than four fifths
    sets = [passage | {1000 * (i + 1) + k for k in range(14)} for i in range(300)]
    assert near_dedup._overlapping(_set_rows(spark, sets), 80).count() == 0


def test_near_duplicates_of_odd_rows(spark):
    mine = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (5, "a b c d e f"), (6, None)]
    got = sorted(((x.doc_id, x.component_id, x.kept) for x in near_dedup.near_duplicates(docs(spark, mine)).collect()), key=str)
    assert got == sorted([(1, 1, True), (1, 1, True), (5, 1, False), (6, 6, True), (None, None, True)], key=str)
    assert near_dedup.near_duplicates(docs(spark, [])).count() == 0


def test_match_threshold_misses_nothing():
    for n in (48, 64):
        t = near_dedup.match_threshold(n, 80)
        assert sum(math.comb(n, k) * 0.8**k * 0.2 ** (n - k) for k in range(t)) <= near_dedup.MISS


@pytest.mark.parametrize("window", [2, 13, 50])
def test_substring_dedup(spark, corpus, window):
    own = {}
    for i, t in corpus:
        w = split(t)
        for j in range(len(w) - window + 1):
            key = tuple(w[j : j + window])
            own[key] = min(own.get(key, i), i)
    expected = {}
    for i, t in corpus:
        w = split(t)
        gone = [False] * len(w)
        for j in range(len(w) - window + 1):
            if own[tuple(w[j : j + window])] < i:
                gone[j : j + window] = [True] * window
        expected[i] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g))
    got = substring_dedup.remove_repeats(docs(spark, corpus), window=window).collect()
    assert {x.doc_id: (x.n_words, x.n_removed, x.text) for x in got} == expected and len(got) == len(corpus)
    layout = {x.doc_id: x.text for x in substring_dedup.remove_repeats(docs(spark, corpus), window=window, layout="text").collect()}
    assert all(split(layout[i]) == split(e[2]) for i, e in expected.items())
    assert all(layout[i] == (t or "") for i, t in corpus if not expected[i][1])


def test_windows_are_compared_by_both_hashes_whole():
    """Equal in 96 bits and different beyond: not the same window."""
    pack = lambda x, kind=np.uint64: np.array([x], kind).tobytes()
    for other, found in ((1 << 32 | 8, b""), (1 << 32 | 7, pack(5))):
        table = pa.table({"chunk": [0, 1], "one": [pack(5)] * 2, "two": [pack(1 << 32 | 7), pack(other)], "owners": [pack(1, np.int64), pack(2, np.int64)]})
        assert substring_dedup._earlier(table)["one"].to_pylist() == [b"", found]
    hashes = np.arange(1, 30, dtype=np.uint64)
    _, one, two = substring_dedup._windows(hashes, hashes + np.uint64(99), np.array([0, 29]), 13)
    assert one.dtype == two.dtype == np.uint64 and (two & np.uint64(0xFFFFFFFF)).any()


def test_substring_dedup_over_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "CHUNK_BYTES", 500)
    r = random.Random(30)
    passage = sentence(r, 40, 9000)
    rows = [(k, sentence(r, 30, 9000) + " " + (passage + " " if k % 3 == 0 else "") + sentence(r, 10, 9000)) for k in range(200)]
    rows += [(k % 5, rows[k % 5][1]) for k in range(60)]  # repeated rows lie in any chunk
    got = substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), window=13).collect()
    assert len(got) == len(rows) and all(x.n_removed == (40 if x.doc_id % 3 == 0 and x.doc_id else 0) for x in got)


def test_carried_columns_of_substring_dedup(spark):
    rows = spark.createDataFrame([(1, "a b", 7, "x")], "doc_id long, text string, n_words long, chunk string")
    got = substring_dedup.remove_repeats(rows, carry=("n_words", "chunk"))
    assert got.columns == ["doc_id", "n_words", "n_removed", "text", "given_n_words", "chunk"] and tuple(got.first()) == (1, 2, 0, "a b", 7, "x")


def test_long_words_that_a_power_sum_confuses():
    pair = [b"ab", b"ba"]
    for _ in range(11):  # strings whose difference is divisible by every power of two
        pair = [pair[0] + pair[1], pair[1] + pair[0]]
    data = np.frombuffer(b" ".join(pair), np.uint8)
    n = len(pair[0])
    starts, ends = np.array([0, n + 1]), np.array([n, 2 * n + 1])
    assert all(len(set(hashed(data, starts, ends, second=x).tolist())) == 2 for x in (False, True))


def test_substring_dedup_of_odd_rows(spark):
    text = " ".join(map(str, range(20)))
    mine = [(4, text), (4, text), (None, text), (9, text), (10, None)]
    got = sorted(((x.doc_id, x.n_removed) for x in substring_dedup.remove_repeats(docs(spark, mine)).collect()), key=str)
    assert got == sorted([(4, 0), (4, 0), (None, 0), (9, 20), (10, 0)], key=str)
    assert substring_dedup.remove_repeats(docs(spark, [])).count() == 0


def test_runs_depend_on_order():
    a = np.array([1, 2, 3, 4, 3, 2, 1], np.uint64)
    assert len(set(runs_of(a, 3).tolist())) == 5 and len(runs_of(a, 8)) == 0


# 10 -----------------------------------------------------------------------------------------------------------------------


def _judge(url, rules):
    host = path = ""
    if url and "://" in url:
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url)
        host, path = lowered(m[1]), m[2]
    fits = [r for r in rules if host and (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: (len(r.host), len(r.path)), default=None)
    return host, path, best and best.key, best.verdict if best else "allow"


def test_url_filter(spark):
    r = random.Random(8)
    hosts = [f"{a}{b}.{c}" for a in ("", "www.", "m.") for b in ("x", "yy", "spam-farm") for c in ("com", "net", "example.org")]
    urls = [f"http{r.choice(['', 's'])}://{r.choice(hosts)}{r.choice(['', '/', '/en/', '/en/a?b=/es/', '/es#x', '?q', '#f'])}" for _ in range(300)]
    urls += [None, "", "no scheme", "://", "a\nb://X.COM/en/", "http:///en/", "http://x.com/" + "p" * 5000]
    rules = [url_filter.Rule("com", "/", "allow"), url_filter.Rule("x.com", "/en/", "block"), url_filter.Rule("www.x.com", "/en/", "allow"), url_filter.Rule("net", "", "block")]
    rules += [url_filter.Rule(h, p, r.choice(["allow", "block"])) for h in hosts[10:20] for p in ("/", "/es/")]
    rows = spark.createDataFrame([(k, u, "h") for k, u in enumerate(urls)] + [(0, urls[0], "h"), (None, urls[1], "h")], "page_id long, url string, host string")
    got = url_filter.filter_urls(rows, rules).collect()
    expected = [(k, *_judge(u, rules)) for k, u in [*enumerate(urls), (0, urls[0]), (None, urls[1])]]
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)
    assert url_filter.filter_urls(rows.limit(0), rules).count() == 0
    assert {x.verdict for x in url_filter.filter_urls(rows, []).collect()} == {"allow"}


def test_many_rules(spark):
    rules = [url_filter.Rule(f"h{k}.com", f"/p{k % 9}/", "block" if k % 3 else "allow") for k in range(20000)]
    urls = [(k, f"http://www.h{k % 25000}.com/p{k % 10}/x") for k in range(30000)]
    got = url_filter.filter_urls(spark.createDataFrame(urls, "page_id long, url string"), rules).collect()
    listed = {(f"h{k}.com", f"/p{k % 9}/"): "block" if k % 3 else "allow" for k in range(20000)}
    assert {x.page_id: x.rule and x.verdict for x in got} == {k: listed.get((f"h{k % 25000}.com", f"/p{k % 10}/")) for k, _ in urls}


def test_cascade_is_exact_over_its_universe(spark):
    listed, universe = spark.range(40).selectExpr("concat('k', id * 50) key"), spark.range(2000).selectExpr("concat('k', id) key")
    levels = url_filter.build_cascade(listed, universe, sizes=(40, 60))  # a first level too small, so that more follow
    assert len(levels) > 1
    passed = {r.key for r in universe.where(url_filter.in_cascade(F.col("key"), levels)).collect()}
    assert passed == {r.key for r in listed.collect()}
