"""Removal of long word sequences that an earlier document already has, by recompression.

Rows are dealt evenly into chunks of about ``CHUNK_BYTES`` of text; the shuffled texts are read three times.

1. Each chunk parses its texts (see ``recompression``) and deals the distinct symbols, by hash, into buckets.
   A bucket finds the symbols that occur in two rows and tells each chunk which of its own do.
2. A window is a candidate if every symbol that lies inside it with all it depends on is shared: an equal
   window elsewhere would hold the same symbols.  Each chunk deals the hashes of its candidate windows with
   their smallest document; a bucket returns those that start in a smaller document of another chunk.
3. Each chunk removes what the answers and its own documents cover.

A chunk sends a symbol or window once however many of its documents have it: one that all documents share adds
one entry a chunk to its bucket.  Equal ones of all chunks meet as packed hashes, a row for each chunk and bucket
that have some in common, so rows are never more than symbols and each carries many as long as chunks are large;
no text and no list of pairs is gathered.  Windows are compared by 128 bits, from two hashes of each of their words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACES, buckets, carry_names, give_back, hashed, runs_of, spans, utf8
from .recompression import parse

#: Bytes of text dealt together, on average; a longer text is a chunk with what else it meets.
CHUNK_BYTES = 2 << 20
#: Bytes of a symbol's name that are sent; names that agree in these and are not equal only make further candidates.
NAME_BYTES = 6


def rounds_for(window: int) -> int:
    """Rounds after which symbols are long yet still depend on less than a window."""
    return max(1, window.bit_length() - 1)


def _words(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes and offsets of the texts, start and end of each word, and of each row the first word (one more than rows); last the words' hashes."""
    data, offsets = utf8(table["text"])
    starts, ends = spans(data, offsets, SPACES)
    return data, offsets, starts, ends, np.searchsorted(starts, offsets), hashed(data, starts, ends)


def _pack(values: np.ndarray, cut: np.ndarray, at: np.ndarray) -> pa.Array:
    return pa.array([values[cut[k] : cut[k + 1]].tobytes() for k in at], pa.binary())


def _bucketed(hashes: np.ndarray, many: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A stable order by bucket, the cuts between buckets, and the buckets with rows."""
    bucket = ((hashes >> np.uint64(33)) % np.uint64(many)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    cut = np.searchsorted(bucket[order], np.arange(many + 1))
    return order, cut, np.flatnonzero(cut[1:] > cut[:-1])


def _windows(hashes: np.ndarray, other: np.ndarray, first: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start positions of all windows, and both hashes of each."""
    runs = runs_of(hashes, window)
    if not len(runs):
        return np.zeros(0, np.int64), runs, runs
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at = np.flatnonzero(row[: len(runs)] == row[window - 1 :])
    return at, runs[at], runs_of(other, window)[at]


def _groups(one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, int]:
    """A number for each pair of hashes, equal for equal pairs, and how many there are."""
    order = np.argsort(one, kind="stable")
    a, b = one[order], two[order]
    if ((a[1:] == a[:-1]) & (b[1:] != b[:-1])).any():
        order = np.lexsort((two, one))
        a, b = one[order], two[order]
    new = np.ones(len(one), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    out = np.empty(len(one), np.int64)
    out[order] = np.cumsum(new) - 1
    return out, int(new.sum())


def _least(group: np.ndarray, many: int, owner: np.ndarray) -> np.ndarray:
    least = np.full(many, np.iinfo(np.int64).max)
    np.minimum.at(least, group, owner)
    return least


def _joined(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    return np.concatenate([np.zeros(0, kind), *(np.frombuffer(x.as_buffer(), kind) for x in column)])


def _symbols(window: int, many: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        *_, first, hashes = _words(table)
        names, lo, hi = parse(hashes, first, rounds_for(window))
        inside = hi - lo <= window
        names, lo, hi = names[inside], lo[inside], hi[inside]
        row = np.searchsorted(first, (lo + hi) // 2, side="right")
        order = np.lexsort((row, names))
        names, row = names[order], row[order]
        new = np.ones(len(names), bool)
        new[1:] = names[1:] != names[:-1]
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], len(names))
        several = row[begin] != row[end - 1] if len(begin) else np.zeros(0, bool)
        names = names[begin]
        order, cut, full = _bucketed(names, many)
        return pa.table(
            [pa.array(full, pa.int32()), pa.array(np.full(len(full), key[0].as_py()), pa.int64()),
             _pack(names[order].view(np.uint8).reshape(-1, 8)[:, :NAME_BYTES], cut, full), _pack(several[order], cut, full)],
            names=["bucket", "chunk", "names", "several"],
        )

    return run


def _shared(table: pa.Table) -> pa.Table:
    sizes = [len(x.as_buffer()) // NAME_BYTES for x in table["names"]]
    sent, several = _joined(table["names"], np.uint8).reshape(-1, NAME_BYTES), _joined(table["several"], bool)
    names = np.pad(sent, ((0, 0), (0, 8 - NAME_BYTES))).view(np.uint64).ravel()
    order = np.argsort(names, kind="stable")
    ordered = names[order]
    new = np.ones(len(names), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    group = np.cumsum(new) - 1
    size = np.bincount(group)
    yes = (size >= 2) | (np.bincount(group, weights=several[order]) > 0)
    keep = np.empty(len(names), bool)
    keep[order] = yes[group]
    cut = np.concatenate([[0], np.cumsum(sizes)])
    short = (names & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    out = [short[a:b][keep[a:b]].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)]
    return pa.table([table["chunk"], pa.array(out, pa.binary())], names=["chunk", "shared"])


def _candidates(window: int, many: int):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        data, _, starts, ends, first, hashes = _words(docs)
        at, one, two = _windows(hashes, hashed(data, starts, ends, second=True), first, window)
        names, lo, hi = parse(hashes, first, rounds_for(window))
        inside = hi - lo <= window
        names, lo, hi = names[inside], lo[inside], hi[inside]
        alone = ~np.isin((names & np.uint64(0xFFFFFFFF)).astype(np.uint32), _joined(answers["shared"], np.uint32))
        dead = np.zeros(len(hashes) + 2, np.int64)  # windows that hold a symbol that is not shared
        np.add.at(dead, np.maximum(hi[alone] - window, 0), 1)
        np.add.at(dead, np.maximum(lo[alone] + 1, 0), -1)
        keep = np.cumsum(dead)[at] == 0
        at, one, two = at[keep], one[keep], two[keep]
        group, many_own = _groups(one, two)
        owner = _least(group, many_own, docs["doc_id"].to_numpy()[np.searchsorted(first, at, side="right") - 1])
        some = np.zeros(many_own, np.int64)  # a window of each group
        some[group] = np.arange(len(group))
        order = np.argsort(owner, kind="stable")  # runs of one document pack well
        one, two, owner = one[some][order], two[some][order], owner[order]
        order, cut, full = _bucketed(one, many)
        chunk = docs["chunk"][0].as_py() if docs.num_rows else -1
        give_back()
        return pa.table(
            [pa.array(full, pa.int32()), pa.array(np.full(len(full), chunk), pa.int64()), *(_pack(x[order], cut, full) for x in (one, two, owner))],
            names=["bucket", "chunk", "one", "two", "owners"],
        )

    return run


def _earlier(table: pa.Table) -> pa.Table:
    sizes = [len(x.as_buffer()) // 8 for x in table["one"]]
    one, two, owner = _joined(table["one"], np.uint64), _joined(table["two"], np.uint64), _joined(table["owners"], np.int64)
    group, many = _groups(one, two)
    keep = _least(group, many, owner)[group] < owner
    cut = np.concatenate([[0], np.cumsum(sizes)])
    out = [pa.array([x[a:b][keep[a:b]].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary()) for x in (one, two)]
    return pa.table([table["chunk"], *out], names=["chunk", "one", "two"])


def _cut(window: int, layout: str, carry: list[str]):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        data, offsets, starts, ends, first, hashes = _words(docs)
        at, one, two = _windows(hashes, hashed(data, starts, ends, second=True), first, window)
        owner = docs["doc_id"].to_numpy()[np.searchsorted(first, at, side="right") - 1] if len(at) else np.zeros(0, np.int64)
        told = _joined(answers["one"], np.uint64)
        group, many = _groups(np.concatenate([told, one]), np.concatenate([_joined(answers["two"], np.uint64), two]))
        earlier = np.zeros(many, bool)
        earlier[group[: len(told)]] = True
        group = group[len(told) :]
        hit = at[earlier[group] | (_least(group, many, owner)[group] < owner)]
        cover = np.zeros(len(hashes) + 1, np.int64)
        np.add.at(cover, hit, 1)
        np.add.at(cover, hit + window, -1)
        gone = np.cumsum(cover)[:-1] > 0
        give_back()
        raw, texts = data.tobytes(), []
        removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[first])
        for i, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), strict=True)):
            text = raw[offsets[i] : offsets[i + 1]]
            if layout == "words":
                parts = text.split()
                texts.append(b" ".join([w for w, g in zip(parts, gone[a:b].tolist(), strict=True) if not g] if removed[i] else parts))
            elif not removed[i]:
                texts.append(text)
            else:  # each run of removed words goes with the white space after it
                edge = np.flatnonzero(np.diff(np.concatenate([[0], gone[a:b].astype(np.int8), [0]])))
                parts, done = [], 0
                for s, e in edge.reshape(-1, 2).tolist():
                    parts.append(text[done : int(starts[a + s] - offsets[i])])
                    done = int(starts[a + e] - offsets[i]) if a + e < b else len(text)
                texts.append(b"".join([*parts, text[done:]]))
        return pa.table(
            [docs["doc_id"], pa.array(np.diff(first), pa.int64()), pa.array(removed, pa.int64()), pa.array(texts, pa.binary()).cast(pa.string()), *(docs[c] for c in carry)],
            names=["doc_id", "n_words", "n_removed", "text", *carry],
        )

    return run


def remove_repeats(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13, layout: str = "words", carry: tuple[str, ...] = ()
) -> DataFrame:
    """``(doc_id, n_words, n_removed, text, *carry)``, one row per input row; ``carry`` names columns that go along.

    Words are runs without white space.  Every word that lies in a window of ``window`` words whose sequence
    also starts in a document of smaller id is removed; windows are judged on the input.  ``layout`` "words"
    joins kept words by one space, "text" keeps the text around removed words as it was.  Null texts have no
    words and give an empty text; shorter texts than a window stay whole.  Ids are integers.  Rows that repeat an id are that one
    document.  A row with null id neither removes nor loses anything.  No rows give no rows; other columns do
    not matter; a carried column called like a result gets ``given_`` before its name.
    """
    spark = documents.sparkSession
    own = [f"_carry{i}" for i in range(len(carry))]  # whatever they are called, they clash with nothing
    docs = documents.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"), *(F.col(c).alias(o) for c, o in zip(carry, own, strict=True)))
    many = buckets(spark, 2)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(1, size // CHUNK_BYTES)
    # rows are dealt by where they stand, so neither one id nor one text gathers in a chunk
    dealt = docs.where("doc_id IS NOT NULL").select("doc_id", "text", *own, F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(chunks)).alias("chunk"))
    by_chunk = dealt.groupBy("chunk")
    shared = (
        by_chunk.applyInArrow(_symbols(window, many), "bucket int, chunk bigint, names binary, several binary")
        .groupBy("bucket").applyInArrow(_shared, "chunk bigint, shared binary")
    )
    earlier = (
        by_chunk.cogroup(shared.groupBy("chunk"))
        .applyInArrow(_candidates(window, many), "bucket int, chunk bigint, one binary, two binary, owners binary")
        .groupBy("bucket").applyInArrow(_earlier, "chunk bigint, one binary, two binary")
    )
    out = by_chunk.cogroup(earlier.groupBy("chunk")).applyInArrow(
        _cut(window, layout, own), "doc_id bigint, n_words bigint, n_removed bigint, text string" + "".join(f", {o} {docs.schema[o].dataType.simpleString()}" for o in own)
    )
    word = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    plain = docs.where("doc_id IS NULL").select(
        "doc_id", F.coalesce(F.size(word).cast("bigint"), F.lit(0)).alias("n_words"), F.lit(0).cast("bigint").alias("n_removed"),
        F.coalesce(F.array_join(word, " ") if layout == "words" else F.col("text"), F.lit("")).alias("text"), *own,
    )
    return out.unionByName(plain).withColumnsRenamed(dict(zip(own, carry_names(carry, ["doc_id", "n_words", "n_removed", "text"]), strict=True)))
