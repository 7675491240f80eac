"""Runs of repeated words in texts: Lyndon arrays by grouping, Lyndon roots extended into runs.

1. Words that no run can contain are passed over: in a run every word lies in some stretch of a few words that
   the same text has twice.  What remains are segments, most often none; each is searched by itself.
2. Suffixes of a segment are grouped by their first word.  Groups are taken from the highest down; each suffix of a
   group reports to the nearest earlier one of a lower group, whose prefix then goes on by that of the group, and
   those that heard equally often part from the rest of their group.  What a group's suffixes begin with in the
   end is the longest Lyndon word there.  Done for both orders of the words.
3. A run holds its Lyndon root, for one of the two orders, once in each period.  Where a root follows itself often
   enough, the longest common extensions to both sides give the run's ends.

Texts are read once, in a map without shuffle; what a task holds is a few megabytes of text or one longer text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, give_back, hashed, mix, runs_of, slices, spans, utf8


def lyndon_lengths(codes: list[int]) -> list[int]:
    """For each position the length of the longest Lyndon word that begins there; codes are 0 to their number - 1, all in use."""
    n = len(codes)
    group = list(codes)
    members: list[list[int]] = [[] for _ in range(max(codes, default=-1) + 1)]
    for i, c in enumerate(codes):
        members[c].append(i)
    size = [len(m) for m in members]
    length = [1] * len(members)
    below, above = list(range(-1, len(members) - 1)), list(range(1, len(members) + 1))
    open_ = list(range(n + 1))  # of position i - 1: itself, or a way to the nearest earlier one whose group is still to come
    at = len(members) - 1
    while at >= 0:
        own = [s for s in members[at] if group[s] == at]
        for s in own:
            open_[s + 1] = s
        heard: dict[int, int] = {}
        for s in own:
            while open_[s] != s:
                open_[s] = s = open_[open_[s]]
            if s:
                heard[s - 1] = heard.get(s - 1, 0) + 1
        step = length[at]
        parts: dict[int, dict[int, list[int]]] = {}
        for p, times in heard.items():
            parts.setdefault(group[p], {}).setdefault(times, []).append(p)
        for old, by_times in parts.items():
            many = sorted(by_times, reverse=True)
            whole = sum(map(len, by_times.values())) == size[old]
            before = length[old]
            if whole:
                length[old] = before + many.pop() * step  # the rest is gone, so those that heard least stay
            for times in many:  # each right above the old group, the most often heard end highest
                new, moved = len(members), by_times[times]
                members.append(moved)
                size.append(len(moved))
                size[old] -= len(moved)
                length.append(before + times * step)
                below.append(old)
                above.append(above[old])
                below[above[old]] = new
                above[old] = new
                for p in moved:
                    group[p] = new
        at = below[at]
    return [length[g] for g in group]


def _extent(x: np.ndarray, y: np.ndarray) -> int:
    """How many elements two arrays have in common from the start."""
    n, done, step = min(len(x), len(y)), 0, 16
    while done < n:
        same = x[done : min(done + step, n)] == y[done : min(done + step, n)]
        if not same.all():
            return done + int(same.argmin())
        done, step = done + len(same), step * 2
    return n


def runs_in(codes: np.ndarray, exponent: int, least: int) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of all runs at least ``least`` long and ``exponent`` (2 or more) times their smallest period."""
    found, n = set(), len(codes)
    _, dense = np.unique(codes, return_inverse=True)
    for order in (dense, dense.max(initial=0) - dense):
        roots = np.array(lyndon_lengths(order.tolist()), np.int64)
        place = np.arange(n)
        fits = place + roots * (exponent - 1) <= n  # so many whole roots stand in a run, wherever it begins
        for k in range(1, exponent - 1):
            there = np.minimum(place + k * roots, n - 1)
            fits &= (roots[there] == roots) & (codes[there] == codes)
        upto: dict[int, int] = {}  # where the last run of a period ends
        for i in np.flatnonzero(fits).tolist():
            p = int(roots[i])
            if i + p <= upto.get(p, 0):
                continue
            start = i - _extent(codes[:i][::-1], codes[: i + p][::-1])
            end = i + p + _extent(codes[i:], codes[i + p :])
            upto[p] = end
            if end - start >= max(least, exponent * p):
                found.add((start, end - start, p))
    return sorted(found, key=lambda r: (r[0], r[2]))


def stretch(exponent: int, least: int) -> int:
    """Words of the longest stretch such that every word of a run lies in one that occurs twice in the run."""
    return max(1, min(max(least, exponent * q) - 2 * q + 1 for q in range(1, least + 2)))


def _segments(hashes: np.ndarray, first: np.ndarray, width: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the stretches of ``least`` words or more that stand in repeated ``width``-word sequences of their row."""
    grams = runs_of(hashes, width)
    none = np.zeros(0, np.int64)
    if not len(grams):
        return none, none
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at = np.flatnonzero(row[: len(grams)] == row[width - 1 :])
    keys = mix(grams[at] + row[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(cover, at[twice], 1)
    np.add.at(cover, at[twice] + width, -1)
    hot = np.cumsum(cover)[:-1] > 0
    begins = np.zeros(len(hashes) + 1, bool)
    begins[first] = True
    starts = np.flatnonzero(hot & (begins[:-1] | ~np.concatenate([[False], hot[:-1]])))
    ends = np.flatnonzero(hot & (begins[1:] | ~np.concatenate([hot[1:], [False]]))) + 1
    long = ends - starts >= least
    return starts[long], ends[long]


def _codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number for each word, equal for equal words."""
    sizes = ends - starts
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    at = np.repeat(starts - offsets[:-1], sizes) + np.arange(offsets[-1])
    array = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[at].tobytes())])
    return array.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _search(part: pa.RecordBatch, exponent: int, least: int) -> pa.RecordBatch:
    data, offsets = utf8(part["text"])
    starts, ends = spans(data, offsets, SPACES)
    first = np.searchsorted(starts, offsets)
    rows = len(first) - 1
    runs: list[list[tuple[int, int, int]]] = [[] for _ in range(rows)]
    gone = np.zeros(len(starts) + 1, np.int64)
    for a, b in zip(*_segments(hashed(data, starts, ends), first, stretch(exponent, least), least), strict=True):
        row = int(np.searchsorted(first, a, side="right")) - 1
        for start, length, period in runs_in(_codes(data, starts[a:b], ends[a:b]), exponent, least):
            runs[row].append((int(a - first[row]) + start, length, period))
            gone[a + start + period] += 1
            gone[a + start + length] -= 1
    kept = np.cumsum(gone)[:-1] <= 0
    # kept words with one space before each but the first of a text
    cover = np.zeros(len(data) + 1, np.int64)
    cover[starts[kept]] += 1
    np.add.at(cover, ends[kept], -1)
    keep = np.cumsum(cover)[:-1] > 0
    row_of = np.repeat(np.arange(rows), np.diff(first))[kept]
    later = np.concatenate([[False], row_of[1:] == row_of[:-1]]) if len(row_of) else np.zeros(0, bool)
    spaces = starts[kept][later] - 1
    keep[spaces] = True
    out = data.copy()
    out[spaces] = 32
    ends_of = np.concatenate([[0], np.cumsum(keep)])[offsets]
    texts = pa.StringArray.from_buffers(rows, pa.py_buffer(ends_of.astype(np.int32)), pa.py_buffer(out[keep].tobytes()))
    flat = np.array([r for own in runs for r in own], np.int64).reshape(-1, 3)
    struct = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(flat[:, k])) for k in range(3)], names=["start", "length", "period"])
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(r) for r in runs])]).astype(np.int32)), struct)
    return pa.RecordBatch.from_arrays([part["doc_id"], pa.array(np.diff(first), pa.int64()), lists, texts], names=["doc_id", "n_words", "runs", "collapsed"])


def find_runs(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", exponent: int = 4, least: int = 6) -> DataFrame:
    """``(doc_id, n_words, runs, collapsed)``, one row per input row.

    Words are runs without white space.  ``runs`` has ``(start, length, period)`` of every stretch of words whose
    smallest period is ``period``, that no neighbouring word extends, and that is ``least`` words or more and
    ``exponent`` (2 or more) times its period or more, by start, then period.  ``collapsed`` has the words that no run contains
    after its first period, joined by one space.  Null and empty texts have no words, no runs and an empty text.
    Texts are searched whole, however long; rows go by themselves, so repeated and null ids stay as they are.
    Ids are integers.  No rows give no rows; other columns do not matter.
    """
    if exponent < 2 or least < 1:
        raise ValueError("a run has its period twice at least")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                yield _search(part, exponent, least)
        give_back()

    docs = documents.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return docs.mapInArrow(run, "doc_id bigint, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string")


def with_tails(text: Column, doc_id: Column) -> Column:
    """The text, or for one id in ten its words with a repeating end: from a word on, as long as the text goes, the words of a stretch that begins there."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def tail(w: Column) -> Column:
        n = F.size(w)
        a = (g % n).cast("int")
        p = F.floor((n - a) / (3 + g % 8)).cast("int") + 1
        return F.when(n > 0, F.array_join(F.transform(w, lambda x, i: F.when(i < a, x).otherwise(F.get(w, a + (i - a) % p))), " ")).otherwise(text)

    return F.when(h % 10 == 0, F.get(F.transform(F.array(words), tail), F.lit(0))).otherwise(text)
