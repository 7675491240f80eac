"""Byte-level BPE by a rank file: encoding with a rank queue on a hierarchical bitmap, and decoding.

Each match of the split pattern is merged by itself.  Its adjacent pairs wait in buckets by merge rank, as
positions in a linked list; bitmaps tell the lowest rank that has a bucket by find-first-set.  Entries that a
merge has made stale are skipped when they come up.  The queue has two forms with the same result: ``merge``
serves one piece of any length, at a cost per merge that does not depend on the length; ``merge_many`` holds
all short pieces of some texts in one queue and, of the lowest block of ranks, takes every piece's own next
pair at once, as pieces do not touch each other.  Frequent pieces are remembered in a cache of bounded size.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, slices

#: Remembered pieces per task; pieces of more than LONG characters are merged one by one.
CACHE = 300_000
LONG = 64

_models: dict[tuple[str, str], tuple] = {}


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one base64 token and its rank a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class RankQueue:
    """Positions by rank: ``push`` in any order, ``pop`` the lowest rank's smallest position."""

    __slots__ = ("buckets", "leaves", "root")

    def __init__(self) -> None:
        self.root = 0
        self.leaves: dict[int, int] = {}
        self.buckets: dict[int, list[int]] = {}

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket:
            heapq.heappush(bucket, position)
            return
        self.buckets[rank] = [position]
        high = rank >> 8
        self.leaves[high] = self.leaves.get(high, 0) | 1 << (rank & 255)
        self.root |= 1 << high

    def pop(self) -> tuple[int, int]:
        high = (self.root & -self.root).bit_length() - 1
        leaf = self.leaves[high]
        rank = high << 8 | (leaf & -leaf).bit_length() - 1
        bucket = self.buckets[rank]
        position = heapq.heappop(bucket)
        if not bucket:
            leaf &= leaf - 1
            self.leaves[high] = leaf
            if not leaf:
                self.root &= self.root - 1
        return rank, position


def merge(piece: bytes, ranks: dict[bytes, int], longest: int) -> list[int]:
    """The ids of one piece: the lowest rank merges first, the leftmost of equal ones."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    following, before = list(range(1, n + 1)), list(range(-1, n - 1))
    waits = [-1] * n  # the rank under which the pair that begins here now waits
    queue = RankQueue()
    for i in range(n - 1):
        rank = ranks.get(piece[i : i + 2])
        if rank is not None:
            waits[i] = rank
            queue.push(rank, i)
    while queue.root:
        rank, i = queue.pop()
        if waits[i] != rank:
            continue  # stale
        gone = following[i]
        end = following[gone]
        following[i] = end
        waits[gone] = waits[i] = -1
        if end < n:
            before[end] = i
            to = following[end]
            if to - i <= longest:
                rank = ranks.get(piece[i:to])
                if rank is not None:
                    waits[i] = rank
                    queue.push(rank, i)
        left = before[i]
        if left >= 0:
            waits[left] = -1
            if end - left <= longest:
                rank = ranks.get(piece[left:end])
                if rank is not None:
                    waits[left] = rank
                    queue.push(rank, left)
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : following[i]]])
        i = following[i]
    return out


#: Ranks of one block of the queue of ``merge_many``: 1 << BLOCK.
BLOCK = 10


class _Pairs:
    """The rank of two adjacent ids, for arrays: every split of a token into two tokens."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        found = [
            (ranks[t[:i]] << 32 | ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks
        ]
        found.sort()
        self.keys = np.array([k for k, _ in found], np.int64)
        self.values = np.array([r for _, r in found], np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.values[at], -1)


def merge_many(pieces: list[bytes], pairs: _Pairs) -> list[bytes]:
    """The packed ids of each piece; none is empty."""
    sizes = np.array([len(p) for p in pieces])
    n = int(sizes.sum())
    piece = np.repeat(np.arange(len(pieces)), sizes)
    token = pairs.bytes[np.frombuffer(b"".join(pieces), np.uint8)]
    following, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    ends = np.cumsum(sizes)
    following[ends - 1] = -1
    before[ends - sizes] = -1
    waits = np.full(n, -1)
    buckets: dict[int, list[np.ndarray]] = {}
    root = 0

    def push(positions: np.ndarray, ranks: np.ndarray) -> int:
        waits[positions] = ranks
        yes = ranks >= 0
        if not yes.any():
            return 0
        positions, block = positions[yes], ranks[yes] >> BLOCK
        order = np.argsort(block, kind="stable")
        positions, block = positions[order], block[order]
        cut = np.flatnonzero(np.diff(block, prepend=-1))
        bits = 0
        for b, part in zip(block[cut].tolist(), np.split(positions, cut[1:]), strict=True):
            buckets.setdefault(b, []).append(part)
            bits |= 1 << b
        return bits

    first = np.flatnonzero(following >= 0)
    if len(first):
        root |= push(first, pairs(token[first], token[first + 1]))
    while root:
        block = (root & -root).bit_length() - 1
        at = np.concatenate(buckets.pop(block))
        at = at[waits[at] >> BLOCK == block]  # else stale
        order = np.lexsort((at, waits[at], piece[at]))
        at = at[order]
        own = np.diff(piece[at], prepend=-1) != 0
        rest, at = at[~own], at[own]
        if len(rest):
            buckets[block] = [rest]
        else:
            root &= root - 1
        gone = following[at]
        token[at] = waits[at]
        waits[gone] = -1
        waits[at] = -1
        token[gone] = -1
        after = following[gone]
        following[at] = after
        more = after >= 0
        before[after[more]] = at[more]
        left = before[at]
        has = left >= 0
        one, two = np.concatenate([at[more], left[has]]), np.concatenate([after[more], at[has]])
        if len(one):
            root |= push(one, pairs(token[one], token[two]))
    alive = token >= 0
    packed = token[alive].astype("<u4").tobytes()
    cut = np.concatenate([[0], np.cumsum(np.add.reduceat(alive, ends - sizes))]) * 4
    return [packed[a:b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]


class _Pieces(dict):
    """Piece -> its ids as packed little-endian 32-bit integers."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        super().__init__()
        self.ranks, self.longest, self.pairs = ranks, max(map(len, ranks)), _Pairs(ranks)

    def __missing__(self, piece: str) -> bytes:
        return np.array(merge(piece.encode(), self.ranks, self.longest), "<u4").tobytes()

    def learn(self, split: list[list[str]]) -> None:
        """Remember all short pieces of some texts."""
        all_pieces = set().union(*split)
        new = [p for p in all_pieces if p not in self and len(p) <= LONG]
        if len(self) + len(new) > CACHE:  # what these texts do not use again goes
            kept = {p: self[p] for p in all_pieces if p in self}
            self.clear()
            self.update(kept)
        raw = [p.encode() for p in new]
        todo = []
        for p, r in zip(new, raw, strict=True):
            rank = self.ranks.get(r)
            if rank is None:
                todo.append((p, r))
            else:
                self[p] = rank.to_bytes(4, "little")
        if todo:
            self.update(zip([p for p, _ in todo], merge_many([r for _, r in todo], self.pairs), strict=True))


def _model(path: str, pattern: str) -> tuple[Callable, _Pieces, list[bytes]]:
    """Of this worker process; read once."""
    if (path, pattern) not in _models:
        ranks = read_ranks(path)
        table = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            table[rank] = token
        _models[path, pattern] = (regex.compile(pattern).findall, _Pieces(ranks), table)
    return _models[path, pattern]


def encode_texts(texts: list[str], path: str, pattern: str) -> list[bytes]:
    """The packed ids of each text."""
    find, pieces, _ = _model(path, pattern)
    split = [find(t) for t in texts]
    pieces.learn(split)
    return [b"".join(map(pieces.__getitem__, own)) for own in split]


def decode_ids(packed: bytes, path: str, pattern: str) -> bytes:
    """The bytes that packed ids stand for; an id without a token raises."""
    table = _model(path, pattern)[2]
    return b"".join(map(table.__getitem__, np.frombuffer(packed, "<u4").tolist()))


def encode_decode(documents: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_tokens, ids, decoded)``, one row per input row.

    ``ids`` are packed little-endian unsigned 32-bit integers, ``decoded`` the bytes read back from them.  Every
    whole text is encoded, without special tokens; null counts as empty, which has no ids.  Ids of rows are
    carried as they are (null and repeated ones too); other columns do not matter; no rows give no rows.  ``path``
    must be readable on every executor, as installed packages are.
    """
    docs = documents.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                ids = encode_texts(part["text"].to_pylist(), path, pattern)
                decoded = [decode_ids(x, path, pattern) for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()), pa.array(decoded, pa.binary())],
                    names=["doc_id", "n_tokens", "ids", "decoded"],
                )
        give_back()

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens bigint, ids binary, decoded binary")
