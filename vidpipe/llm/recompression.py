"""Locally consistent parsing by recompression: token runs and pairs are named alike wherever they occur.

Names are 64-bit hashes of what they stand for, so all tasks agree on them without a table of names.  In the
first round each maximal run of one token becomes one symbol; in every round a symbol of the left class and
a following symbol of the right class become one symbol, the classes being a hash bit of the symbol and the
round.  Whether a symbol arises depends only on a few words around it; ``lo``/``hi`` below is that interval.
Two equal word sequences therefore hold the same symbols wherever the interval lies inside them.
"""

from __future__ import annotations

import numpy as np

from .common import mix

_RUN = np.uint64(0xA0761D6478BD642F)
_LEFT = np.uint64(0xE7037ED1A0B428DB)
_RIGHT = np.uint64(0x8EBC6AF09C88C6E3)
with np.errstate(over="ignore"):
    _SEEDS = np.arange(1, 65, dtype=np.uint64) * _RUN


def parse(hashes: np.ndarray, first: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all rows after ``rounds``: names, and the interval of word positions each one depends on.

    ``first`` has the first word of each row and the number of words.  Intervals may reach one word beyond a
    row, which no window of the row contains.
    """
    n = len(hashes)
    if not n:
        return hashes, np.zeros(0, np.int64), np.zeros(0, np.int64)
    head = np.zeros(n + 1, bool)
    head[first] = True
    starts = np.flatnonzero(head[:n] | np.concatenate([[True], hashes[1:] != hashes[:-1]]))
    ends = np.append(starts[1:], n)
    length = (ends - starts).astype(np.uint64)
    names = np.where(length > 1, mix(hashes[starts] + length * _RUN), hashes[starts])
    begins = head[starts]  # the first symbol of a row
    lo, hi = starts - 1, ends + 1
    for k in range(rounds):
        left = (mix(names + _SEEDS[k]) & np.uint64(1)).astype(bool)
        last = np.append(begins[1:], True)
        nexts = np.append(left[1:], True)
        pair = left & ~nexts & ~last
        second = np.concatenate([[False], pair[:-1]])
        lone = ~pair & ~second
        lo, hi = lo.copy(), hi.copy()
        before, after = np.concatenate([lo[:1], lo[:-1]]), np.append(hi[1:], hi[-1:])
        right = lone & left  # alone because of what follows
        hi[right] = np.where(last, hi + 1, np.maximum(hi, after))[right]
        other = lone & ~left  # alone because of what precedes
        lo[other] = np.where(begins, lo - 1, np.minimum(lo, before))[other]
        at = np.flatnonzero(pair)
        names = names.copy()
        names[at] = mix(mix(names[at] * _LEFT) + names[at + 1] * _RIGHT)
        lo[at], hi[at] = np.minimum(lo[at], lo[at + 1]), np.maximum(hi[at], hi[at + 1])
        keep = ~second
        names, lo, hi, begins = names[keep], lo[keep], hi[keep], begins[keep]
    return names, lo, hi
