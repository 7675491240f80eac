"""Shared helpers: bounded samples of rows, names of carried columns, and words of Arrow text columns as numpy arrays."""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from ..scratch import shared_dir, written

__all__ = ["shared_dir", "written"]

#: Bits of an id's hash, and how many of them one pass of ``hash_bounds`` tells apart.
HASH_BITS, PASS_BITS = 60, 12


def id_hash(key: Column) -> Column:
    """A number below 2 to the HASH_BITS of an id, by which samples are taken."""
    return F.shiftrightunsigned(F.xxhash64(key), 64 - HASH_BITS)


def hash_bounds(rows: DataFrame, most: int) -> DataFrame:
    """``(grp, bound)`` of ``rows(grp, h)``: below ``bound`` lie at most ``most`` distinct ``h`` of the group, and nine tenths of that if it has them.

    The hashes are counted by their leading bits, after a partial count in every task; where one range of them
    holds too many, that range alone is counted again more finely.  A row for each group and range, at most
    2 to the PASS_BITS for a group, reaches the driver; no group of rows is ever gathered or sorted.
    """
    spark = rows.sparkSession
    each = rows.where("grp IS NOT NULL").groupBy("grp", "h").agg(F.count("*").alias("_n"))  # repeated ids count once
    bounds: dict = {}
    within: dict | None = None  # group -> the range that is open, and what lies below it
    shift = HASH_BITS
    while shift and (within is None or within):
        shift -= PASS_BITS
        open_rows = each
        if within is not None:
            ranges = spark.createDataFrame([(g, lo) for g, (lo, _) in within.items()], rows.select("grp").schema.add("lo", LongType()))
            open_rows = each.join(F.broadcast(ranges), "grp").where(F.shiftright("h", shift + PASS_BITS) == F.col("lo"))  # a row for each group
        counted: dict = {}
        for r in open_rows.groupBy("grp", F.shiftright("h", shift).alias("at")).count().collect():
            counted.setdefault(r["grp"], []).append((r["at"], r["count"]))
        last, within = within or {}, {}
        for g, found in counted.items():
            total = last[g][1] if g in last else 0
            bounds[g] = (last[g][0] << (shift + PASS_BITS)) if g in last else 0
            for at, n in sorted(found):
                if total + n > most:
                    bounds[g] = at << shift
                    if total < most * 0.9:
                        within[g] = (at, total)
                    break
                total += n
            else:
                bounds[g] = 1 << HASH_BITS if g not in last else (last[g][0] + 1) << (shift + PASS_BITS)
    return spark.createDataFrame(sorted(bounds.items()), rows.select("grp").schema.add("bound", LongType()))


def bit_words(at: DataFrame, bits: int) -> Column:
    """A bitmap with the bits of ``at(at)`` set, as an array of words that plans carry once: its size is ``bits``, whatever the rows are."""
    words = np.zeros(bits // 64, np.int64)
    for r in at.selectExpr("int(at div 64) w", "shiftleft(1L, int(at % 64)) b").groupBy("w").agg(F.bit_or("b").alias("b")).collect():  # bits / 64 rows at most
        words[r["w"]] = r["b"]
    return F.from_json(F.lit("[" + ",".join(map(str, words.tolist())) + "]"), "array<bigint>")


def bit_set(words: Column, at: Column) -> Column:
    """Whether bit ``at`` of a bitmap is set."""
    return F.get(words, F.shiftright(at, 6).cast("int")).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("bigint"), at.bitwiseAND(F.lit(63)).cast("int"))) != 0


def carry_names(carry: tuple[str, ...], results: list[str]) -> list[str]:
    """What carried columns are called beside some results: as before, with ``given_`` in front where a result has that name."""
    return [f"given_{c}" if c in results else c for c in carry]


def buckets(spark: SparkSession, per: int = 1) -> int:
    """How many buckets to deal work into: a multiple of the session's shuffle partitions, which grow with the data."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) * per)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column, nulls as empty, and its offsets (one more than rows)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offs, data = column.buffers()
    if len(column) == 0 or offs is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(offs, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def give_back() -> None:
    """Hand freed memory back to the system at a task's end: a worker serves many stages, and what one needed would stay with all later ones."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it
    if trim:
        trim(0)


def slices(batch: pa.RecordBatch, text: str, most: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """Row slices of a batch with about ``most`` bytes of text each (a longer text stands alone)."""
    if batch.num_rows == 0:
        return
    _, offsets = utf8(batch.column(text))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1)
        yield batch.slice(at, to - at)
        at = to


#: White space of the word pattern ``[^\x20\x09-\x0D]+``.
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True

#: A-Z to a-z, other bytes unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_P = np.uint64(0x9E3779B97F4A7C15)
_Q = np.uint64(0xC2B2AE3D27D4EB4F)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}
#: Bytes of the longest word that is hashed with all others at once; such a hash is not to be trusted on longer ones.
_WORD = 512


def _power(n: int, base: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of a base and of its inverse, modulo 2 to the 64."""
    have = _powers.get(int(base))
    if have is None or len(have[0]) < n:
        made = []
        for p in (base, np.uint64(pow(int(base), -1, 1 << 64))):
            steps = np.full(max(n, 1 << 17), p, np.uint64)
            steps[0] = 1
            made.append(np.cumprod(steps, dtype=np.uint64))
        have = _powers[int(base)] = (made[0], made[1])
    return have[0][:n], have[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the result depends on every bit of ``x``."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def spans(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of every word; words end at separators and at the ends of texts."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = ~separators[data]
    before = np.empty_like(word)
    before[0] = False
    before[1:] = word[:-1]
    edges = offsets[1:-1]
    before[edges[edges < len(data)]] = False
    starts = np.flatnonzero(word & ~before)
    after = np.empty_like(word)
    after[-1] = False
    after[:-1] = word[1:]
    edges = offsets[1:] - 1
    after[edges[edges >= 0]] = False
    return starts, np.flatnonzero(word & ~after) + 1


def hashed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, second: bool = False, block: int = 1 << 17) -> np.ndarray:
    """A 64-bit hash of each span's bytes (equal bytes, equal hash), with memory bound by ``block`` and the longest span.

    ``second`` gives another hash, so that both together have 128 bits.
    """
    base = _Q if second else _P
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        first = int(starts[at])
        to = max(at + 1, int(np.searchsorted(ends, first + block, side="right")))
        part = data[first : int(ends[to - 1])].astype(np.uint64) + np.uint64(1)
        up, down = _power(len(part), base)
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * up, out=total[1:])
        s, e = starts[at:to] - first, ends[at:to] - first
        out[at:to] = (total[e] - total[s]) * down[s]
        at = to
    out = mix(out + (ends - starts).astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
    for i in np.flatnonzero(ends - starts > _WORD).tolist():
        digest = hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=16).digest()
        out[i] = int.from_bytes(digest[8:] if second else digest[:8], "little")
    return out


def words(column: pa.Array, lower: bool, separators: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a text column, and the first word of each row (one more than rows)."""
    data, offsets = utf8(column)
    if lower:
        data = LOWER[data]
    starts, ends = spans(data, offsets, separators)
    return hashed(data, starts, ends), np.searchsorted(starts, offsets)


def runs_of(values: np.ndarray, width: int) -> np.ndarray:
    """Order-dependent hash of each run of ``width`` values (one per start; runs may cross rows, callers mask those)."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        total = np.zeros(n, np.uint64)
        for i in range(width):
            total = (total ^ values[i : i + n]) * np.uint64(0x9FB21C651E98DF25 + 2 * i)
            total ^= total >> np.uint64(32)
    return mix(total)
