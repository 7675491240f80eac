"""A persisted filter of keys that are done, so that most new rows need no look into a long history.

The filter is a table of blocks of 256 bits, a row each.  A key belongs to one block and sets a bit in each of its
four words; a key of which a bit is missing was never added.  Blocks of several filters of equal size add up by
bitwise or, so new keys are merged in without reading the old ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import written
from ..sources.state import Tables

WORDS = ("w0", "w1", "w2", "w3")
#: Bits of a filter for each key that it is made for; at so many keys about one other key in 300 seems to be there.
BITS_PER_KEY = 16


def blocks_for(keys: int) -> int:
    """Blocks of a filter for so many keys."""
    return max(1, keys * BITS_PER_KEY // 256)


def _place(key: Column, blocks: int) -> tuple[Column, list[Column]]:
    """The block of a key, and its bit of each word."""
    h = F.xxhash64(key, F.lit("bits"))
    bit = lambda k: F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftrightunsigned(h, 6 * k).bitwiseAND(F.lit(63)).cast("int"))
    return F.pmod(F.xxhash64(key), F.lit(blocks)), [bit(k) for k in range(4)]


def blocks_of(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """``(block, w0, w1, w2, w3)`` of a filter that holds ``keys``; combines before its shuffle."""
    block, bits = _place(F.col(key), blocks)
    return keys.where(F.col(key).isNotNull()).groupBy(block.alias("block")).agg(*(F.bit_or(b).alias(w) for b, w in zip(bits, WORDS, strict=True)))


def added(old: DataFrame, new: DataFrame) -> DataFrame:
    """Two filters of equal size as one."""
    return old.unionByName(new).groupBy("block").agg(*(F.bit_or(w).alias(w) for w in WORDS))


def add_done(tables: Tables, keys: DataFrame, key: str, blocks: int, source: str | None = None, batch: int | None = None) -> bool:
    """Keys added to the stored filter, of which only the touched buckets are written; to be called before the keys are stored themselves, as it may hold more, never less."""
    done = tables.merge("seen_blocks", blocks_of(keys, key, blocks), added, source, batch)
    tables.forget("seen_blocks")
    return done


def unprocessed(raw: DataFrame, done: DataFrame, filter_blocks: DataFrame, blocks: int, key: str) -> DataFrame:
    """Rows of ``raw`` whose key ``done`` lacks, exactly; rows with null key stay.

    ``filter_blocks`` holds all keys of ``done``.  Rows that it does not know are new without a look at ``done``; the
    few others are written, and of ``done`` only the rows with their keys take part in the anti-join: where those keys
    are few by Spark's measure they are broadcast, so the history is read once and not shuffled.
    """
    block, bits = _place(F.col(key), blocks)
    probed = raw.withColumn("_block", block).join(filter_blocks.withColumnRenamed("block", "_block"), "_block", "left")
    has = F.lit(True)
    for b, w in zip(bits, WORDS, strict=True):
        has = has & (F.col(w).bitwiseAND(b) != 0)
    marked = written(probed.select(*raw.columns, F.coalesce(has & F.col(key).isNotNull(), F.lit(False)).alias("_maybe")), "probed")
    maybe, new = marked.where("_maybe").drop("_maybe"), marked.where("NOT _maybe").drop("_maybe")
    asked = written(maybe.select(key).distinct(), "asked")
    found = written(done.select(key).join(asked, key, "left_semi").distinct(), "found")
    return new.unionByName(maybe.join(found, key, "left_anti").select(*raw.columns))
