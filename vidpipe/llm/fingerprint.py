"""Document fingerprints by consistent weighted sampling.

Native throughout.  A text's terms are its words in small letters, each weighing how often it occurs times its
length; a word of a script that sets no spaces, or one longer than ``LONGEST``, is taken as the runs of ``GRAM``
characters in it, each weighing how often it occurs.  So terms follow the length of a text in every script.
For a sample a term draws, from its hash alone, two gamma variables and a uniform shift, which fix the steps of
its weight at which its sample changes; the term with the least value wins and the sample is the winner with its
step.  Two texts share a sample with the chance of their generalised Jaccard similarity (sum of the smaller over
sum of the larger weights).

Every term bids for every one of the ``SAMPLES`` samples, so a sample is drawn from the whole text whatever the
weights; likeness is the share of equal samples.  A text without terms has none.  A row of terms stands for
``TOGETHER`` samples at a time: their bids are columns of one hash aggregate, which keeps rows few and the
generated code small.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Samples of a fingerprint, and how many of them one row of the aggregate draws.
SAMPLES, TOGETHER = 64, 4
#: Characters of the longest word that is a term by itself, and of the runs that stand for longer ones.
LONGEST, GRAM = 24, 3
#: Bits of a sample that name its term and step.
NAME_BITS = 24

_SPACE = r"[\s\p{Z}]+"
#: Thai, Lao, Tibetan, Burmese, Khmer, Japanese and Chinese characters.
_UNSPACED = r"[\u0E00-\u109F\u1780-\u17FF\u3040-\u30FF\u3400-\u4DBF\u4E00-\u9FFF\uF900-\uFAFF\uFF66-\uFF9F\x{20000}-\x{3FFFF}]"
#: A run at every character (not at the second half of one that Java holds as two).
_RUN = rf"(?s)(?=([^\uDC00-\uDFFF].{{{GRAM - 1}}}))"


def _terms(text: Column) -> Column:
    """The terms of a text as an array, perhaps with empty ones; a space stands before a run of characters."""
    words = F.split(F.lower(text), _SPACE, -1)
    # a word of ASCII alone needs no look at its characters
    odd = lambda w: (F.char_length(w) > LONGEST) | ((F.octet_length(w) > F.char_length(w)) & w.rlike(_UNSPACED))

    def cut(word: Column) -> Column:
        runs = F.transform(F.regexp_extract_all(word, F.lit(_RUN), F.lit(1)), lambda r: F.concat(F.lit(" "), r))
        return F.when((F.char_length(word) >= GRAM) & odd(word), runs).otherwise(F.array(word))

    return F.when(F.exists(words, odd), F.flatten(F.transform(words, cut))).otherwise(words)


def _size(term: Column) -> Column:
    """What one occurrence of a term weighs; null for an empty one."""
    return F.when(F.startswith(term, F.lit(" ")), F.lit(1)).when(term != "", F.char_length(term))


def with_next(documents: DataFrame) -> DataFrame:
    """``(h1, h2, v, nh1, nh2, times, doc_id, n_chars, text, head)`` of ``documents(doc_id, text)``.

    ``(h1, h2)`` names a row by its id and text, so rows equal in both are one, ``times`` says how many such rows
    there are.  A row's next is the one that follows by id (null ids first, rows of one id in an order fixed by
    their text); the last row's next is the first.  Of m equal rows m - 1 have themselves as next (``v`` = 1) and
    one has the row after them (``v`` = 0).  ``head`` is the first floor(n_chars / 4) code points of the next text.

    The order is found on narrow rows, range by range; texts move once, to where their name is hashed, and of each
    only what its predecessor needs moves on.  No group is larger than one row's text, whatever the ids are.
    """
    own, text = F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit(""))
    name = lambda salt: F.xxhash64(F.lit(salt), F.coalesce(own, F.lit(0).cast("bigint")), own.isNull(), text)
    named = documents.select(name(1).alias("h1"), name(2).alias("h2"), own.alias("doc_id"), text.alias("text"))
    order = ["doc_id", "h1", "h2"]
    rows = named.groupBy("h1", "h2").agg(F.first("doc_id").alias("doc_id"), F.first(F.char_length("text")).alias("n"), F.count("*").alias("m"))
    rows = rows.repartitionByRange(*order).select("*", F.spark_partition_id().alias("part"))
    rows = written(rows, "order")  # so that the ranges are settled for good
    this = F.struct(*order)
    heads = rows.groupBy("part").agg(F.min(this).alias("head"))  # one row a range
    by_part = Window.orderBy("part")
    over = F.coalesce(F.lead("head").over(by_part), F.first("head").over(by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    rows = rows.withColumn("to", F.lead(this).over(Window.partitionBy("part").orderBy(*order)))
    rows = rows.join(F.broadcast(heads.select("part", over.alias("over"))), "part").withColumn("to", F.coalesce("to", "over"))
    edge = lambda v, a, b, times: F.struct(F.lit(v).alias("v"), a.alias("nh1"), b.alias("nh2"), times.alias("times"))
    on, again = edge(0, F.col("to.h1"), F.col("to.h2"), F.lit(1).cast("bigint")), edge(1, F.col("h1"), F.col("h2"), F.col("m") - 1)
    edges = rows.select("h1", "h2", "doc_id", "n", F.explode(F.when(F.col("m") > 1, F.array(on, again)).otherwise(F.array(on))).alias("e"))
    edges = edges.select("h1", "h2", "e.*", "doc_id", "n")
    texts = named.groupBy("h1", "h2").agg(F.first("text").alias("text"))
    from_ = texts.select(F.col("h1").alias("nh1"), F.col("h2").alias("nh2"), F.col("text").alias("next"))
    sent = edges.join(from_, ["nh1", "nh2"]).select("h1", "h2", "v", "nh1", "nh2", "times", "doc_id", "n", F.substring(F.col("next"), F.lit(1), F.floor(F.col("n") / 4).cast("int")).alias("head"))
    return texts.join(sent, ["h1", "h2"]).select("h1", "h2", "v", "nh1", "nh2", "times", "doc_id", F.col("n").cast("bigint").alias("n_chars"), "text", "head")


def _exponential(h: Column) -> Column:
    """A gamma variable of shape 2, the sum of two exponential ones, from the low 44 bits of a hash."""
    bits = lambda at: F.shiftrightunsigned(h, at).bitwiseAND(F.lit((1 << 22) - 1)) + F.lit(0.5)
    return F.lit(44 * math.log(2)) - F.log(bits(0) * bits(22))


def _bid(sample: Column, w: Column) -> Column:
    """A term's bid for a sample: its value in the high bits and NAME_BITS of the sample's name in the low ones."""
    one, two = F.xxhash64("term", sample * 2), F.xxhash64("term", sample * 2 + 1)
    r, log_c = _exponential(one), F.log(_exponential(two))
    shift = F.shiftrightunsigned(two, 44) * F.lit(2.0**-20)
    step = F.floor(w / r + shift)
    value = ((log_c - r * (step - shift + 1) + 64) * F.lit(float(1 << 31))).cast("bigint")
    name = F.shiftrightunsigned(one, 40).bitwiseXOR(step).bitwiseAND(F.lit((1 << NAME_BITS) - 1))
    return F.shiftleft(value, NAME_BITS).bitwiseOR(name)


def fingerprints(texts: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """``keys`` and, for each text column ``c``, ``c`` as its samples: SAMPLES integers of NAME_BITS, all -1 for a text without terms.

    Terms are counted and sampled per ``keys``; rows that are already partitioned by some of them do not move.
    """
    each = texts.select(*keys, F.explode(F.array(*(F.struct(F.lit(j).alias("of"), F.col(c).alias("text")) for j, c in enumerate(columns)))).alias("e"))
    rows = each.select(*keys, F.col("e.of").alias("of"), F.explode_outer(_terms(F.col("e.text"))).alias("p"))
    logs = [f"w{j}" for j in range(len(columns))]
    weights = rows.select(*keys, "of", F.xxhash64("p").alias("term"), _size(F.col("p")).alias("size")).groupBy(*keys, "term").agg(
        *(F.log(F.sum(F.when(F.col("of") == j, F.col("size"))).cast("double")).alias(w) for j, w in enumerate(logs))
    )
    dealt = weights.select(*keys, "term", *logs, F.explode(F.array(*(F.lit(i) for i in range(0, SAMPLES, TOGETHER)))).alias("first"))
    least = dealt.groupBy(*keys, "first").agg(*(F.min(_bid(F.col("first") + i, F.col(w))).alias(f"{w}_{i}") for w in logs for i in range(TOGETHER)))
    drawn = lambda c: F.coalesce(F.col(c).bitwiseAND(F.lit((1 << NAME_BITS) - 1)), F.lit(-1)).cast("int")
    part = least.select(*keys, F.struct("first", *(F.array(*(drawn(f"{w}_{i}") for i in range(TOGETHER))).alias(w) for w in logs)).alias("part"))
    found = part.groupBy(*keys).agg(F.sort_array(F.collect_list("part")).alias("parts"))
    return found.select(*keys, *(F.flatten(F.col(f"parts.{w}")).alias(c) for c, w in zip(columns, logs, strict=True)))


def likeness(a: Column, b: Column) -> Column:
    """The share of equal samples among those that either text has; 1 for two texts without terms."""
    count = lambda test: F.size(F.filter(F.zip_with(a, b, test), lambda x: x))
    filled = count(lambda x, y: (x >= 0) | (y >= 0))
    return F.when(filled == 0, F.lit(1.0)).otherwise(count(lambda x, y: (x == y) & (x >= 0)) / F.greatest(filled, F.lit(1)))


def as_text(samples: Column) -> Column:
    """Six hex digits for each sample, six dots for one that is missing."""
    return F.array_join(F.transform(samples, lambda x: F.when(x < 0, F.lit("......")).otherwise(F.lpad(F.hex(x), 6, "0"))), "")


def compare_with_edits(documents: DataFrame) -> DataFrame:
    """``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)`` of ``documents(doc_id, text)``.

    The edited text has its last floor(n_chars / 4) code points replaced by the first as many (or all) of the
    next document.  One row per input row: null texts count as empty, rows of equal id follow each other in a
    fixed order, a single row is its own next.  Ids are integers.  Other columns do not matter; no rows give no rows.
    """
    rows = with_next(documents)
    kept = (F.col("n_chars") - F.floor(F.col("n_chars") / 4)).cast("int")
    rows = rows.withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), kept), F.col("head")))
    keys = ["h1", "h2", "v"]
    found = fingerprints(rows.select(*keys, "text", "edited"), keys, ["text", "edited"])
    facts = rows.select(*keys, "nh1", "nh2", "times", "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"))
    # the difference is no join key, so both sides stay where (h1, h2) put them; a name has two rows at most
    drawn = found.select(F.col("h1").alias("f1"), F.col("h2").alias("f2"), F.col("v").alias("fv"), "text", "edited")
    own = facts.join(drawn, (F.col("h1") == F.col("f1")) & (F.col("h2") == F.col("f2")) & (F.col("v") - F.col("fv") == 0)).drop("f1", "f2", "fv")
    own = written(own, "fingerprints")
    other = own.where("v = 0").select(F.col("h1").alias("nh1"), F.col("h2").alias("nh2"), F.col("text").alias("next"))
    # equal rows again as many times as they were given, in steps of 4096
    step = F.lit(4096).cast("bigint")
    out = own.join(other, ["nh1", "nh2"]).withColumn("lot", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("times") - 1) / step))))
    out = out.withColumn("one", F.explode(F.sequence(F.lit(1).cast("bigint"), F.least(step, F.col("times") - F.col("lot") * step))))
    return out.select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("text")).alias("fingerprint"), as_text(F.col("edited")).alias("edited_fingerprint"),
        likeness(F.col("text"), F.col("edited")).alias("near_edited"), likeness(F.col("text"), F.col("next")).alias("near_next"),
    )
